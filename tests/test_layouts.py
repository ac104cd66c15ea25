"""Walks, layouts and indexes: what they read, how much they write, and odd input."""

import json
import random

import pytest
from pyspark.sql import functions as F

from docloom.functions import analysis as A
from docloom.functions import values as V
from docloom.operators import index as I
from docloom.operators import mapping as M
from docloom.operators import profile as P
from docloom.operators import relations as R
from docloom.operators import schema as S
from docloom.operators import terms as T
from docloom.session import scratch_path
from docloom.sources import documents as D

from tests.test_rules import docs_of


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def walked(value, path):
    """Nodes of a value with their class, itself first."""
    kind = {dict: "object", list: "array", str: "string", bool: "boolean", type(None): "null"}.get(type(value), "number")
    yield path, kind
    for key, member in value.items() if kind == "object" else ():
        yield from walked(member, f"{path}.{key}")
    for i, item in enumerate(value) if kind == "array" else ():
        yield from walked(item, f"{path}[{i}]")


def test_walk_finds_every_node(spark, monkeypatch):
    rng = random.Random(8)

    def made(depth):
        if depth and rng.random() < 0.6:
            if rng.random() < 0.5:
                return {k: made(depth - 1) for k in "abc" if rng.random() < 0.7}
            return [made(depth - 1) for _ in range(rng.randrange(4))]
        return rng.choice([1, 2.5, "x", True, None, {}, []])

    bodies = [{k: made(7) for k in "xyz" if rng.random() < 0.8} for _ in range(60)]
    expected = sorted((i + 1, *n) for i, b in enumerate(bodies) for k, v in b.items() for n in walked(v, f"$.{k}"))
    docs = docs_of(spark, [json.dumps(b) for b in bodies] + ["{broken", "[1]", "5", "{}"])
    first = docs.agg(F.min("seq")).first()[0]
    for levels in (1, 4):
        monkeypatch.setattr(V, "LEVELS", levels)
        found = V.document_nodes(docs, "$", "seq").select(F.col("seq") - first + 1, "path", "type").collect()
        assert sorted(map(tuple, found)) == expected


def test_walk_of_a_wide_array(spark):
    wide = json.dumps({"a": [{"b": i, "c": {"d": str(i)}} for i in range(50_000)]})
    docs = docs_of(spark, [wide])
    found = V.document_nodes(docs, "$", "seq").groupBy(V.field_path(F.col("path")).alias("p")).count()
    assert {r["p"]: r["count"] for r in found.collect()} == {
        "$.a": 50_001, "$.a.b": 50_000, "$.a.c": 50_000, "$.a.c.d": 50_000}
    leaves = M.flattened_leaves(docs.withColumn("raw", F.concat(F.lit('{"o": '), "raw", F.lit("}"))), "$.o", "seq")
    assert leaves.count() == 100_000


def test_documents_are_parsed_once(spark):
    docs = docs_of(spark, ['{"kind": "a", "x": 1}', '{"kind": "b"}', "{}", "{broken", "[1]"])
    parsed = D.parsed_once(docs)
    assert [r["whole"] for r in parsed.select(F.col("_source").isNotNull().alias("whole")).orderBy("seq").collect()] == [
        True, True, True, False, False]
    profile = P.field_profile(docs)
    assert {r["key"]: r["probability"] for r in profile.collect()} == {"kind": 67, "x": 33}
    kinded = P.with_kind(parsed, P.chosen_kind_fields(parsed))
    for frame in (kinded, P.fields(parsed), P.collection_profile(parsed)):
        assert "parse_json" not in plan(frame).lower() and "parsejson" not in plan(frame).lower()
    # One operator parses, and nothing is pushed below it that would parse again.
    lines = [line for line in plan(P.document_fields(docs)).lower().splitlines() if "parsejson" in line]
    assert len(lines) == 1


def test_samples_by_ranges(spark, monkeypatch):
    monkeypatch.setattr(P, "RANKED_ROWS", 50)
    monkeypatch.setattr(P, "RANGES", 8)
    rng = random.Random(2)
    # One field has few values, one many late, one is new in each document, one holds containers.
    bodies = [
        {"few": i % 3, "late": 0 if i < 1500 else i, "new": i, "box": [i % 2], "some": rng.randrange(10_000)}
        for i in range(2000)
    ]
    docs = docs_of(spark, [json.dumps(b) for b in bodies]).repartition(5)
    got = {}
    for r in P.field_samples(docs, 30).collect():
        got.setdefault(r["key"], {})[r["rank"]] = r["sample"]
    for key in ("few", "late", "new", "some"):
        seen = list(dict.fromkeys(b[key] for b in bodies))[:30]
        assert [got[key][i + 1] for i in range(len(seen))] == [str(x) for x in seen] and len(got[key]) == len(seen)
    assert [got["box"][i + 1] for i in range(30)] == [f"[{i % 2}]" for i in range(30)]


def test_fields_are_numbered_over_parts(spark):
    rows = [("a" if i % 3 else "b", f"k{i:05d}", i) for i in range(9000)]
    random.Random(1).shuffle(rows)
    profile = spark.createDataFrame(rows, "_index string, key string, position int").repartition(7)
    numbered = P.field_order(profile)
    for index in "ab":
        mine = sorted(r[2] for r in rows if r[0] == index)
        found = {r["position"]: r["place"] for r in numbered.where(F.col("_index") == index).collect()}
        assert found == {p: i + 1 for i, p in enumerate(mine)}


def test_kinds_of_any_number_are_few_files(spark):
    bodies = [json.dumps({"type": f"t{i}" if i % 2 else "large", "pad": "x" * 40}) for i in range(3000)]
    kinded = docs_of(spark, bodies).withColumn("kind", F.get_json_object("raw", "$.type")).repartition(6)
    path = scratch_path(spark, "t")
    S.write_by_kind(kinded, path, file_bytes=60_000)
    files = spark.read.parquet(f"{path}/data").inputFiles()
    assert len(files) <= 2 * (3000 * 140 // 60_000) + 2
    assert S.read_kind(spark, path, kinded.first()["_index"], "t7").count() == 1
    large = S.read_kind(spark, path, kinded.first()["_index"], "large")
    assert large.count() == 1500 and "PartitionFilters: [isnotnull(slot" in plan(large)
    assert large.select(F.input_file_name()).distinct().count() < len(files)
    assert S.read_kind(spark, path, "other", "t7").count() == 0


def test_objects_with_many_keys_become_maps(spark):
    bodies = [{"n": i, "by": {f"user{i}": i, "all": 1}, "deep": {"in": {f"k{i}": [i]}}} for i in range(400)]
    docs = docs_of(spark, [json.dumps(b) for b in bodies]).withColumn("kind", F.lit("k"))
    merged = S.schema_merge(S.observed_schema(docs))
    folded = {r["path"]: r["type"] for r in S.fold_maps(merged).collect()}
    assert folded == {"_source.n": "scalar", "_source.by": "map", "_source.deep": "object", "_source.deep.in": "map"}
    table = S.kind_union(docs, merged)
    rows = table.orderBy("n").select("by", "deep_in").collect()
    assert table.count() == 400 and {tuple(r["by"].items()) for r in rows} == {
        tuple(sorted({f"user{i}": str(i), "all": "1"}.items())) for i in range(400)}
    assert all(list(r["deep_in"].values())[0].startswith("[") for r in rows)
    assert {r["path"] for r in S.fold_maps(merged, most=1).collect()} == {"_source"}


def test_index_reads_no_text_and_few_blocks(spark):
    rng = random.Random(6)
    words = ["common"] * 30 + ["middle"] * 6 + ["rare"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(3, 60))) + (" odd" if i == 77 else "")) for i in range(4000)]
    docs = spark.createDataFrame(rows, "id long, body string").repartition(4)
    path = scratch_path(spark, "t")
    I.build_index(docs, "id", {"body": ("body", A.standard_lower)}, path)
    asked = ["rare", "odd", "common", "absent"]
    pairs = (("bm25", T.rank_bm25), ("classic", T.rank_classic), ("boolean", T.rank_boolean))
    for model, rank in pairs:
        for k in (1, 7, 5000):
            expected = [tuple(r) for r in rank(docs, "id", "body", A.standard_lower, asked, k).collect()]
            found = I.search(spark, path, {"body": asked}, k, model, doc="id")
            assert [tuple(r) for r in found.collect()] == expected
    text = plan(I.search(spark, path, {"body": asked}, 3))
    assert "split" not in text.lower() and "PartitionFilters: [" in text
    query = I._Search(spark, path, {"body": ["common"]}, "bm25", {})
    assert max(len(r["postings"]) for r in query.read(query.levels).collect()) < 2 * I.BLOCK
    assert I.search(spark, path, {"body": ["absent"]}, 3).count() == 0
    assert I.search(spark, path, {"none": ["rare"]}, 3).count() == 0
    with pytest.raises(ValueError, match="unknown model"):
        I.search(spark, path, {"body": ["rare"]}, 3, "other")


def test_index_of_empty_texts(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "one")], "id long, body string")
    path = scratch_path(spark, "t")
    I.build_index(docs, "id", {"body": ("body", A.standard_lower)}, path)
    assert [r["doc"] for r in I.search(spark, path, {"body": ["one"]}, 5).collect()] == [3]


def test_stored_chain_joins_without_an_exchange(spark):
    top = spark.range(300).withColumnRenamed("id", "t")
    mid = spark.range(900).select(F.col("id").alias("m"), (F.col("id") % 350).alias("mt"))
    low = spark.range(3000).select(F.col("id").alias("l"), (F.col("id") % 1000).alias("lm"))
    levels = [(top, None, None), (mid, "t", "mt"), (low, "m", "lm")]
    path = scratch_path(spark, "t")
    stored = R.store_chain(levels, "t", path.rsplit("/", 1)[-1].replace("-", "_"), path, 4)
    joined = R.multi_level_routed(stored)
    assert "Exchange" not in plan(joined)
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, R.multi_level(levels).collect()))


def test_unicode_words(spark):
    # Cases of the published break rules: letters with apostrophes, numbers with points, signs, marks.
    cases = {
        "can't stop": ["can't", "stop"], "3.14 and 1,000": ["3.14", "and", "1,000"], "a.b": ["a.b"],
        "e\u0301te\u0301": ["e\u0301te\u0301"], "-- !?": [], "": [],
        "ÉCOLE Straße": ["école", "straße"], "under_score": ["under_score"],
    }
    rows = spark.createDataFrame([(t,) for t in cases], "t string").select("t", A.unicode_words(F.col("t")).alias("w"))
    assert {r["t"]: r["w"] for r in rows.collect()} == cases


def test_sketches_merge(spark):
    docs = docs_of(spark, [json.dumps({"a": i, "b": i % 7}) for i in range(4000)])
    parts = [P.cardinality_sketches(docs.where(F.col("seq") % 3 == i)) for i in range(3)]
    merged = P.merged_cardinality(parts[0].union(parts[1]).union(parts[2]), "key").collect()
    found = {r["key"]: r for r in merged}
    assert found["b"]["estimate"] == 7 and abs(found["a"]["estimate"] - 4000) < 120
    assert all(r["values"] == 4000 for r in merged)


def test_policies_are_strict(spark):
    texts = ['{"a": 1, "b": 2}', '{"a": 1}', '{"a": 1, "a": 2}', '{"a": 1} x', "{broken", "[1]", "5"]
    docs = docs_of(spark, texts)
    for policy, expected in (("strict", [1, 0, 1, 1, 1, 1, 1]), ("false", [0, 0, 1, 1, 1, 1, 1]),
                             ("true", [0, 0, 1, 1, 1, 1, 1]), ("runtime", [0, 0, 1, 1, 1, 1, 1])):
        rows = M.dynamic_policy(docs, ["a"], policy).orderBy("seq").collect()
        assert [int(r["rejected"]) for r in rows] == expected
    kept = M.enabled_false(docs, "$.a", "kept").orderBy("seq").collect()
    assert [r["kept"] for r in kept] == ["1", "1", None, None, None, None, None]
    mapped = M.apply_mapping(docs, [M.Field("a", "$.a", "long")], "seq").orderBy("seq").collect()
    assert [r["_malformed"] for r in mapped] == [[], []] + [["_source"]] * 5


def test_arrays_are_seen_before_the_mapping(spark):
    docs = docs_of(spark, ['{"t": ["a", "b"], "u": 1}', '{"t": "c"}', '{"u": 2}'])
    mapping = M.observed_arrays(docs, [M.Field("t", "$.t", "keyword"), M.Field("u", "$.u", "long")])
    rows = M.apply_mapping(docs, mapping, "seq").orderBy("seq").collect()
    assert [(r["t"], r["u"], r["_malformed"]) for r in rows] == [
        (["a", "b"], 1, []), (["c"], None, []), (None, 2, [])]
