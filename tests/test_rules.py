"""Rules the tables never exercise: small inputs with results worked out by hand."""

import pytest
from pyspark.sql import functions as F

from docloom.functions import analysis as A
from docloom.functions import values as V
from docloom.operators import mapping as M
from docloom.operators import profile as P
from docloom.operators import schema as S
from docloom.sources import documents as D


def docs_of(spark, raws, index="c"):
    rows = [(index, str(i), i, raw) for i, raw in enumerate(raws)]
    return spark.createDataFrame(rows, "_index string, _id string, seq long, raw string")


def per_value(spark, texts, build):
    df = spark.createDataFrame(list(enumerate(texts)), "i long, raw string")
    rows = df.select("i", build(F.try_parse_json("raw")).alias("r")).orderBy("i").collect()
    return [r["r"] for r in rows]


def test_number_mode(spark):
    numbers = ["-128", "-127", "126", "127", "32766", "32767", "2147483646", "2147483647", "1.5", "1e21"]
    found = per_value(spark, numbers, lambda v: V.number_mode(F.try_variant_get(v, "$", "double")))
    assert found == [
        "short", "byte", "byte", "short", "short", "integer", "integer", "long", "float", "float"]
    # -127 is the lowest byte, -128 already a short.


def test_geo_point_subtype(spark):
    values = ['"41.1,-71.2"', '"41,-71"', '"u4pru"', "[1, 2]",
              '{"top_left": {"lat": 1}, "bottom_right": {"lat": 2}}', "{}", "null", "5"]
    assert per_value(spark, values, V.geo_point_subtype) == [
        "string", "geohash", "geohash", "geoJSON", "geo-bounding", "object", None, "object"]


def test_geo_shape_subtype(spark):
    words = ["point", "linestring", "polygon", "multipoint", "multilinestring", "multipolygon",
             "geometrycollection"]
    texts = [f'" {w} (1 2)"' for w in words] + ['"bbox (1)"', '"circle"', '"POINT"', '"POINT "',
             '{"type": "Point"}', "{}", "[1]", "null"]
    assert per_value(spark, texts, V.geo_shape_subtype) == [
        *words, "envelope", None, None, None, "Point", "point", "point", None]


def test_label_text(spark):
    values = ["1", "1.50", "true", "null", '"x"', '{"a": 1}', '[1, [2, null], "x"]', "1e2", "[[[[[1]]]]]",
              '[[], [[{"a": [1]}], [[2, "[3"]]], null]', "[]"]
    assert per_value(spark, values, V.label_text) == [
        "1", "1.5", "true", "null", "x", "[object Object]", "1,2,,x", "100", "1",
        ",[object Object],2,[3,", ""]


def test_one_number_has_one_text(spark):
    values = ["1e20", "100000000000000000000", "9007199254740993", "-0.0", "1e21", "1000000000000000000000",
              "1.5e25", "123456789012345680000"]
    assert per_value(spark, values, V.number_text) == [
        "100000000000000000000", "100000000000000000000", "9007199254740992", "0", "1e+21", "1e+21",
        "1.5e+25", "123456789012345680000"]


def test_parse_document_rejects_what_is_left_over(spark):
    texts = ['{"a": 1}', '{"a": 1} x', '{"a": 1}, {"b": 2}', '{"a": 1, "a": 2}', "", "{", '{"a": 1}] junk',
             "1], [2", " ", "[1, 2]"]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, raw string")
    rows = df.select("i", V.parse_document(F.col("raw")).isNotNull().alias("ok")).orderBy("i")
    assert [r["ok"] for r in rows.collect()] == [True] + [False] * 8 + [True]


def test_rejected_documents_are_in_no_total(spark):
    docs = docs_of(spark, ['{"a": 1}', '{"a": 1, "a": 2}', '{"a": 1} x', "{broken", "[1]", '{"b": 1, "a": 2}'])
    found = {r["key"]: (r["cnt"], r["probability"]) for r in P.field_probability(docs).collect()}
    assert found == {"a": (2, 100), "b": (1, 50)}


def test_any_seq_will_do(spark):
    rows = [("c", str(i), s, '{"k": "x", "n": %d}' % i) for i, s in enumerate([2**63 - 1, 2**44, -(2**63), 0])]
    docs = spark.createDataFrame(rows, "_index string, _id string, seq long, raw string")
    assert {r["name"] for r in P.collection_profile(docs).collect()} == {"k", "n", "x"}
    firsts = {r["seq"] for r in D.scan_limit(docs, "c", 2).collect()}
    assert firsts == {-(2**63), 0}


def test_repeated_seq_and_one_outlier(spark, monkeypatch):
    monkeypatch.setattr(D, "RANKED_ROWS", 2)
    monkeypatch.setattr(D, "HISTOGRAM_BUCKETS", 8)
    seqs = [1, 2, 2, 2, 2, 3, 2**62]
    rows = [("c", str(i), s, "{}") for i, s in enumerate(seqs)] + [("c", "4", 2, "{}")]
    docs = spark.createDataFrame(rows, "_index string, _id string, seq long, raw string")
    want = sorted(((s, i) for _, i, s, _ in rows))
    for size in range(len(rows) + 2):
        got = sorted((r["seq"], r["_id"]) for r in D.scan_limit(docs, "c", size).collect())
        assert got == want[:size]


def test_malformed_ends_make_a_range_malformed(spark):
    docs = docs_of(spark, ['{"r": {"gte": "bad", "lte": "bad"}}', '{"r": {"gte": 1}}', '{"r": {"gte": 1, "lte": null}}',
                           '{"r": {"gte": 1.5, "lte": "9"}}', '{"r": 5}', "{}"])
    rows = M.apply_mapping(docs, [M.Field("r", "$.r", "long_range")], "seq").orderBy("seq").collect()
    assert [r["_malformed"] for r in rows] == [["r"], [], [], [], ["r"], []]
    strict = M.apply_mapping(docs, [M.Field("r", "$.r", "long_range", coerce=False)], "seq").orderBy("seq").collect()
    assert [bool(r["_malformed"]) for r in strict] == [True, False, False, True, True, False]
    with pytest.raises(ValueError, match="unknown type"):
        M.apply_mapping(docs, [M.Field("r", "$.r", "no_such_type")])


def test_presence_counts_null_but_not_missing(spark):
    docs = docs_of(spark, ['{"a": null}', "{}", '{"a": 1, "b": 2}'])
    assert {r["key"]: r["cnt"] for r in P.field_presence(docs).collect()} == {"a": 2, "b": 1}


def test_type_is_sticky_for_strings_else_last(spark):
    docs = docs_of(spark, ['{"a": "x", "b": 1}', '{"a": 1, "b": null}', '{"a": []}'])
    assert {r["key"]: r["type"] for r in P.field_type(docs).collect()} == {"a": "string", "b": "null"}


def test_samples(spark):
    raws = [f'{{"n": {i}}}' for i in range(31)]
    raws += ['{"m": 1}', '{"m": "1"}', '{"m": 1.0}', '{"m": {}}', '{"m": {}}']
    rows = P.field_samples(docs_of(spark, raws)).collect()
    assert [r["sample"] for r in sorted(rows, key=lambda r: r["rank"]) if r["key"] == "n"] == [
        str(i) for i in range(30)]
    assert [(r["type"], r["sample"]) for r in sorted(rows, key=lambda r: r["rank"]) if r["key"] == "m"] == [
        ("number", "1"), ("string", "1"), ("object", "{}"), ("object", "{}")]


def test_probability_rounds_as_written(spark):
    raws = ['{"a": 1, "t": 1}'] * 57 + ['{"t": 1}'] * 143
    rows = P.field_probability(docs_of(spark, raws)).collect()
    assert {r["key"]: r["probability"] for r in rows}["a"] == 28


@pytest.mark.parametrize("raws, expected", [
    (['{"a": "x", "b": "y"}'], ("b", 100)),
    (['{"type": "x", "b": "y"}'], ("type", 100)),
    (['{"a": "x", "type": "y"}'], ("type", 100)),
    (['{"a": "x", "id": "y"}'], ("a", 100)),
    (['{"a": 1}'], ("", 0)),
    (['{"b": "x", "7": "y"}'], ("b", 100)),
])
def test_kind_field_ties(spark, raws, expected):
    row = P.kind_field(P.field_profile(docs_of(spark, raws))).first()
    assert (row["kind_field"], row["probability"]) == expected


def test_kinds_missing_null_and_empty(spark):
    docs = docs_of(spark, ["{}", '{"k": null}', '{"k": ""}', '{"k": "a"}'])
    fields = spark.createDataFrame([("c", "k")], "_index string, kind_field string")
    kinded = P.with_kind(docs, fields)
    assert {r["kind"] for r in P.distinct_kinds(kinded).collect()} == {"undefined", "null", "a"}
    assert {r["kind"] for r in P.group_by_kind(kinded).collect()} == {"undefined", "null", "", "a"}


def test_sample_size(spark):
    counts = spark.createDataFrame([("a", 10), ("b", 33), ("c", 100_000)], "_index string, documents long")

    def sizes(**settings):
        return [r["size"] for r in D.sample_size(counts, **settings).orderBy("_index").collect()]

    assert sizes(absolute=50) == [50, 50, 50]
    assert sizes(percent=10.0, max_value=500) == [1, 4, 500]


@pytest.mark.parametrize("buckets", [4, 65_536])
def test_first_documents_for_any_size(spark, monkeypatch, buckets):
    monkeypatch.setattr(D, "HISTOGRAM_BUCKETS", buckets)
    monkeypatch.setattr(D, "RANKED_ROWS", 5)
    places = {"a": [i * i * 1000 for i in range(300)], "b": list(range(50)), "d": [7]}
    rows = [(k, str(s), s, "{}") for k, seqs in places.items() for s in seqs]
    docs = spark.createDataFrame(rows, "_index string, _id string, seq long, raw string")
    sizes = {"a": 123, "b": 50, "d": 5}
    table = spark.createDataFrame(
        [(k, len(places[k]), n) for k, n in sizes.items()], "_index string, documents long, size long")
    found = {(r["_index"], r["seq"]) for r in D.first_documents(docs, table).collect()}
    assert found == {(k, s) for k, n in sizes.items() for s in places[k][:n]}


def test_schema_merge_pairs(spark):
    rows = [("c", "k1", 0, "p", "scalar"), ("c", "k2", 1, "p", "object"),
            ("c", "k1", 0, "q", "object"), ("c", "k2", 1, "q", "scalar"),
            ("c", "k1", 0, "r", "scalar"), ("c", "k2", 1, "r", "array"),
            ("c", "k1", 0, "s", "object"), ("c", "k2", 1, "s", "object")]
    schemas = spark.createDataFrame(rows, "_index string, kind string, kind_order long, path string, type string")
    merged = {r["path"]: (r["type"], r["kind"]) for r in S.schema_merge(schemas).collect()}
    assert merged == {"p": ("object", "k2"), "q": ("object", "k1"), "r": ("scalar", "k1"),
                      "s": ("object", "k1")}


def test_copy_targets_at_two_depths():
    paths = ["$.all", "$.a.all", "$.a.ball", "$.b[0].all"]
    assert M.copy_targets(paths, "all") == ["$.all", "$.a.all"]
    assert M.copy_targets(paths, "a.all") == []


def test_alias_path():
    assert M.alias_path(["_source.a.[0].b", "x"]) == "$.a.b"
    assert M.alias_path(["a[0].b"]) == "$.a.b"
    assert M.alias_path(["_source.info.ref"]) == "$.info.ref"


def tokens(spark, text, analyzer):
    return spark.range(1).select(analyzer(F.lit(text))).first()[0]


def test_tokenizers(spark):
    assert tokens(spark, "Été-2 abcdef!", lambda x: A.standard(x, 4)) == ["Été", "2", "abcd", "ef"]
    assert tokens(spark, "/a/b/c", A.path_hierarchy) == ["/a", "/a/b", "/a/b/c"]
    assert tokens(spark, "a/b/c", lambda x: A.path_hierarchy(x, "/", "-", 1, True)) == ["a-b", "b"]
    assert tokens(spark, "abc d", lambda x: A.ngram(x, 2, 3, ["letter"])) == ["ab", "abc", "bc"]
    assert tokens(spark, "see HTTP://x or me@ex.org", A.url_email) == [
        "see", "HTTP", "x", "or", "me@ex.org"]
    assert tokens(spark, "b a B", A.fingerprint) == "a b"
    assert tokens(spark, "", A.standard) == []


def test_plain_names_give_the_lists_of_spark(spark):
    for name in ("english", "french", "german", "spanish"):
        found = A.named_stop_words(name)
        assert len(found) > 100 and A.named_stop_words(f"{name}_short") == A.NAMED_STOP_WORDS[f"{name}_short"]
    assert {"ourselves", "the"} < set(A.named_stop_words("english"))


def test_stop_word_precedence():
    assert A.stop_words(["a"], named="english", path_words=["p"]) == ["p"]
    assert "the" in A.stop_words(["a"], named="english")
    assert A.stop_words(["a"]) == ["a"]
