"""Steps whose cost must not grow faster than the documents: texts are read once, keys are not one task's."""

import re

from pyspark.sql import functions as F

from docloom.functions import analysis as A
from docloom.functions.rows import spread_join
from docloom.operators import index as I
from docloom.operators import mapping as M
from docloom.operators import schema as S
from docloom.operators import terms as T
from docloom.session import materialize, scratch_path

from tests.test_layouts import plan
from tests.test_rules import docs_of


def filters(df):
    """Conditions of the filters of a plan."""
    return re.findall(r"Condition : (.*)", plan(df))


def test_unmapped_keys_are_found_once_a_document(spark):
    docs = materialize(docs_of(spark, ['{"a":1,"b":"x","c":null}', '{"a":1}', '{broken', '{"a":1,"a":2}']))
    runtime = M.dynamic_policy(docs, ["a"], "runtime")
    rows = runtime.selectExpr("unmapped", "rejected", "map_keys(runtime) AS keys").collect()
    assert sorted((r["rejected"], r["unmapped"] or [], r["keys"]) for r in rows if not r["rejected"]) == [
        (False, [], []), (False, ["b", "c"], ["b", "c"])]
    assert [(r["unmapped"], r["keys"]) for r in rows if r["rejected"]] == [(None, None)] * 2
    # No member of a document looks at its text again.
    lambdas = re.findall(r"map_filter\((.*)", plan(runtime.select("runtime")))
    assert lambdas and not any("jsonObjectKeys" in x for x in lambdas)
    strict = M.dynamic_policy(docs, ["a"], "strict").where("rejected")
    assert strict.count() == 3 and not any("parseJson" in x or "jsonObjectKeys" in x for x in filters(strict))


def test_quarantine_filter_parses_no_text(spark):
    docs = materialize(docs_of(spark, ['{"t":["a","b"],"n":1}', '{"t":"c"}', '{"t":"d","n":"many"}', '[1]']))
    mapping = M.observed_arrays(docs, [M.Field("t", "$.t", "keyword"), M.Field("n", "$.n", "long")])
    mapped = M.apply_mapping(docs, mapping, "seq")
    kept = mapped.where(~M.is_quarantined())
    assert sorted((r["t"], r["n"]) for r in kept.collect()) == [(["a", "b"], 1), (["c"], None)]
    assert mapped.where(M.is_quarantined()).count() == 2
    assert filters(kept) and not any("parseJson" in x for x in filters(kept))


def test_rows_of_one_key_are_dealt_to_many_tasks(spark):
    many = spark.range(2000).selectExpr("id", "if(id % 50 = 0, id, 7) AS k")
    few = spark.createDataFrame([(7, "a"), (100, "b"), (1, "c")], "k long, v string")
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        for how in ("inner", "left", "left_semi"):
            joined = spread_join(many, few, ["k"], "id", how)
            assert sorted(map(repr, joined.collect())) == sorted(map(repr, many.join(few, ["k"], how).collect()))
            assert joined.where("k = 7").select(F.spark_partition_id().alias("p")).distinct().count() > 4
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_members_of_maps_are_not_looked_up_in_one_task(spark, monkeypatch):
    docs = docs_of(spark, ['{"by":{"u%d":{"at":%d}},"plain":1}' % (i, i) for i in range(300)] + ['{"by":"none"}'])
    kinded = materialize(docs.withColumn("kind", F.lit("k")))
    plans, write = [], S.materialize
    monkeypatch.setattr(S, "materialize", lambda df, *label: (plans.append(plan(df)), write(df, *label))[1])
    merged = S.schema_merge(S.observed_schema(kinded))
    folded = {r["path"]: r["type"] for r in S.fold_maps(merged).collect()}
    # The last document set the object over, so its members are gone.
    assert folded == {"_source.by": "scalar", "_source.plain": "scalar"}
    first = materialize(kinded.where("seq < 300"))
    folded = {r["path"]: r["type"] for r in S.fold_maps(S.schema_merge(S.observed_schema(first))).collect()}
    assert folded == {"_source.by": "map", "_source.plain": "scalar"}
    # What lies in a map is as much as the documents hold: no table of it is sent to every task.
    assert not any("LeftAnti" in p for p in plans if "_inside" in p or "member" in p)
    assert any("_salt" in p for p in plans)


def test_index_with_more_terms_than_are_sent_to_tasks(spark, monkeypatch):
    rows = [(i, " ".join(["all"] * (i % 5 + 1) + [f"w{i % 40}", f"w{i % 7}", f"only{i}"])) for i in range(1200)]
    docs = spark.createDataFrame(rows, "id long, body string")
    labels, write = [], I.materialize
    monkeypatch.setattr(I, "FREQUENT", 3)
    monkeypatch.setattr(I, "materialize", lambda df, *label, **kw: (labels.append(label), write(df, *label, **kw))[1])
    path = scratch_path(spark, "t")
    I.build_index(docs, "id", {"body": ("body", A.standard_lower)}, path)
    # Entries go to their blocks as they are made: no table of them is written on the way.
    assert ("entries",) not in labels
    levels = spark.read.parquet(f"{path}/levels")
    sums = {r["term"]: (r["n"], r["df"]) for r in levels.groupBy("term").agg(F.sum("entries").alias("n"), F.max("df").alias("df")).collect()}
    assert sums["all"] == (1200, 1200) and sums["only7"] == (1, 1) and all(n == df for n, df in sums.values())
    assert levels.where("term = 'all' AND blocks <> ceil(entries / 256)").count() == 0
    assert levels.where("term <> 'all' AND df <= 256 AND blocks <> 1").count() == 0
    expected = T.rank_classic(docs, "id", "body", A.standard_lower, ["w3", "all", "only8"], 9).collect()
    assert I.search(spark, path, {"body": ["w3", "all", "only8"]}, 9, "classic", doc="id").collect() == expected
