"""Sinks, and streams across restarts."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from docloom.session import scratch_path
from docloom.sources import documents as D
from docloom.sources import sinks
from docloom.streaming import jobs as J

from tests.test_rules import docs_of

LINES = [
    '{"_index": "c", "_id": "1", "seq": 1, "_source": {"type": "a"}}',
    '{"_index": "c", "_id": "2", "seq": 2, "_source": {"type": "b"}}',
    '{"_id": "3", "seq": 3, "_source": {}}',
    '{"_index": "c", "_source": [1]}',
    "{broken",
    "",
    '{"_index": "c", "_id": "4", "seq": 4, "_source": {"a": 1}}] junk',
]


def write(spark, folder, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode(
        "append").text(folder)


def test_bad_line_ends_the_scan(spark):
    folder = scratch_path(spark, "t")
    write(spark, folder, LINES)
    with pytest.raises(Exception, match="bad line"):
        D.ndjson_scan(spark, folder).collect()
    found = D.ndjson_scan(spark, folder, mode="quarantine").select("problem").collect()
    assert sorted(str(r["problem"]) for r in found) == [
        "None", "None", "bad_json", "bad_json", "bad_json", "bad_source", "no_index"]
    for narrow in (D.ndjson_scan(spark, folder).select("_index"), D.ndjson_scan(spark, folder).groupBy()):
        with pytest.raises(Exception, match="bad line"):
            narrow.count() if hasattr(narrow, "columns") else narrow.count().collect()


def test_create_twice_raises(spark):
    docs = docs_of(spark, ["{}"])
    root = scratch_path(spark, "t")
    assert sinks.create_if_absent(docs, root, "Mixed").endswith("/mixed")
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        sinks.create_if_absent(docs, root, "mixed")


def test_append(spark):
    docs = D.envelope(docs_of(spark, ["{}", '{"a": 1}', "[1]"]))
    path = scratch_path(spark, "t")
    with pytest.raises(Exception, match="bad_source"):
        sinks.append_validated(docs, path)
    for _ in range(2):
        assert sinks.append_validated(docs, path, on_bad="reject").count() == 1
    assert spark.read.parquet(path).count() == 4
    kept = scratch_path(spark, "t")
    for _ in range(2):
        sinks.append_validated(docs.union(docs), kept, on_bad="reject", keep_id=True)
        assert spark.read.parquet(kept).count() == 2
    named = scratch_path(spark, "t")
    for token, rows in (("a", 2), ("a", 2), ("b", 4)):
        sinks.append_validated(docs, named, on_bad="reject", token=token)
        assert spark.read.parquet(named).count() == rows


def test_ingest_does_not_repeat_after_a_restart(spark):
    folder, out = scratch_path(spark, "t"), scratch_path(spark, "t")
    write(spark, folder, LINES)
    for more in ([], [LINES[0].replace('"1"', '"9"')]):
        if more:
            write(spark, folder, more)
        J.stream_ingest(spark, folder, out).awaitTermination()
    assert J.ingested(spark, out).count() == 3
    assert J.ingested(spark, out, "quarantine").count() == 5
    # A batch that was written and not committed does not count.
    valid = spark.read.parquet(f"{out}/data/batch=0")
    valid.write.partitionBy("outcome").parquet(f"{out}/data/batch=9")
    assert J.ingested(spark, out).count() == 3
    assert J.ingested(spark, scratch_path(spark, "t")).count() == 0


def test_bad_generated_documents_are_not_lost(spark):
    docs = D.envelope(docs_of(spark, ["{}", "[1]"]))
    root = scratch_path(spark, "t")
    with pytest.raises(ValueError, match="bad_source"):
        sinks.load_collection(docs, [], root, "A")
    path, rejected = sinks.load_collection(docs, [docs], root, "B", on_bad="reject")
    assert rejected.count() == 2 and spark.read.parquet(path).count() == 2


def test_partials_count_once_and_whole(spark, monkeypatch):
    monkeypatch.setattr(J, "COMPACT", 3)
    folder, out = scratch_path(spark, "t"), scratch_path(spark, "t")
    for batch in range(8):
        write(spark, folder, [LINES[0].replace('"type": "a"', f'"type": "a", "n{batch}": 1')])
        J.stream_profile(spark, folder, out).awaitTermination()
        J.stream_kind_counts(spark, folder, f"{out}-kinds", "type").awaitTermination()
        # A partial that no line names does not count.
        J.committed(spark, out).write.parquet(f"{out}/parts/batch={batch}-torn")
        found = {r["key"]: (r["cnt"], r["probability"]) for r in J.current_profile(spark, out).collect()}
        assert found["type"] == (batch + 1, 100) and found[f"n{batch}"][0] == 1
        counts = J.current_counts(spark, f"{out}-kinds").collect()
        assert [(r["kind"], r["documents"]) for r in counts] == [("a", batch + 1)]
    assert len(J.committed(spark, out).inputFiles()) < 8 * 8


def test_a_replayed_batch_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(J, "COMPACT", 3)
    out = scratch_path(spark, "t")
    rows = spark.createDataFrame([("c", "a", 1)], "_index string, kind string, documents long")
    total = lambda parts: parts.groupBy("_index", "kind").agg(F.sum("documents").alias("documents"))
    for batch in (0, 1, 1, 2, 2, 2, 3, 4, 5, 5):
        J._commit(spark, rows, out, batch, total)
        assert J.current_counts(spark, out).first()["documents"] == batch + 1


def test_commits_stay_few(spark, monkeypatch):
    monkeypatch.setattr(J, "COMPACT", 10)
    out = scratch_path(spark, "t")
    rows = spark.createDataFrame([("c", "a", 1)], "_index string, kind string, documents long").coalesce(1)
    total = lambda parts: parts.groupBy("_index", "kind").agg(F.sum("documents").alias("documents"))
    earlier = None
    for batch in range(200):
        J._commit(spark, rows, out, batch, total)
        if earlier is not None:
            # Who read the commit before still finds all that it named.
            assert earlier.agg(F.sum("documents")).first()[0] == batch
        earlier = J.committed(spark, out) if batch % 25 in (8, 9) else None
        assert len(J.Log(spark, out)._commits()) <= J.KEPT
        assert len(J.Log(spark, out)._names("parts")) <= J.COMPACT + J.KEPT + 1
    assert J.current_counts(spark, out).first()["documents"] == 200


def test_kind_field_with_a_dot_names_one_key(spark):
    folder, out = scratch_path(spark, "t"), scratch_path(spark, "t")
    write(spark, folder, ['{"_index": "c", "seq": 1, "_source": {"a.b": "x", "a": {"b": "y"}}}'])
    J.stream_kind_counts(spark, folder, out, "a.b").awaitTermination()
    assert J.current_counts(spark, out).first()["kind"] == "x"
