"""Registered queries: stream jobs drained over the events table written as lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom.plans.registry import query
from docloom.session import scratch_path
from docloom.sources import fixtures as X
from docloom.streaming import jobs as J

_LINES = "WITH" + X.LINES_SQL + "," + X.EVENT_FIELDS_SQL


def _folder(spark, sf) -> str:
    """Several files, so that the jobs see several batches."""
    path = scratch_path(spark, "stream-in")
    X.event_lines(spark, sf).repartition(6).write.text(path)
    return path


@query(
    "stream_ingest",
    _LINES + """
    SELECT CASE problem WHEN '' THEN 'valid' ELSE problem END AS outcome, count(*) AS documents,
           CAST(sum(CASE problem WHEN '' THEN seq ELSE 0 END) AS BIGINT) AS seq_sum
    FROM lines GROUP BY 1""",
)
def stream_ingest(spark, sf):
    out = scratch_path(spark, "stream-ingest")
    J.stream_ingest(spark, _folder(spark, sf), out, max_files=2).awaitTermination()
    valid = J.ingested(spark, out).select(F.lit("valid").alias("outcome"), "seq")
    bad = J.ingested(spark, out, "quarantine").select(
        F.col("problem").alias("outcome"), F.lit(0).cast("bigint").alias("seq")
    )
    return valid.unionByName(bad).groupBy("outcome").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("seq").alias("seq_sum")
    )


@query(
    "stream_profile",
    _LINES + """,
    good AS (SELECT f.* FROM event_fields f JOIN lines USING (seq) WHERE problem = '')
    SELECT _index, key, count(*) AS cnt,
      CASE WHEN bool_or(type = 'string') THEN 'string' ELSE arg_max(type, seq) END AS type,
      CAST(floor(CAST(count(*) AS DOUBLE) / (SELECT count(DISTINCT seq) FROM good) * 100 + 0.5) AS INT)
        AS probability
    FROM good GROUP BY 1, 2""",
)
def stream_profile(spark, sf):
    out = scratch_path(spark, "stream-profile")
    J.stream_profile(spark, _folder(spark, sf), out, max_files=2).awaitTermination()
    return J.current_profile(spark, out)


@query(
    "stream_kind_counts",
    _LINES + """ SELECT 'events' AS _index, event_type AS kind, count(*) AS documents
    FROM lines WHERE problem = '' GROUP BY 2""",
)
def stream_kind_counts(spark, sf):
    out = scratch_path(spark, "stream-kinds")
    J.stream_kind_counts(spark, _folder(spark, sf), out, "type", max_files=2).awaitTermination()
    return J.current_counts(spark, out)
