"""Stream jobs: ingest of a growing folder of lines, a profile kept current, running kind counts.

Each job takes its folders from the caller, who keeps the same ones across restarts; below them a job
removes the partials that it has replaced, and nothing else. The trigger is "all that is there, then
stop" unless a refresh interval is given.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from docloom.functions.values import label_text
from docloom.operators.profile import field_stats, fields, percent, stats_type
from docloom.session import materialize
from docloom.sources.documents import checked_lines

# Partials that are merged into one, and commits that stay readable.
COMPACT, KEPT = 50, 3
PARTIAL = ("_index", "key", "cnt", "last_seq", "last_code", "any_string")
Merge = Callable[[DataFrame], DataFrame]


def triggered(writer: DataStreamWriter, refresh_interval: str | None) -> DataStreamWriter:
    """``None`` and negative intervals drain what is there; otherwise refresh at that pace."""
    if refresh_interval is None or refresh_interval.strip().startswith("-"):
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=refresh_interval)


def line_stream(spark: SparkSession, folder: str, max_files: int = 1000) -> DataFrame:
    """New lines of a folder, checked and parsed."""
    lines = spark.readStream.option("maxFilesPerTrigger", max_files).text(folder)
    return checked_lines(lines)


class Log:
    """What counts of a stream's output: a small file per commit that names all live partials.

    ``{"high": batch, "parts": [...]}`` is written beside its place and renamed, so a reader sees a whole commit
    or the one before. A batch that is committed already is not written again, so a replay changes
    nothing. The last ``KEPT`` commits and the partials that they name stay, so that a reader who took
    the one before can finish; older ones are removed.
    """

    def __init__(self, spark: SparkSession, out: str):
        self.out = out.rstrip("/")
        jvm = spark._jvm.org.apache.hadoop.fs
        self.path = jvm.Path
        self.files = self.path(self.out).getFileSystem(spark._jsc.hadoopConfiguration())
        self.read_all = spark._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray

    def _names(self, folder: str) -> list[str]:
        where = self.path(f"{self.out}/{folder}")
        if not self.files.exists(where):
            return []
        return sorted(f.getPath().getName() for f in self.files.listStatus(where))

    def _commits(self) -> list[str]:
        return [n for n in self._names("commits") if n.endswith(".json")]

    def _load(self, name: str) -> dict:
        stream = self.files.open(self.path(f"{self.out}/commits/{name}"))
        try:
            return json.loads(bytes(self.read_all(stream)))
        finally:
            stream.close()

    def last(self) -> dict:
        """The newest commit; before any, one that names nothing."""
        found = self._commits()
        return self._load(found[-1]) if found else {"high": -1, "parts": []}

    def commit(self, high: int, parts: list[str]) -> None:
        place = f"{self.out}/commits/{high:012d}.json"
        beside = self.path(f"{self.out}/commits/.{uuid.uuid4().hex}")
        stream = self.files.create(beside, True)
        stream.write(json.dumps({"high": high, "parts": parts}).encode())
        stream.close()
        if not self.files.rename(beside, self.path(place)):
            raise OSError(f"commit {place} is there already")
        self._retire()

    def _retire(self) -> None:
        found = self._commits()
        live = {part for name in found[-KEPT:] for part in self._load(name)["parts"]}
        for name in found[:-KEPT]:
            self.files.delete(self.path(f"{self.out}/commits/{name}"), False)
        if found and self._load(found[-1])["parts"]:
            for name in self._names("parts"):
                if f"parts/{name}" not in live:
                    self.files.delete(self.path(f"{self.out}/parts/{name}"), True)


def stream_ingest(
    spark: SparkSession, folder: str, out: str, max_files: int = 1000,
    refresh_interval: str | None = None,
) -> StreamingQuery:
    """Lines of a growing folder, parsed once, as documents and as quarantined lines below ``out``.

    A batch is one write, of both kinds of rows, to a folder of its number, and counts once the log says
    so; ``ingested`` reads what counts. A batch that runs again replaces its own folder.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        log = Log(spark, out)
        if log.last()["high"] >= batch_id:
            return
        valid = F.col("problem").isNull()
        rows = batch.select(
            "_index", "_id", "seq", F.when(valid, F.col("_source")).alias("_source"),
            F.when(~valid, F.col("line")).alias("line"), "problem",
            F.when(valid, "valid").otherwise("quarantine").alias("outcome"),
        )
        rows.write.mode("overwrite").partitionBy("outcome").parquet(f"{out}/data/batch={batch_id}")
        log.commit(batch_id, [])

    lines = line_stream(spark, folder, max_files)
    return triggered(
        lines.writeStream.foreachBatch(write).option("checkpointLocation", f"{out}/_checkpoint"), refresh_interval
    ).start()


_INGESTED = "_index string, _id string, seq long, _source variant, line string, problem string, batch long, outcome string"


def ingested(spark: SparkSession, out: str, outcome: str = "valid") -> DataFrame:
    """Documents (``valid``) or lines with their problem (``quarantine``) of all committed batches."""
    high = Log(spark, out).last()["high"]
    columns = ["_index", "_id", "seq", "_source"] if outcome == "valid" else ["line", "problem"]
    if high < 0:
        return spark.createDataFrame([], _INGESTED).select(columns)
    rows = spark.read.schema(_INGESTED).option("basePath", f"{out}/data").parquet(f"{out}/data")
    return rows.where((F.col("batch") <= high) & (F.col("outcome") == outcome)).select(columns)


def _commit(spark: SparkSession, rows: DataFrame, out: str, batch_id: int, merge: Merge) -> None:
    """Write the partial of a batch, then the commit that makes it count.

    Every ``COMPACT`` batches all that counts is merged into one partial, which replaces what it covers.
    """
    log = Log(spark, out)
    last = log.last()
    if last["high"] >= batch_id:
        return
    part = f"parts/batch={batch_id}-{uuid.uuid4().hex}"
    parts = [*last["parts"], part]
    if len(parts) >= COMPACT:
        rows = merge(_read_parts(spark, out, last["parts"]).unionByName(rows)) if last["parts"] else rows
        parts = [part]
    rows.write.parquet(f"{out}/{part}")
    log.commit(batch_id, parts)


def _read_parts(spark: SparkSession, out: str, parts: list[str]) -> DataFrame:
    return spark.read.parquet(*[f"{out}/{part}" for part in parts])


def committed(spark: SparkSession, out: str) -> DataFrame | None:
    """The partials that count, at most ``COMPACT``; None before any."""
    parts = Log(spark, out).last()["parts"]
    return _read_parts(spark, out, parts) if parts else None


def _merged_profile(parts: DataFrame) -> DataFrame:
    return parts.groupBy("_index", "key").agg(
        F.sum("cnt").alias("cnt"),
        F.max_by("last_code", "last_seq").alias("last_code"),
        F.max("last_seq").alias("last_seq"),
        F.max("any_string").alias("any_string"),
    )


def stream_profile(
    spark: SparkSession, folder: str, out: str, max_files: int = 1000,
    refresh_interval: str | None = None,
) -> StreamingQuery:
    """Write a partial field profile per batch; ``current_profile`` merges them.

    Fields and totals are rows of one table, so that they are written together; a total has no key.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        docs = batch.select("_index", "seq", F.to_json("_source").alias("raw")).persist()
        totals = docs.groupBy("_index").agg(F.count(F.lit(1)).alias("cnt"))
        found = field_stats(fields(docs)).select(*PARTIAL)
        rows = found.unionByName(totals, allowMissingColumns=True)
        _commit(spark, rows, out, batch_id, lambda parts: _merged_profile(parts).select(*PARTIAL))
        docs.unpersist()

    valid = line_stream(spark, folder, max_files).where(F.col("problem").isNull())
    return triggered(
        valid.writeStream.foreachBatch(write).option("checkpointLocation", f"{out}/_checkpoint"),
        refresh_interval,
    ).start()


def current_profile(spark: SparkSession, out: str) -> DataFrame:
    """Presence, type and probability per field over all committed batches."""
    merged = materialize(_merged_profile(committed(spark, out)), "stream-profile")
    totals = merged.where(F.col("key").isNull()).select("_index", F.col("cnt").alias("total"))
    return merged.where(F.col("key").isNotNull()).join(totals, "_index").select(
        "_index", "key", "cnt", stats_type().alias("type"),
        percent(F.col("cnt"), F.col("total")).alias("probability"),
    )


def stream_kind_counts(
    spark: SparkSession, folder: str, out: str, kind_field: str, max_files: int = 1000,
    refresh_interval: str | None = None,
) -> StreamingQuery:
    """Documents per collection and kind, a partial count per batch; ``current_counts`` sums them."""

    def summed(parts: DataFrame) -> DataFrame:
        return parts.groupBy("_index", "kind").agg(F.sum("documents").alias("documents"))

    def write(batch: DataFrame, batch_id: int) -> None:
        value = F.try_element_at(
            F.try_variant_get("_source", "$", "map<string,variant>"), F.lit(kind_field)
        )
        kinds = batch.select("_index", value.alias("_value"))
        rows = kinds.groupBy("_index", label_text(F.col("_value")).alias("kind")).agg(
            F.count(F.lit(1)).alias("documents")
        )
        _commit(spark, rows, out, batch_id, summed)

    valid = line_stream(spark, folder, max_files).where(F.col("problem").isNull())
    return triggered(
        valid.writeStream.foreachBatch(write).option("checkpointLocation", f"{out}/_checkpoint"),
        refresh_interval,
    ).start()


def current_counts(spark: SparkSession, out: str) -> DataFrame:
    """The counts over all committed batches."""
    return committed(spark, out).groupBy("_index", "kind").agg(F.sum("documents").alias("documents"))
