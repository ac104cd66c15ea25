"""Writing document collections as Parquet folders, one partition per collection."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.values import value_type
from docloom.session import materialize


def create_if_absent(docs: DataFrame, root: str, collection: str) -> str:
    """Create a collection; an existing one raises. Names are lower-cased."""
    path = f"{root}/{collection.lower()}"
    docs.write.mode("errorifexists").parquet(path)
    return path


def _problem() -> Column:
    body = value_type(F.col("_source"))
    return (
        F.when(F.col("_index").isNull() | (F.col("_index") == ""), "no_index")
        .when(body.isNull() | (body != "object"), "bad_source")
    )


def _stored_ids(spark: SparkSession, path: str, mode: str) -> DataFrame | None:
    """Collections and ids below ``path``; None before anything was written there."""
    if mode != "append":
        return None
    try:
        stored = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    return stored.select("_index", "_id") if {"_index", "_id"} <= set(stored.columns) else None


def append_validated(
    docs: DataFrame, path: str, on_bad: str = "fail", keep_id: bool = False, mode: str = "append",
    token: str | None = None,
) -> DataFrame:
    """Append documents below ``path``, partitioned by collection; returns the rejected ones.

    Every document needs a non-empty ``_index`` and an object as ``_source``. The id is dropped,
    so writing twice duplicates, unless the call says otherwise: with ``keep_id=True`` an id that is stored
    already, or that the call repeats, is not written again, and with a ``token`` the rows of the call go
    to a folder of that name in each collection, which a repeated call replaces. Both leave the table
    as one whole call would, also after a call that broke in the middle.
    ``on_bad="fail"`` raises if there is a bad document and writes nothing, ``"reject"`` leaves it
    out. Documents are checked once, so the rejected rows are those that were not written.
    """
    checked = materialize(docs.withColumn("problem", _problem()), "checked")
    bad = checked.where(F.col("problem").isNotNull())
    if on_bad == "fail" and (first := bad.first()) is not None:
        raise ValueError(f"document not fit to be written: {first['problem']}")
    good = checked.where(F.col("problem").isNull()).drop("problem")
    if keep_id:
        # A document without an id is always new.
        named = good.where(F.col("_id").isNotNull()).dropDuplicates(["_index", "_id"])
        stored = _stored_ids(docs.sparkSession, path, mode) if token is None else None
        if stored is not None:
            named = named.join(stored, ["_index", "_id"], "left_anti")
        good = named.unionByName(good.where(F.col("_id").isNull()))
    else:
        good = good.drop("_id")
    if token is None:
        good.write.mode(mode).partitionBy("_index").parquet(path)
    else:
        dealt = good.withColumn("_batch", F.lit(token))
        writer = dealt.write.mode("overwrite" if mode == "append" else mode)
        writer.option("partitionOverwriteMode", "dynamic").partitionBy("_index", "_batch").parquet(path)
    return bad


def load_collection(
    generated: DataFrame, files: list[DataFrame], root: str, collection: str, on_bad: str = "fail"
) -> tuple[str, DataFrame]:
    """Create a collection with one generated document per kind, then append its files.

    Returns its folder and the documents that were rejected, generated ones included; with
    ``on_bad="fail"`` any of them raises.
    """
    path = f"{root}/{collection.lower()}"
    columns = ["_index", "_id", "_source"]
    rejected = append_validated(generated.select(columns), path, on_bad, mode="errorifexists")
    for docs in files:
        rejected = rejected.unionByName(append_validated(docs.select(columns), path, on_bad))
    return path, rejected
