"""Tables written once to the shared folder, so that lineage ends there, and batches in tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.session import scratch_path


# Rows and bytes of the batches that go to Python workers, of which an executor runs several.
BATCH_ROWS, BATCH_BYTES = 4000, "16m"


def small_batches(spark: SparkSession) -> None:
    """Lower the session's bounds of Arrow batches, unless they are lower already."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, BATCH_ROWS)
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back."""
    spark = df.sparkSession
    small_batches(spark)
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lowest(df: DataFrame, total: int, size: int, *keys: str | Column) -> DataFrame:
    """The ``size`` rows of lowest hash of ``keys``, out of ``total`` rows.

    A plain sort and limit would bring ``size`` rows of every partition to one place. Rows beyond a hash
    that about twice ``size`` rows stay below never leave theirs; should repeated keys leave fewer than ``size`` rows
    below it, the sample is smaller.
    """
    share = min(1.0, (2 * size + 1000) / max(total, 1))
    # The hash as a number from 0 to 1.
    place = F.xxhash64(*keys) / F.lit(2.0**64) + 0.5
    return df.withColumn("_place", place).where(F.col("_place") <= share).orderBy("_place", *keys).limit(size).drop("_place")
