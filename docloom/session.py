"""Session for local runs, and tables in the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_scratch: dict[str, str] = {}


def local_session(cores: int | str = 8, shuffle_partitions: int | None = None) -> SparkSession:
    """Session for tests and the benchmark. On a cluster use the session the cluster gives."""
    partitions = shuffle_partitions or (cores if isinstance(cores, int) else 8)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("docloom")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", "")
    if shared:
        return shared
    master = spark.conf.get("spark.master", "local")
    if master != "local" and not master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    app = spark.sparkContext.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="docloom-")
    return _local_scratch[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{scratch_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "table", compression: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet to the shared folder and read it back."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
