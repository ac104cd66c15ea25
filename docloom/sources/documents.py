"""Reading document collections: envelope, catalog, counts, sampling, newline-delimited JSON.

A document row is ``(_index STRING, _id STRING, seq BIGINT, raw STRING)``: the collection, the
document id, a unique position inside the collection, and the JSON text of the body.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.functions.values import parse_document, value_type
from docloom.session import materialize

ENVELOPE = ["_index", "_id", "_source"]
# Buckets per histogram round when looking for the n-th position of a collection.
HISTOGRAM_BUCKETS = 4096
# A range with no more rows than this is ranked instead of cut again.
RANKED_ROWS = 100_000


def with_source(docs: DataFrame) -> DataFrame:
    """Add ``_source``: the parsed body, NULL when the text is not one JSON value."""
    return docs.withColumn("_source", parse_document(F.col("raw")))


def parsed_once(docs: DataFrame, *keep: str) -> DataFrame:
    """Documents with their body parsed, written so that whatever reads them parses no text again.

    Adds ``_source``, the body where it is one whole JSON object and else NULL, and ``_keys``, its keys in
    the order of the text; ``keep`` names the other columns, all of them by default. Functions that take
    documents use these columns where they are.
    """
    if "_source" in docs.columns:
        return docs
    rows = docs.select(*(keep or docs.columns), parse_document(F.col("raw")).alias("_body"), F.json_object_keys("raw").alias("_all"))
    # The type of the body comes from the members that are looked up, not from a look at all of it.
    whole = F.try_variant_get("_body", "$", "map<string,variant>").isNotNull()
    parsed = rows.select(
        *(keep or docs.columns), F.when(whole, F.col("_body")).alias("_source"), F.when(whole, F.col("_all")).alias("_keys")
    )
    return materialize(parsed, "parsed")


def envelope(docs: DataFrame) -> DataFrame:
    """The three service columns: collection name, document id, body."""
    return with_source(docs).select(*ENVELOPE)


# Fixed value: the name form of one family of system collections.
SYSTEM_NAME = r"(?i)^apm-[0-9]+\.[0-9]+\.[0-9]+"


def is_system(name: Column) -> Column:
    """System collections: a leading dot, or ``apm-`` and a three-part version, any case."""
    return name.startswith(".") | name.rlike(SYSTEM_NAME)


def catalog_filtered(docs: DataFrame, include_system: bool = False) -> DataFrame:
    """Collections and their document counts, system ones left out unless asked for."""
    kept = docs if include_system else docs.where(~is_system(F.col("_index")))
    return kept.groupBy("_index").agg(F.count(F.lit(1)).alias("documents"))


def count_docs(docs: DataFrame) -> DataFrame:
    """Document count per collection."""
    return docs.groupBy("_index").agg(F.count(F.lit(1)).alias("documents"))


def sample_size(
    counts: DataFrame,
    absolute: int | None = None,
    percent: float | None = None,
    max_value: int | None = None,
) -> DataFrame:
    """Sample size per collection from its ``documents`` count.

    Absolute: the number as given, capped by nothing. Relative: the percentage rounded up,
    at most ``max_value``.
    """
    if absolute is not None:
        return counts.withColumn("size", F.lit(int(absolute)).cast("bigint"))
    share = F.ceil(F.col("documents") * F.lit(percent) / F.lit(100)).cast("bigint")
    return counts.withColumn("size", F.least(share, F.lit(int(max_value)).cast("bigint")))


def scan_limit(docs: DataFrame, collection: str, size: int) -> DataFrame:
    """The first ``size`` documents of one collection, by ``seq`` and then ``_id``."""
    one = docs.where(F.col("_index") == collection)
    sizes = count_docs(one.select("_index")).withColumn("size", F.lit(size).cast("bigint"))
    return first_documents(one, sizes)


def sampled_read(docs: DataFrame, **settings) -> DataFrame:
    """Count, size and read all collections in one job; settings as for ``sample_size``."""
    return first_documents(docs, sample_size(count_docs(docs), **settings))


def first_documents(docs: DataFrame, sizes: DataFrame) -> DataFrame:
    """The first ``size`` documents of every collection by ``seq`` and ``_id``, for any size.

    ``sizes`` has ``(_index, documents, size)``. No collection is sorted: bucket counts over
    ``seq`` narrow the range that holds the n-th position of each collection, round by round,
    until few documents are left in it or it is one ``seq``; only those are ranked, and the
    documents themselves are then filtered. Rows that repeat both seq and id count one by one.
    """
    positions = docs.select("_index", "seq", "_id")
    wanted = sizes.where((F.col("size") > 0) & (F.col("size") < F.col("documents")))
    ends = positions.groupBy("_index").agg(F.min("seq").alias("low"), F.max("seq").alias("high"))
    # Ranges as decimals: the distance of two positions may not fit a long.
    ranges = materialize(
        ends.join(wanted, "_index").select(
            "_index", "low", "high", F.col("size").alias("left"), F.col("documents").alias("inside")
        ),
        "ranges",
    )
    while True:
        open_ = (F.col("inside") > RANKED_ROWS) & (F.col("low") < F.col("high"))
        if ranges.where(open_).isEmpty():
            break
        ranges = materialize(_narrowed(positions, ranges.where(open_)).unionByName(ranges.where(~open_)), "ranges")
    in_range = F.col("seq").between(F.col("low"), F.col("high"))
    order = Window.partitionBy("_index").orderBy("seq", "_id")
    last = (
        positions.join(ranges, "_index").where(in_range)
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= F.col("left"))
        .select("_index", "seq", "_id")
    )
    low = ranges.select("_index", "low", "high")
    whole = sizes.where((F.col("size") >= F.col("documents")) & (F.col("size") > 0)).select("_index")
    named = docs.join(low, "_index")
    before = named.where(F.col("seq") < F.col("low")).select(docs.columns)
    # Repeated rows of the last range come as often as they were ranked.
    counted = last.groupBy("_index", "seq", "_id").agg(F.count(F.lit(1)).alias("_times"))
    copy = Window.partitionBy("_index", "seq", "_id").orderBy(F.lit(1))
    edge = (
        named.where(in_range)
        .join(counted, ["_index", "seq", "_id"])
        .withColumn("_copy", F.row_number().over(copy))
        .where(F.col("_copy") <= F.col("_times"))
        .select(docs.columns)
    )
    return docs.join(whole, "_index", "left_semi").unionByName(before).unionByName(edge)


def _narrowed(positions: DataFrame, ranges: DataFrame) -> DataFrame:
    """``ranges`` cut down to the bucket that holds the position looked for."""
    width = F.ceil(
        (F.col("high").cast("decimal(20,0)") - F.col("low") + 1) / F.lit(HISTOGRAM_BUCKETS)
    ).cast("decimal(20,0)")
    start = F.col("low") + F.col("bucket") * width
    inside = positions.join(ranges, "_index").where(F.col("seq").between(F.col("low"), F.col("high")))
    bucket = F.floor((F.col("seq").cast("decimal(20,0)") - F.col("low")) / width).cast("bigint")
    counted = inside.groupBy("_index", "low", "high", "left", bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("n")
    )
    # At most HISTOGRAM_BUCKETS rows per collection.
    below = Window.partitionBy("_index").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("before", F.coalesce(F.sum("n").over(below), F.lit(0)))
    held = (F.col("before") < F.col("left")) & (F.col("left") <= F.col("before") + F.col("n"))
    return placed.where(held).select(
        "_index", start.cast("bigint").alias("low"),
        F.least(F.col("high").cast("decimal(20,0)"), start + width - 1).cast("bigint").alias("high"),
        (F.col("left") - F.col("before")).alias("left"), F.col("n").alias("inside"),
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per text line, empty lines included."""
    return spark.read.text(path)


def checked_lines(lines: DataFrame) -> DataFrame:
    """Parse lines of ``{"_index", "_id", "seq", "_source"}`` and say what is wrong with each.

    ``problem`` is NULL for a good line, else ``bad_json`` (empty lines too), ``no_index`` or
    ``bad_source``.
    """
    doc = parse_document(F.col("value"))
    body = F.try_variant_get("doc", "$._source", "variant")
    index = F.try_variant_get("doc", "$._index", "string")
    return (
        lines.withColumn("doc", doc)
        .select(
            F.col("value").alias("line"),
            index.alias("_index"),
            F.try_variant_get("doc", "$._id", "string").alias("_id"),
            F.try_variant_get("doc", "$.seq", "bigint").alias("seq"),
            body.alias("_source"),
            F.when(F.col("doc").isNull(), "bad_json")
            .when(index.isNull() | (index == ""), "no_index")
            .when(body.isNull() | (value_type(body) != "object"), "bad_source")
            .alias("problem"),
        )
    )


def ndjson_scan(spark: SparkSession, path: str, mode: str = "fail") -> DataFrame:
    """Read a newline-delimited file of documents.

    ``mode="fail"``: a line that is not JSON ends the job with an error. ``mode="quarantine"``:
    every line comes back with its ``problem``, and the caller splits on it.
    """
    lines = checked_lines(read_lines(spark, path))
    if mode == "quarantine":
        return lines
    # A filter, so that no choice of columns can leave the check out.
    bad = F.raise_error(F.concat(F.lit("bad line: "), "line")).cast("boolean")
    return lines.where(F.when(F.col("problem") == "bad_json", bad).otherwise(F.lit(True)))
