"""Mix sources to target weights with native expressions only.

Words per source are aggregated first, targets follow by filling up to a ceiling, and a rate of
repetition per source turns into whole copies plus one hash-seeded Bernoulli copy per document.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.store import stored

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words as a long; a null or empty text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(seed: str, doc_id: Column, text: Column) -> Column:
    """Uniform number in [0, 1) from the identity of a document.

    A document without id draws by its text. Rows that repeat an id share the draw.
    """
    name = F.coalesce(doc_id.cast("string"), F.concat(F.lit("t"), F.md5(F.coalesce(text, F.lit("")))))
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), name)), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 52))


def _ranked(sources: DataFrame) -> DataFrame:
    """``sources`` with ``position`` by code point, null last, without one task holding all.

    A global sort numbers the rows of its partitions; the offsets of partitions are added after.
    """
    placed = stored(
        sources.orderBy(F.col("source").asc_nulls_last()).withColumn(
            "slot", F.monotonically_increasing_id()
        ),
        "mix-order",
    ).withColumn("part", F.shiftright("slot", 33)).withColumn(
        "inside", F.col("slot").bitwiseAND(F.lit((1 << 33) - 1))
    )
    # One row per partition of the sort, whatever the number of sources.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    )
    return placed.join(parts, "part").select(
        "source", "source_size", (F.col("offset") + F.col("inside")).alias("position")
    )


def source_targets(
    sized: DataFrame, weights: Sequence[float], share: float, ceiling: float
) -> DataFrame:
    """(source, source_size, target) of rows with ``source`` and ``size``.

    The target of a source is its part by weight of ``share`` times all sizes, at most
    ``ceiling`` times its own size; what lies above is shared again among the others. Only the
    totals of a round reach the driver. Without sources the result is empty.
    """
    sources = _ranked(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    slots = F.array(*[F.lit(float(w)) for w in weights])
    weighed = stored(
        sources.select(
            "source",
            "source_size",
            F.element_at(slots, (F.col("position") % len(weights) + 1).cast("int")).alias("weight"),
            (F.col("source_size") * F.lit(float(ceiling))).alias("cap"),
        ),
        "mix-sources",
    )
    total = weighed.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    if total["weight"] is None:
        return weighed.select("source", "source_size", F.lit(0.0).alias("target"))
    budget = share * total["size"]
    level, full = budget / total["weight"], 0
    while True:
        above = F.col("cap") < F.lit(level) * F.col("weight")
        found = weighed.agg(
            F.count(F.when(above, 1)).alias("full"),
            F.coalesce(F.sum(F.when(above, F.col("cap"))), F.lit(0.0)).alias("cap"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0)).alias("weight"),
        ).first()
        if found["full"] == full or found["weight"] == 0:
            break
        full, level = found["full"], (budget - found["cap"]) / found["weight"]
    water = F.lit(level) * F.col("weight")
    return weighed.select("source", "source_size", F.least("cap", water).alias("target"))


def copies_per_document(
    docs: DataFrame,
    keep: Sequence[str],
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    ceiling: float = 2.0,
    seed: str = "mix",
) -> DataFrame:
    """``keep`` columns, size, source_size, target and copies of every document.

    Copies are floor(rate) plus one more with probability equal to the fraction, where the rate
    is target over source_size. The draw depends on seed and document alone, so reruns agree. A
    null source is a source, the last one. Documents of a source without words get no copies.
    """
    sized = stored(
        docs.select(
            F.col("doc_id").alias("_doc"),
            F.col("source").alias("_source"),
            word_count(F.col("text")).alias("_size"),
            draw(seed, F.col("doc_id"), F.col("text")).alias("_draw"),
            F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"),
        ),
        "mix-sizes",
    )
    targets = source_targets(
        sized.select(F.col("_source").alias("source"), F.col("_size").alias("size")),
        weights, share, ceiling,
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor("rate")
    return (
        sized.join(targets, sized["_source"].eqNullSafe(targets["source"]))
        .withColumn("rate", rate)
        .select(
            "_row", F.col("_size").alias("size"), "source_size", "target",
            (whole + F.when(F.col("_draw") < F.col("rate") - whole, 1).otherwise(0)).alias("copies"),
        )
    )


def mix_query(spark, sf_dir: str) -> DataFrame:
    """Size, source size, target and words taken of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return copies_per_document(docs, ["doc_id"]).select(
        "_row.doc_id", "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def emit(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    counted = copies_per_document(docs, docs.columns, **options)
    return counted.where("copies > 0").select(
        F.explode(F.array_repeat("_row", F.col("copies").cast("int"))).alias("_row")
    ).select("_row.*")


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 't' || md5(coalesce(text, '')))),
                          1, 13))::BIGINT)::DOUBLE / 4503599627370496.0 AS draw
  FROM documents),
by_source AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE
         AS weight, source_size * 2.0::DOUBLE AS cap FROM by_source),
filled AS (
  SELECT *, cap < weight * ((1.5::DOUBLE * sum(source_size) OVER ()
      - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
                          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS above
  FROM weighed),
level AS (
  SELECT (1.5::DOUBLE * sum(source_size) - coalesce(sum(cap) FILTER (above), 0))
         / sum(weight) FILTER (NOT above) AS water FROM filled),
targets AS (
  SELECT source, source_size, least(cap, water * weight) AS target,
         CASE WHEN source_size > 0 THEN least(cap, water * weight) / source_size ELSE 0.0 END AS rate
  FROM filled, level)
SELECT doc_id, size, source_size, target,
       ((floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
"""
