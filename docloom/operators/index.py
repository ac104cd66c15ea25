"""Stored indexes: postings with scored blocks for ranked search, and inputs for completion.

Both are written once and then answer any number of queries, which read no text. Files lie below a
folder of the caller's. What a query brings to the driver is bounded by its terms.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.functions.analysis import Analyzer, prefixes, simple
from docloom.functions.rows import explode_rows, inline_rows
from docloom.operators.terms import K1, B, _top, doc_terms
from docloom.session import materialize

# Steps of a term's weight in a document, entries of a block, folders of terms, and entries of a file.
LEVELS, BLOCK, BUCKETS, FILE_ENTRIES = 32, 256, 64, 1_000_000
# Terms whose numbers are sent to every task while an index is built.
FREQUENT = 200_000
# Scores are compared after rounding to six digits.
SLACK = 1e-6
MODELS = ("bm25", "classic", "boolean")


def _bucket(field: Column, term: Column) -> Column:
    return F.pmod(F.xxhash64(field, term), F.lit(BUCKETS)).cast("int")


def _saturated(mean: Column, freq: Column, length: Column) -> Column:
    """Weight of a term in a document by its count and the document's length."""
    return freq * (K1 + 1) / (freq + K1 * (1 - B + B * length / mean))


def _share(freq: Column, norm: Column) -> Column:
    """Part that a term's count has in the length of its document's vector."""
    return F.when(norm > 0, freq / norm).otherwise(0.0)


def build_index(docs: DataFrame, doc: str, fields: dict[str, tuple[str, Analyzer]], path: str) -> None:
    """Write the index of some text columns: ``fields`` gives each field's column and analyzer.

    Postings of a term are dealt to levels by what they add to a score, and inside a level by the hash
    of the document to blocks of about ``BLOCK`` entries, so that a term of any frequency is many blocks.
    Tables: ``fields`` (documents and mean length), ``levels`` (entries, blocks and highest weights of
    each level of a term), ``blocks``. Every row of ``docs`` is a document, with an id of its own.

    The terms of a document cross the network once in its row, to get its norm, and once as entries, to
    get to their blocks. What is asked of the corpus about a term comes to the entries of frequent terms as a
    small table of at most ``FREQUENT``; only the entries of the others are sent to their term, and those keep
    each of their levels in one block.
    """
    analyzed = None
    for field, (text, analyzer) in fields.items():
        found = doc_terms(docs, doc, text, analyzer)
        length = F.aggregate("terms", F.lit(0), lambda n, t: n + t["freq"])
        rows = found.select(F.lit(field).alias("field"), F.col(doc).alias("doc"), length.alias("length"), "terms")
        analyzed = rows if analyzed is None else analyzed.unionByName(rows)
    analyzed = materialize(analyzed, "analyzed", compression="zstd")
    sizes = materialize(
        analyzed.groupBy("field").agg(
            F.count(F.lit(1)).cast("double").alias("n"), F.avg("length").alias("mean")
        ), "fields",
    )
    sizes.write.parquet(f"{path}/fields")
    entries = inline_rows(analyzed, F.col("terms"), ["term", "freq"], "field", "doc", "length")
    # Fields are as few as the caller names.
    means = F.broadcast(sizes.select("field", "mean"))

    def leveled(rows: DataFrame) -> DataFrame:
        impact = F.least(F.lit(LEVELS - 1), F.floor(F.col("impact") / (K1 + 1) * LEVELS))
        return (
            rows.join(means, "field").withColumn("impact", _saturated(F.col("mean"), F.col("freq"), F.col("length")))
            .withColumn("level", impact.cast("int")).drop("mean")
        )

    key = ["field", "term", "level"]
    counts = materialize(
        leveled(entries).groupBy(*key).agg(F.count(F.lit(1)).alias("entries")), "counts", compression="zstd"
    )
    terms = materialize(counts.groupBy("field", "term").agg(F.sum("entries").alias("df")), "terms")
    # The bound on entries is doubled until no more than FREQUENT terms are above it.
    bounds = [0, *(1 << i for i in range(62))]
    above = terms.agg(*[F.count(F.when(F.col("df") > x, 1)).alias(str(x)) for x in bounds]).first()
    bound = next(x for x, n in zip(bounds, above, strict=True) if n <= FREQUENT)
    frequent = terms.where(F.col("df") > bound)
    rare = terms.where(F.col("df") <= bound) if bound else None
    norms = _norms(entries, rare, F.broadcast(frequent), sizes)
    long = frequent.where(F.col("df") > BLOCK).select("field", "term")
    large = F.broadcast(materialize(
        counts.where(F.col("entries") > BLOCK).join(F.broadcast(long), ["field", "term"], "left_semi")
        .select(*key, F.ceil(F.col("entries") / BLOCK).cast("int").alias("blocks")), "large-levels",
    ))
    count = terms.agg(F.coalesce(F.sum("df"), F.lit(0))).first()[0]
    spread = max(1, math.ceil(count / (BUCKETS * FILE_ENTRIES)))
    # Two arrays of plain values are half as long on the way as one of structs.
    split = analyzed.select("field", "doc", "length", "terms.term", "terms.freq")
    normed = inline_rows(
        split.join(norms, ["field", "doc"]), F.arrays_zip("term", "freq"), ["term", "freq"], "field", "doc", "length", "norm"
    )
    placed = (
        leveled(normed).drop("impact")
        .join(large, key, "left")
        .withColumn("block", F.pmod(F.xxhash64("doc"), F.coalesce("blocks", F.lit(1))).cast("int"))
        .drop("blocks")
        .withColumn("bucket", _bucket(F.col("field"), F.col("term")))
        .withColumn("part", F.pmod(F.xxhash64("term", "level", "block"), F.lit(spread)).cast("int"))
    )
    # The parts that the entries are dealt to are whole groups of the blocks, so that nothing is dealt twice.
    blocks = (
        placed.repartition("bucket", "part")
        .groupBy("bucket", "part", *key, "block")
        .agg(F.collect_list(F.struct("doc", "freq", "length", "norm")).alias("postings"))
    )
    blocks = blocks.drop("part").sortWithinPartitions("bucket", *key, "block")
    blocks.write.partitionBy("bucket").parquet(f"{path}/blocks", compression="zstd")
    _write_levels(docs.sparkSession.read.parquet(f"{path}/blocks"), means, large, path)


def _norms(entries: DataFrame, rare: DataFrame | None, frequent: DataFrame, sizes: DataFrame) -> DataFrame:
    """``(field, doc, norm)``: the length of each document's vector of weighted terms."""
    n = F.broadcast(sizes.select("field", "n"))
    entries = entries.select("field", "doc", "term", "freq")
    if rare is None:
        weighed = entries.join(frequent, ["field", "term"])
    else:
        # The frequent terms are a small table, and the others have few entries each: no task gets a long one.
        known = entries.join(frequent, ["field", "term"], "left")
        others = known.where(F.col("df").isNull()).drop("df").join(rare, ["field", "term"])
        weighed = known.where(F.col("df").isNotNull()).unionByName(others)
    w = F.col("freq") * F.log(F.col("n") / F.col("df"))
    return (
        weighed.join(n, "field").select("field", "doc", w.alias("w"))
        .groupBy("field", "doc").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    )


def _write_levels(blocks: DataFrame, means: DataFrame, large: DataFrame, path: str) -> None:
    """Entries, blocks and highest weights of each level of a term, from its blocks."""
    impact = F.transform("postings", lambda p: _saturated(F.col("mean"), p["freq"], p["length"]))
    share = F.transform("postings", lambda p: _share(p["freq"], p["norm"]))
    held = blocks.join(means, "field").select(
        "bucket", "field", "term", "level", F.size("postings").alias("entries"),
        F.array_max(impact).alias("impact"), F.array_max(share).alias("share"),
    )
    # A folder's rows go to one task, as they are written; a term has no more rows than levels.
    levels = held.repartition("bucket").groupBy("bucket", "field", "term", "level").agg(
        F.sum(F.col("entries").cast("bigint")).alias("entries"), F.max("impact").alias("impact"), F.max("share").alias("share")
    )
    df = F.sum("entries").over(Window.partitionBy("bucket", "field", "term"))
    counted = levels.withColumn("df", df).join(large, ["field", "term", "level"], "left")
    rows = counted.withColumn("blocks", F.coalesce("blocks", F.lit(1))).sortWithinPartitions("bucket", "field", "term")
    rows.write.partitionBy("bucket").parquet(f"{path}/levels", compression="zstd")


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda one, two: one | two, conditions, F.lit(False))


class _Search:
    """One query over an index: its terms' levels with their bounds, and readings of their blocks."""

    def __init__(self, spark: SparkSession, path: str, asked: dict[str, list[str]], model: str, boosts: dict[str, float]):
        self.blocks = spark.read.parquet(f"{path}/blocks")
        self.model = model
        sizes = {r["field"]: r for r in spark.read.parquet(f"{path}/fields").collect()}
        wanted = {f: list(dict.fromkeys(terms)) for f, terms in asked.items() if f in sizes and terms}
        rows = spark.read.parquet(f"{path}/levels").where(_any([self._is(f, t) for f, ts in wanted.items() for t in ts]))
        self.levels, self.weights, self.means = [], {}, {f: sizes[f]["mean"] for f in wanted}
        # No more rows than terms times levels.
        for r in rows.collect():
            n, df = sizes[r["field"]]["n"], r["df"]
            idf = {"bm25": math.log(1 + (n - df + 0.5) / (df + 0.5)), "classic": math.log(n / df), "boolean": 1.0}[model]
            weight = idf * boosts.get(r["field"], 1.0)
            term = (r["field"], r["term"])
            self.weights[term] = weight
            top = {"bm25": r["impact"], "classic": r["share"], "boolean": 1.0}[model]
            self.levels.append((term, r["level"], r["entries"], r["blocks"], weight * top))

    @staticmethod
    def _is(field: str, term: str) -> Column:
        return (F.col("bucket") == _bucket(F.lit(field), F.lit(term))) & (F.col("field") == field) & (F.col("term") == term)

    def read(self, levels: list) -> DataFrame:
        """Blocks of some levels."""
        of: dict = {}
        for term, level, *_ in levels:
            of.setdefault(term, []).append(level)
        return self.blocks.where(_any([self._is(*term) & F.col("level").isin(found) for term, found in of.items()]))

    def scores(self, blocks: DataFrame) -> DataFrame:
        """``(doc, score)`` of every entry of blocks."""
        pairs = [F.lit(x) for (f, t), w in self.weights.items() for x in (f"{f}\0{t}", w)]
        weight = F.element_at(F.create_map(*pairs), F.concat("field", F.lit("\0"), "term"))
        means = F.create_map(*[F.lit(x) for f, m in self.means.items() for x in (f, m)])
        entries = inline_rows(
            blocks.select("field", weight.alias("weight"), "postings"), F.col("postings"),
            ["doc", "freq", "length", "norm"], "field", "weight",
        )
        unit = {
            "bm25": _saturated(F.element_at(means, F.col("field")), F.col("freq"), F.col("length")),
            "classic": _share(F.col("freq"), F.col("norm")),
            "boolean": F.lit(1.0),
        }[self.model]
        return entries.select("doc", (F.col("weight") * unit).alias("score"))


def search(
    spark: SparkSession, path: str, asked: dict[str, list[str]], k: int, model: str = "bm25",
    boosts: dict[str, float] | None = None, doc: str = "doc",
) -> DataFrame:
    """Top ``k`` documents ``(doc, score)`` for query terms by field, each field with its boost.

    Scores add up over fields and are those of ``rank_bm25``, ``rank_classic`` and ``rank_boolean``. The
    strongest levels give a first k-th score; then only levels are read whose bound, with the best of
    all other terms, can reach it. What the documents found there have in weaker levels is looked up by
    the blocks that their hash names. A term that no document has adds nothing; ties go to the
    smaller id.
    """
    if model not in MODELS:
        raise ValueError(f"unknown model {model}")
    query = _Search(spark, path, asked, model, boosts or {})
    if not query.levels:
        found = query.blocks.select(F.explode("postings.doc").alias(doc)).where(F.lit(False))
        return found.select(doc, F.lit(0.0).alias("score"))
    strongest, held = [], 0
    for level in sorted(query.levels, key=lambda x: (-x[4], x[0], x[1])):
        strongest.append(level)
        held += level[2]
        if held >= k:
            break
    summed = lambda rows: rows.groupBy("doc").agg(F.sum("score").alias("score"))
    lead = summed(query.scores(query.read(strongest))).orderBy(F.desc("score")).limit(k)
    first = lead.agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).first()
    floor = first["least"] - SLACK if first["n"] == k else -math.inf
    best: dict = {}
    for term, *_, bound in query.levels:
        best[term] = max(best.get(term, 0.0), bound)
    total = sum(best.values())
    near = [x for x in query.levels if x[4] + total - best[x[0]] >= floor]
    far = [x for x in query.levels if x[4] + total - best[x[0]] < floor]
    found = query.scores(query.read(near))
    if far:
        # A document gets no more from the levels left out than the best of each term there.
        rest: dict = {}
        for term, *_, bound in far:
            rest[term] = max(rest.get(term, 0.0), bound)
        partial = materialize(summed(found), "partial")
        chosen = partial.where(F.col("score") + sum(rest.values()) >= floor)
        looked = F.array(*[
            F.struct(
                F.lit(f).alias("field"), F.lit(t).alias("term"), F.lit(level).cast("int").alias("level"),
                F.lit(blocks).cast("int").alias("blocks"),
            ) for (f, t), level, _, blocks, _ in far
        ])
        places = explode_rows(chosen, looked, "place", "doc").select(
            "place.field", "place.term", "place.level",
            F.pmod(F.xxhash64("doc"), "place.blocks").cast("int").alias("block"),
        ).distinct()
        some = query.read(far).join(places, ["field", "term", "level", "block"], "left_semi")
        weaker = query.scores(some).join(chosen.select("doc"), "doc", "left_semi")
        found = chosen.unionByName(weaker)
    return _top(summed(found).withColumnRenamed("doc", doc), doc, k)


# Prefixes up to this many characters have their best inputs stored, and how many.
SHORT, STORED = 3, 100


def build_completions(inputs: DataFrame, text: str, weight: str, path: str, max_input_length: int = 50) -> None:
    """Write the inputs of a completion field: sorted by input, and the best of every short prefix.

    Inputs are normalised as ``complete_prefix`` does, once; of equal ones the highest weight counts.
    """
    shown = F.left(F.array_join(simple(F.col(text)), " "), F.lit(max_input_length))
    found = materialize(
        inputs.select(shown.alias("input"), F.col(weight).alias("weight"))
        .where(F.col("input").isNotNull())
        .groupBy("input").agg(F.max("weight").alias("weight")), "inputs",
    )
    found.repartitionByRange("input").sortWithinPartitions("input").write.parquet(f"{path}/inputs")
    starts = F.concat(F.array(F.lit("")), prefixes(F.col("input"), 1, SHORT))
    opened = explode_rows(found, starts, "prefix", "input", "weight")
    order = Window.partitionBy("prefix").orderBy(F.desc("weight"), "input")
    best = opened.withColumn("place", F.row_number().over(order)).where(F.col("place") <= STORED)
    best.repartitionByRange("prefix").sortWithinPartitions("prefix", "place").write.parquet(f"{path}/best")


def complete(spark: SparkSession, path: str, prefix: str, k: int) -> DataFrame:
    """Top ``k`` stored inputs ``(input, weight)`` by weight that start with a prefix, ties by input.

    A short prefix reads its stored list, a longer one, or one that is asked for more than the list has,
    the range of the sorted inputs that it names.
    """
    start = prefix.lower()
    if len(start) <= SHORT and k <= STORED:
        found = spark.read.parquet(f"{path}/best").where((F.col("prefix") == start) & (F.col("place") <= k))
    else:
        found = spark.read.parquet(f"{path}/inputs").where(F.col("input").startswith(start))
    return found.select("input", "weight").orderBy(F.desc("weight"), "input").limit(k)
