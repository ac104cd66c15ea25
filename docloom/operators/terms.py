"""Corpus jobs over analyzed text: term statistics, postings, phrases, ranking.

Term counts inside a document are made in the document's own row, by sorting its tokens, so no
token ever crosses a shuffle: only one row per document and distinct term is exploded, and the
map side combines those before a corpus-wide count is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions.analysis import Analyzer, grams, prefixes, simple
from docloom.functions.rows import explode_rows, inline_rows, posexplode_rows
from docloom.session import materialize

# Term frequency saturation and length normalization of the probabilistic ranking.
K1 = 1.2
B = 0.75


def tokens(docs: DataFrame, doc: str, text: str, analyzer: Analyzer) -> DataFrame:
    """``(doc, pos, term)`` for every token."""
    return posexplode_rows(docs, analyzer(F.col(text)), "term", doc)


def corpus_terms(docs: DataFrame, doc: str, text: str, analyzer: Analyzer) -> DataFrame:
    """Per term its occurrences and the sum of its positions."""
    return tokens(docs, doc, text, analyzer).groupBy("term").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("pos").cast("bigint")).alias("pos_sum")
    )


def run_counts(docs: DataFrame, text: str, analyzer: Analyzer) -> DataFrame:
    """Occurrences per distinct token."""
    found = explode_rows(docs, analyzer(F.col(text)), "term")
    return found.groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def _parts(counts: DataFrame, parts: Column, name: str) -> DataFrame:
    """Count parts of terms from the terms' counts: each distinct term is taken apart once."""
    return explode_rows(counts, parts, name, "n").groupBy(name).agg(F.sum("n").alias("n"))


def gram_counts(counts: DataFrame, min_gram: int, max_gram: int) -> DataFrame:
    return _parts(counts, grams(F.col("term"), min_gram, max_gram), "gram")


def prefix_terms(counts: DataFrame, min_chars: int, max_chars: int) -> DataFrame:
    return _parts(counts, prefixes(F.col("term"), min_chars, max_chars), "prefix")


def doc_terms(
    docs: DataFrame, doc: str, text: str, analyzer: Analyzer, positions: bool = False
) -> DataFrame:
    """``(doc, terms)``: the distinct terms of each document with their counts, sorted by term.

    ``terms`` is ``array<struct<term, freq>>``, with ``positions`` also the places of the term.
    Sorting a document's tokens puts equal ones side by side; where a run starts and where the
    next one starts give the count. No shuffle.
    """
    found = analyzer(F.col(text))
    if positions:
        found = F.transform(found, lambda t, i: F.struct(t.alias("term"), i.alias("pos")))

    def term(i: Column) -> Column:
        item = F.get("ordered", i)
        return item["term"] if positions else item

    def run(start: Column, i: Column) -> Column:
        freq = F.coalesce(F.get("starts", i + 1), F.size("ordered")) - start
        parts = [term(start).alias("term"), freq.alias("freq")]
        if positions:
            places = F.transform(F.slice("ordered", start + 1, freq), lambda t: t["pos"])
            parts.append(places.alias("positions"))
        return F.struct(*parts)

    every = F.slice(F.sequence(F.lit(0), F.size("ordered")), F.lit(1), F.size("ordered"))
    return (
        docs.select(doc, F.sort_array(found).alias("ordered"))
        .withColumn("starts", F.filter(every, lambda i: (i == 0) | (term(i) != term(i - 1))))
        .select(doc, F.transform("starts", run).alias("terms"))
    )


def postings(
    docs: DataFrame, doc: str, text: str, analyzer: Analyzer, level: str = "positions"
) -> DataFrame:
    """One row per term and document: with level ``docs`` nothing more, ``freqs`` adds the count,
    ``positions`` also the places."""
    columns = {"docs": [], "freqs": ["freq"], "positions": ["freq", "positions"]}[level]
    found = doc_terms(docs, doc, text, analyzer, positions=level == "positions")
    names = ["term", "freq"] + (["positions"] if level == "positions" else [])
    return inline_rows(found, F.col("terms"), names, doc).select("term", doc, *columns)


def term_vector(docs: DataFrame, doc: str, text: str, analyzer: Analyzer) -> DataFrame:
    """Per document a map from term to count."""
    found = doc_terms(docs, doc, text, analyzer)
    return found.select(doc, F.map_from_entries("terms").alias("vector"))


def term_stats(docs: DataFrame, doc: str, text: str, analyzer: Analyzer) -> DataFrame:
    """Per term the number of documents holding it and its occurrences."""
    return (
        postings(docs, doc, text, analyzer, "freqs")
        .groupBy("term")
        .agg(
            F.count(F.lit(1)).alias("doc_freq"),
            F.sum(F.col("freq").cast("bigint")).alias("total_freq"),
        )
    )


def phrase_pairs(docs: DataFrame, text: str, analyzer: Analyzer) -> DataFrame:
    """Adjacent token pairs with their counts."""
    found = docs.select(analyzer(F.col(text)).alias("found"))
    pairs = F.arrays_zip(
        F.slice("found", F.lit(1), F.size("found") - 1).alias("first"),
        F.slice("found", F.lit(2), F.size("found") - 1).alias("second"),
    )
    return (
        inline_rows(found, F.when(F.size("found") > 1, pairs), ["first", "second"])
        .groupBy("first", "second")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def frequency_filter(
    docs: DataFrame, doc: str, text: str, analyzer: Analyzer, least: float, most: float
) -> DataFrame:
    """Term counts per document, only of terms whose share of documents is within the bounds."""
    total = docs.select(F.count(F.lit(1)).cast("double"))
    share = F.col("doc_freq") / total.scalar()
    kept = term_stats(docs, doc, text, analyzer).where(share.between(least, most)).select("term")
    counted = postings(docs, doc, text, analyzer, "freqs")
    return counted.join(kept, "term", "left_semi")


def fingerprint_groups(docs: DataFrame, doc: str, fingerprint: Column) -> DataFrame:
    """Documents sharing a fingerprint: its digest, how many, and the first one.

    Only the digest of the fingerprint crosses the shuffle. Empty fingerprints group nothing;
    they are left out of the counts, as a filter before would compute every fingerprint twice.
    """
    digest = F.sha2(fingerprint, 256)
    return (
        docs.select(doc, digest.alias("digest"))
        .groupBy("digest")
        .agg(
            F.count_if(F.col("digest") != F.sha2(F.lit(""), 256)).alias("documents"),
            F.min(doc).alias("first_doc"),
        )
        .where(F.col("documents") > 1)
    )


def stop_terms(found: DataFrame, words: DataFrame) -> DataFrame:
    """Token rows whose term is not in a word table, such as one read from a text file."""
    return found.join(words.select("term").distinct(), "term", "left_anti")


def _top(scored: DataFrame, doc: str, k: int) -> DataFrame:
    """Best ``k``, scores rounded before ordering, ties by document."""
    rounded = scored.select(doc, F.round("score", 6).alias("score"))
    return rounded.orderBy(F.desc("score"), doc).limit(k)


def _occurrences(array: str, term: str) -> Column:
    return F.size(F.filter(array, lambda t: t == term)).cast("double")


def rank_bm25(
    docs: DataFrame, doc: str, text: str, analyzer: Analyzer, query: list[str], k: int,
    boost: float = 1.0, k1: float = K1, b: float = B,
) -> DataFrame:
    """Top ``k`` documents for query terms by probabilistic ranking (Robertson, Zaragoza 2009).

    One pass over the text keeps each document's length and the tokens the query asks for.
    Document count, mean length and the query terms' document counts come from that small table
    as scalars, and every document is then scored in its own row.
    """
    terms = list(dict.fromkeys(query))
    found = docs.select(doc, analyzer(F.col(text)).alias("found"))
    hits = materialize(
        found.select(
            doc, F.size("found").alias("length"),
            F.filter("found", lambda t: t.isin(terms)).alias("hits"),
        )
    )
    stats = hits.agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.avg("length").alias("mean"),
        *[F.count_if(F.array_contains("hits", t)).cast("double").alias(f"df{i}")
          for i, t in enumerate(terms)],
    )
    n, mean = stats.select("n").scalar(), stats.select("mean").scalar()
    score = F.lit(0.0)
    for i, t in enumerate(terms):
        df = stats.select(f"df{i}").scalar()
        tf = _occurrences("hits", t)
        idf = F.log(1 + (n - df + 0.5) / (df + 0.5))
        norm = tf + k1 * (1 - b + b * F.col("length") / mean)
        score = score + F.when(tf > 0, idf * tf * (k1 + 1) / norm).otherwise(0.0)
    return _top(hits.where(F.size("hits") > 0).select(doc, (score * boost).alias("score")), doc, k)


def rank_classic(
    docs: DataFrame, doc: str, text: str, analyzer: Analyzer, query: list[str], k: int,
    boost: float = 1.0,
) -> DataFrame:
    """Top ``k`` by cosine-normalized term weights tf * ln(N / df) (Salton, Buckley 1988)."""
    terms = list(dict.fromkeys(query))
    n = docs.select(F.count(F.lit(1)).cast("double")).scalar()
    # The corpus is analyzed once.
    found = materialize(doc_terms(docs, doc, text, analyzer), "doc-terms")
    weights = (
        inline_rows(found, F.col("terms"), ["term", "freq"], doc)
        .groupBy("term").agg(F.log(n / F.count(F.lit(1))).alias("idf"))
    )
    # Norms are needed only where the query matches; other documents lose their terms.
    matches = F.exists("terms", lambda t: t["term"].isin(terms))
    matched = inline_rows(found, F.when(matches, F.col("terms")), ["term", "freq"], doc)
    weighted = matched.join(weights, "term").withColumn("w", F.col("freq") * F.col("idf"))
    asked = F.when(F.col("term").isin(terms), F.col("w")).otherwise(0.0)
    scored = weighted.groupBy(doc).agg(
        F.sum(asked).alias("dot"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm")
    )
    score = F.when(F.col("norm") > 0, F.col("dot") / F.col("norm") * boost).otherwise(0.0)
    return _top(scored.select(doc, score.alias("score")), doc, k)


def rank_boolean(
    docs: DataFrame, doc: str, text: str, analyzer: Analyzer, query: list[str], k: int,
    boost: float = 1.0,
) -> DataFrame:
    """Top ``k`` by the number of distinct query terms a document holds."""
    terms = list(dict.fromkeys(query))
    matched = F.size(F.array_distinct(F.filter(analyzer(F.col(text)), lambda t: t.isin(terms))))
    scored = docs.select(doc, (matched * F.lit(float(boost))).alias("score"))
    return _top(scored.where(F.col("score") > 0), doc, k)


def complete_prefix(
    inputs: DataFrame, text: str, weight: str, prefix: str, k: int, max_input_length: int = 50
) -> DataFrame:
    """Top ``k`` inputs by weight that start with a prefix.

    An input is its lower-cased letter runs joined by blanks, cut at ``max_input_length``.
    """
    shown = F.left(F.array_join(simple(F.col(text)), " "), F.lit(max_input_length))
    return (
        inputs.select(shown.alias("input"), F.col(weight).alias("weight"))
        .where(F.col("input").startswith(prefix.lower()))
        .groupBy("input")
        .agg(F.max("weight").alias("weight"))
        .orderBy(F.desc("weight"), "input")
        .limit(k)
    )


def hashed_cardinality(rows: DataFrame, column: str, error: float = 0.01) -> DataFrame:
    """Exact number of distinct values beside the estimate from their 64-bit hashes.

    The exact number counts digests, so that no long value crosses the shuffle.
    """
    digest = F.sha2(F.col(column).cast("string"), 256)
    exact = rows.select(digest.alias("d")).where(F.col("d").isNotNull()).distinct()
    estimate = rows.agg(F.approx_count_distinct(F.xxhash64(column), error).alias("estimate"))
    return exact.agg(F.count(F.lit(1)).alias("exact")).withColumn("estimate", estimate.scalar())


def token_count(docs: DataFrame, doc: str, text: str, analyzer: Analyzer) -> DataFrame:
    """Number of tokens per document."""
    return docs.select(doc, F.size(analyzer(F.col(text))).alias("tokens"))
