"""Collocations: phrases of two to four words whose parts mostly occur together.

All counts are exact. A phrase that occurs ``LEAST`` times has only pairs of words that do, so a first
pass counts hashed pairs, and a second one counts, as text, the phrases made of pairs that may be
frequent. Which pairs may be is told by a bit filter of fixed size: in a larger corpus it lets more
through, which costs time and changes no result. Batches sum their phrases by ranks of sorted runs,
and Spark sums those of a task before they travel, so a very common phrase is one row per task.

The frequent phrases are then kept as count streams in two layouts, by their first words (prefix
order) and by their last words (suffix order). Sorted merge joins run over these in lockstep: a cut of
a phrase meets the count of its first part in the one and of the rest in the other, and the phrases
that extend it to the right or to the left are those that share its words at the start or at the end.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.store import stored
from docloom.llm.words import mix, pieces

# Words of a phrase, least count, share of an extension that replaces a phrase, factor
# of the score, and phrases listed for each language.
WORDS, LEAST, SHARE, FACTOR, LISTED = 4, 30, 80, 2_000_000, 2000
UNKNOWN = "und"
# Bits of the filter of frequent pairs, in slices that are made one by one.
BITS, SLICES = 1 << 27, 64
WIDTH = BITS // SLICES
# Parts of a language that are ranked on their own first.
PARTS = 16
# Characters per batch of texts.
BATCH = 4 << 20
_ENDS = b".,;:!?\n\x0b\x0c\r"
_TOKEN = re.compile(rb"[^ \t.,;:!?\n\x0b\x0c\r]+|[.,;:!?\n\x0b\x0c\r]")
_ODD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class Words:
    """Words of one batch of texts of one language, numbered; a piece ends where ``inside`` is false."""

    def __init__(self, texts: list[str | None]):
        joined = b"\n".join([t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]).lower()
        found = _TOKEN.findall(joined)
        places = {w: i for i, w in enumerate(dict.fromkeys(found))}
        self.names = list(places)
        self.ids = np.fromiter(map(places.__getitem__, found), np.int64, len(found))
        word = np.array([len(w) > 1 or w not in _ENDS for w in self.names], np.bool_)
        self.inside = word[self.ids] if len(found) else np.zeros(0, np.bool_)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Places where two words of a piece begin, the distinct pair of each, both words of the
        distinct pairs, and their counts."""
        at = np.flatnonzero(self.inside[:-1] & self.inside[1:])
        size = max(len(self.names), 1)
        pair, which, count = np.unique(
            self.ids[at] * size + self.ids[at + 1], return_inverse=True, return_counts=True
        )
        return at, which, np.stack([pair // size, pair % size]), count

    def hashes(self, lang: str, pair: np.ndarray) -> np.ndarray:
        seed = xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass"))
        one = np.array([xxhash.xxh3_64_intdigest(w, seed) for w in self.names], np.uint64)
        return mix(one[pair[0]] * _ODD[0] + one[pair[1]] * _ODD[1])

    def phrases(self, frequent) -> list[tuple[int, list[bytes], np.ndarray]]:
        """(number of words, phrases, counts) of single words and of phrases of frequent pairs.

        ``frequent`` tells for the distinct pairs which of them may be.
        """
        at, which, pair, _ = self.pairs()
        once = np.bincount(self.ids[self.inside], minlength=len(self.names))
        used = np.flatnonzero(once)
        out = [(1, [self.names[i] for i in used.tolist()], once[used])]
        passed = frequent(pair)
        good = np.zeros(len(self.ids) + WORDS, np.bool_)
        good[at] = passed[which]
        # Distinct phrases by number, and at each place the number of the phrase that begins there.
        number = np.zeros(len(self.ids), np.int64)
        number[at] = which
        words = pair
        at = at[passed[which]]
        for size in range(2, WORDS + 1):
            if size > 2:
                at = at[good[at + size - 2]]
                key = number[at] * len(self.names) + self.ids[at + size - 1]
                new, found = np.unique(key, return_inverse=True)
                words = np.vstack([words[:, new // len(self.names)], new % len(self.names)])
                number[at] = found
            count = np.bincount(number[at], minlength=words.shape[1])
            kept = np.flatnonzero(count)
            names = [list(map(self.names.__getitem__, row.tolist())) for row in words[:, kept]]
            out.append((size, list(map(b" ".join, zip(*names))), count[kept]))
        return out


def _by_language(batches):
    """(language, texts) in bounded lots."""
    for batch in batches:
        lots: dict[str, list] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            lots.setdefault(lang, []).append(text)
        for lang, texts in lots.items():
            for begin, end in pieces(texts, BATCH):
                yield lang, texts[begin:end]


def _spots(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two bits of the filter for each hash, in one slice."""
    base = (hashes >> np.uint64(58)).astype(np.int64) % SLICES * WIDTH
    low = np.uint64(WIDTH - 1)
    return base + (hashes & low).astype(np.int64), base + ((hashes >> np.uint64(28)) & low).astype(np.int64)


def _filter(texts: DataFrame, least: int) -> bytes:
    """Bits of the pairs that occur ``least`` times, packed and compressed.

    A hash that two pairs share can only add a pair. At most ``BITS`` bits reach the driver.
    """
    def count(batches):
        for lang, lot in _by_language(batches):
            words = Words(lot)
            _, _, pair, n = words.pairs()
            hashes = words.hashes(lang, pair).view(np.int64)
            for begin in range(0, len(n), 1 << 16):
                part = slice(begin, begin + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array(hashes[part]), pa.array(n[part])], ["pair", "n"])

    counted = texts.mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    often = counted.where(F.col("n") >= least).select("pair")

    def fill(batches):
        # A task keeps the bits of its slices only, whatever the number of rows.
        slices: dict[int, np.ndarray] = {}
        for batch in batches:
            hashes = batch.column("pair").to_numpy().view(np.uint64)
            for spot in _spots(hashes):
                for i in np.unique(spot // WIDTH).tolist():
                    bits = slices.setdefault(i, np.zeros(WIDTH, np.bool_))
                    bits[spot[spot // WIDTH == i] - i * WIDTH] = True
        for i, bits in slices.items():
            packed = zstandard.compress(np.packbits(bits).tobytes(), 3)
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([packed])], ["slice", "bits"])

    # Slices are dealt out by the pairs' own hash, so that each is made in one place.
    slice_of = F.pmod(F.shiftrightunsigned("pair", 58), F.lit(SLICES))
    found = often.repartition(SLICES, slice_of).mapInArrow(fill, "slice int, bits binary").collect()
    whole = np.zeros(BITS // 8, np.uint8)
    for row in found:
        part = np.frombuffer(zstandard.decompress(row["bits"]), np.uint8)
        whole[row["slice"] * len(part) : (row["slice"] + 1) * len(part)] |= part
    return zstandard.compress(whole.tobytes(), 3)


def counts(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``(lang, size, phrase, f)``: words and phrases of up to ``WORDS`` words that occur ``least``
    times in a language, and a row of size 0 with the number of all words of the language.

    Reads ``text`` and ``lang``; a null language is ``UNKNOWN``, a null text has no words.
    """
    texts = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text")
    packed = _filter(texts, least)
    shared = docs.sparkSession.sparkContext.broadcast(packed)

    def emit(batches):
        bits = np.frombuffer(zstandard.decompress(shared.value), np.uint8)

        def has(spot: np.ndarray) -> np.ndarray:
            return (bits[spot >> 3] >> (7 - (spot & 7)).astype(np.uint8)) & 1 > 0

        for lang, lot in _by_language(batches):
            words = Words(lot)

            def frequent(pair: np.ndarray) -> np.ndarray:
                one, two = _spots(words.hashes(lang, pair))
                return has(one) & has(two)

            total = int(words.inside.sum())
            for size, names, n in [(0, [b""], np.array([total])), *words.phrases(frequent)]:
                for begin in range(0, len(names), 1 << 15):
                    part = slice(begin, begin + (1 << 15))
                    shown = pa.array(names[part], pa.binary()).cast(pa.string())
                    yield pa.RecordBatch.from_arrays([
                        pa.array([lang] * len(shown), pa.string()),
                        pa.array(np.full(len(shown), size, np.int8)), shown, pa.array(n[part].astype(np.int64)),
                    ], ["lang", "size", "phrase", "f"])

    found = texts.mapInArrow(emit, "lang string, size byte, phrase string, f long")
    summed = found.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f"))
    return summed.where((F.col("f") >= least) | (F.col("size") == 0))


def _words(phrase: Column, begin: Column | int, count: Column) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), begin, count), " ")


def collocations(docs: DataFrame, least: int = LEAST, listed: int = LISTED) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the first ``listed`` phrases of each language.

    ``a`` counts the phrase, ``l`` and ``r`` the parts of its cut of lowest score (ties to the earliest
    cut), ``n`` all words of the language. Phrases inside a longer one that is at least ``SHARE`` percent as
    frequent are left out. Order is by score, then count, then the phrase's bytes.

    Null and empty texts add nothing, repeated rows count again, ids are not read, and an empty
    table gives no rows.
    """
    grams = stored(counts(docs, least), "phrases")
    totals = grams.where("size = 0").select("lang", F.col("f").alias("n"))
    streams = grams.where("size > 0").select("lang", F.col("phrase").alias("part"), "f")
    phrases = grams.where("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"))
    cut = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cut = cut.withColumn("head", _words(F.col("phrase"), 1, F.col("k"))).withColumn(
        "tail", _words(F.col("phrase"), F.col("k") + 1, F.col("size"))
    )
    heads = streams.select("lang", F.col("part").alias("head"), F.col("f").alias("l"))
    tails = streams.select("lang", F.col("part").alias("tail"), F.col("f").alias("r"))
    wide = "decimal(38,0)"
    score = F.expr(f"cast(cast(a as {wide}) * {FACTOR} div (cast(l as {wide}) + r) as long)")
    scored = (
        cut.join(heads.hint("merge"), ["lang", "head"]).join(tails.hint("merge"), ["lang", "tail"])
        .withColumn("score", score)
        .groupBy("lang", "phrase")
        .agg(F.min(F.struct("score", "k", "a", "l", "r", "size")).alias("best"))
        .select("lang", "phrase", "best.*")
    )
    # An extension by more words contains one by a single word that is at least as frequent.
    longer = phrases.where("size > 2")
    rest = F.col("size") - 1
    widened = longer.select("lang", _words(F.col("phrase"), 1, rest).alias("phrase"), "a").unionByName(
        longer.select("lang", _words(F.col("phrase"), 2, rest).alias("phrase"), "a")
    ).groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(widened.hint("merge"), ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.expr(f"cast(longer as {wide}) * 100 < cast(a as {wide}) * {SHARE}"))
    )
    # First by parts of a language, so that the last step sees a bounded number of rows of each.
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    place = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    some = kept.withColumn("part", part).withColumn("place", place).where(F.col("place") <= listed)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    best = some.withColumn("rank", rank).where(F.col("rank") <= listed)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocation_query(spark, sf_dir: str) -> DataFrame:
    """Collocations of all documents, by language."""
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


COLLOCATION_SQL = rf"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, '{UNKNOWN}') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents)),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces WHERE len(w) > 0),
grams AS (
  SELECT lang, size, array_to_string(w[i : i + size - 1], ' ') AS phrase, count(*) AS f
  FROM places, (SELECT unnest([1, 2, 3, 4]) AS size) WHERE i + size - 1 <= len(w)
  GROUP BY 1, 2, 3 HAVING count(*) >= {LEAST}),
totals AS (SELECT lang, count(*) AS n FROM places GROUP BY 1),
phrases AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE size > 1),
cuts AS (
  SELECT *, array_to_string(w[1 : k], ' ') AS head, array_to_string(w[k + 1 : size], ' ') AS tail
  FROM (SELECT *, unnest(range(1, size)) AS k FROM phrases)),
scored AS (
  SELECT c.lang, c.phrase, c.a, h.f AS l, t.f AS r,
         (c.a::HUGEINT * {FACTOR}) // (h.f + t.f) AS score, k
  FROM cuts c JOIN grams h ON h.lang = c.lang AND h.phrase = c.head
              JOIN grams t ON t.lang = c.lang AND t.phrase = c.tail),
lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
widened AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, array_to_string(w[1 : size - 1], ' ') AS phrase, a FROM phrases WHERE size > 2
    UNION ALL SELECT lang, array_to_string(w[2 : size], ' '), a FROM phrases WHERE size > 2) GROUP BY 1, 2),
kept AS (
  SELECT l.* FROM lowest l LEFT JOIN widened x ON x.lang = l.lang AND x.phrase = l.phrase
  WHERE x.longer IS NULL OR 100 * x.longer < {SHARE} * l.a),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT r.lang, r.rank, phrase, a, l, r.r, n, r.score::BIGINT AS score
FROM ranked r JOIN totals t ON t.lang = r.lang WHERE rank <= {LISTED}
"""
