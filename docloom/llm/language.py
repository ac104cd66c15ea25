"""Language of words in code-switched text by a linear-chain conditional random field.

Every word has hashed features: its affixes, its character n-grams and itself as a lexicon entry.
Learned weights score a word under each language, learned transitions score neighbours, and
forward-backward gives the language probabilities of each word. A document gets the language with
the largest sum over its words. A run of more than ``SEEN`` letters, as text without spaces has, is
cut into words that share two letters, so that every n-gram of it counts. The chain starts anew every ``CHAIN`` words.
"""

from __future__ import annotations

import math
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.store import small_batches
from docloom.llm.words import mix, pieces

FEATURES = 1 << 18
CHAIN = 64
UNKNOWN = "und"
# Bound of the labelled sample: documents per language, spans per document, words per span.
SAMPLE_DOCS, SAMPLE_SPANS, SPAN = 600, 6, 16
# Languages that a model may tell apart.
MAX_LANGUAGES = 256
# Letters of a step of the chain; a longer run of letters is several steps.
SEEN = 32
TABLE_WORDS = 200_000
_WORD = re.compile(r"[^\W\d_²³¹¼-¾]+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters in lower case; a run must hold a letter."""
    found = _WORD.findall(text.lower()) if text else []
    try:
        text and text.encode("latin-1")
    except UnicodeEncodeError:  # other scripts have signs that count as word parts alone
        return [w for w in found if w.isalpha() or any(c.isalpha() for c in w)]
    return found


def parts(word: str) -> list[str]:
    """A word in parts of at most ``SEEN`` letters and like size; neighbours share two letters."""
    if len(word) <= SEEN:
        return [word]
    inner = len(word) - 2
    count = -(-inner // (SEEN - 2))
    edges = [i * inner // count for i in range(count + 1)]
    return [word[a : b + 2] for a, b in zip(edges, edges[1:])]


def steps_of(text: str | None) -> list[str]:
    """Words of a text as steps of the chain, long ones in parts."""
    words = words_of(text)
    if not words or max(map(len, words)) <= SEEN:
        return words
    return [part for word in words for part in parts(word)]


def features(words: list[str]) -> np.ndarray:
    """Feature numbers of each word of at most ``SEEN`` letters, one row per word, zero where there is none."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    wide = np.array(words, dtype=f"U{SEEN}").view(np.uint32).reshape(len(words), SEEN)
    codes = np.zeros((len(words), SEEN + 2), np.uint64)
    codes[:, 1:-1] = wide
    codes[:, 0] = 1
    codes[np.arange(len(words)), sizes + 1] = 2
    out = []

    def add(kind: int, value: np.ndarray, there: np.ndarray) -> None:
        number = mix(value + np.uint64(kind * 0x1000003)) & np.uint64(FEATURES - 1)
        out.append(np.where(there, number.astype(np.int64) | 1, 0))

    longest = int(sizes.max()) if len(words) else 0
    rows = np.arange(len(words))
    step = np.uint64(0x100000001B3)
    whole = np.zeros(len(words), np.uint64)
    for i in range(1, longest + 1):
        whole = np.where(i <= sizes, mix(whole * step + codes[:, i]), whole)
        if i <= 3:
            add(i, whole, sizes >= i)
    add(4, whole, sizes > 0)
    tail = np.zeros(len(words), np.uint64)
    for i in range(3):
        tail = mix(tail * step + codes[rows, np.maximum(sizes - i, 0)])
        add(5 + i, tail, sizes > i)
    for i in range(longest + 1):
        pair = codes[:, i] * step + codes[:, i + 1]
        add(8, pair, i <= sizes)
        if i < longest:
            add(9, mix(pair) * step + codes[:, i + 2], i + 1 <= sizes)
    return np.stack(out, axis=1)


def scores(words: list[str], weights: np.ndarray) -> np.ndarray:
    """Sum of the feature weights of each word, one column per language."""
    total = np.zeros((len(words), weights.shape[1]), np.float32)
    # Words of like length together: the columns of a part follow its longest word.
    order = np.argsort(np.fromiter(map(len, words), np.int64, len(words)), kind="stable")
    for begin in range(0, len(order), 8192):
        part = order[begin : begin + 8192]
        table = features([words[i] for i in part])
        found = np.zeros((len(part), weights.shape[1]), np.float32)
        for column in table.T:
            found += weights.take(column, axis=0)
        total[part] = found
    return total


def marginals(emission: np.ndarray, lengths: np.ndarray, initial: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Language probabilities of each word of chains padded to one length, shaped (T, B, K)."""
    steps = emission.shape[0]
    force = np.exp(emission - emission.max(axis=2, keepdims=True))
    step = np.exp(moves)
    forward = np.empty_like(force)
    forward[0] = force[0] * np.exp(initial)
    forward[0] /= forward[0].sum(axis=1, keepdims=True)
    for t in range(1, steps):
        now = (forward[t - 1] @ step) * force[t]
        forward[t] = now / now.sum(axis=1, keepdims=True)
    backward = np.ones_like(force[0])
    out = np.empty_like(force)
    for t in range(steps - 1, -1, -1):
        if t < steps - 1:
            backward = (force[t + 1] * backward) @ step.T
            backward /= backward.sum(axis=1, keepdims=True)
            backward[lengths <= t + 1] = 1.0
        both = forward[t] * backward
        out[t] = both / both.sum(axis=1, keepdims=True)
    return out


def fit(spans: list[list[str]], labels: np.ndarray, count: int, epochs: int = 4, seed: int = 7):
    """Weights, initial scores and transitions by gradient steps on the chains' likelihood.

    A chain is two spans; the second one is in any language, so that transitions learn how long a
    language lasts and that it may change.
    """
    random = np.random.default_rng(seed)
    number: dict[str, int] = {}
    coded = [np.array([number.setdefault(w, len(number)) for w in s]) for s in spans]
    table = features(list(number))
    weights = np.zeros((FEATURES, count), np.float32)
    squares = np.full((FEATURES, count), 1e-6, np.float32)
    initial, moves = np.zeros(count, np.float32), np.zeros((count, count), np.float32)
    by_label = [np.flatnonzero(labels == k) for k in range(count)]
    for epoch in range(epochs):
        order = random.permutation(len(coded))
        for begin in range(0, len(order), 1024):
            first = order[begin : begin + 1024]
            other = random.integers(0, count, len(first))
            other = np.where(random.random(len(first)) < 0.7, labels[first], other)
            second = np.array([random.choice(by_label[k]) for k in other])
            chains = [np.concatenate((coded[a], coded[b])) for a, b in zip(first, second)]
            lengths = np.array([len(c) for c in chains])
            steps, batch = int(lengths.max()), len(chains)
            ids = np.zeros((steps, batch), np.int64)
            truth = np.zeros((steps, batch), np.int64)
            for i, words in enumerate(chains):
                ids[: len(words), i] = words
                truth[: len(coded[first[i]]), i] = labels[first[i]]
                truth[len(coded[first[i]]) : len(words), i] = other[i]
            there = np.arange(steps)[:, None] < lengths
            seen, back = np.unique(ids, return_inverse=True)
            back = back.reshape(ids.shape)
            used = table[seen]
            emission = weights[used].sum(axis=1)[back]
            wrong = marginals(emission, lengths, initial, moves)
            # Expected moves between neighbours, then expected minus observed of everything.
            pair = wrong[:-1, :, :, None] * np.exp(moves) * wrong[1:, :, None, :]
            pair /= pair.sum(axis=(2, 3), keepdims=True)
            expected = pair[there[1:]].sum(axis=0)
            observed = np.zeros_like(moves)
            np.add.at(observed, (truth[:-1][there[1:]], truth[1:][there[1:]]), 1.0)
            moves -= 2.0 * (expected - observed) / max(1, there[1:].sum())
            starts = np.bincount(truth[0], minlength=count)
            initial -= 0.5 * (wrong[0].sum(axis=0) - starts) / batch
            np.put_along_axis(
                wrong, truth[:, :, None], np.take_along_axis(wrong, truth[:, :, None], 2) - 1, 2
            )
            wrong[~there] = 0
            slope = np.zeros((len(seen), count), np.float32)
            np.add.at(slope, back.ravel(), wrong.reshape(-1, count))
            flat = np.zeros((FEATURES, count), np.float32)
            touched = np.unique(used)
            for k in range(count):
                flat[:, k] = np.bincount(
                    used.ravel(), np.repeat(slope[:, k], used.shape[1]), FEATURES
                )
            flat = flat[touched] / batch + 1e-5 * weights[touched]
            squares[touched] += flat * flat
            weights[touched] -= 0.2 * flat / np.sqrt(squares[touched])
            weights[0] = 0
    return weights, initial, moves


def _spans(texts, spans: int, size: int):
    """Up to ``spans`` stretches of words, spread evenly over each whole text."""
    for text in texts:
        words = steps_of(text)
        places = len(words) // size
        if places == 0:
            yield [words] if words else []
        else:
            chosen = np.unique(np.linspace(0, places - 1, min(spans, places)).astype(int))
            yield [words[p * size : (p + 1) * size] for p in chosen]


def train(docs: DataFrame, per_language: int = SAMPLE_DOCS) -> dict:
    """A model from ``text`` and non-null ``lang`` of ``docs``.

    The sample is bounded by the parameters above: the rows of each language with the lowest hash of id,
    language and text, whole texts read, evenly spread spans taken. Null texts teach nothing, repeated
    rows and ties of the hash count as rows. Without usable rows the model has no language.
    """
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    order = F.pmod(F.xxhash64("doc_id", "lang", "text"), F.lit(1 << 30))
    ranked = docs.where("lang is not null").select("lang", "text", order.alias("_order"))
    counts = ranked.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counts:
        return {"names": [], "shared": None}
    # A hash range per language that holds somewhat more than the sample, then its lowest hashes.
    limits = [
        (r["lang"], math.ceil((1 << 30) * min(1.0, 1.3 * (per_language + 20) / r["count"]))) for r in counts
    ]
    limit = F.create_map(*[F.lit(x) for pair in limits for x in pair])
    # Rows are ranked, not ids: ids may be missing or shared by any number of rows.
    final = Window.partitionBy("lang").orderBy("_order", "text")
    rows = (
        ranked.where(F.col("_order") < limit[F.col("lang")])
        .withColumn("_at", F.row_number().over(final)).where(F.col("_at") <= per_language)
    )

    def cut(batches):
        for batch in batches:
            texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
            found = [
                (lang, span)
                for lang, spans in zip(langs, _spans(texts, SAMPLE_SPANS, SPAN))
                for span in spans
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.string()),
                 pa.array([" ".join(f[1]) for f in found], pa.string())], ["lang", "span"]
            )

    found = rows.select("lang", "text").mapInArrow(cut, "lang string, span string").collect()
    spans = sorted((r["lang"], r["span"]) for r in found)
    names = sorted({s[0] for s in spans})
    if not names:
        return {"names": [], "shared": None}
    labels = np.array([names.index(s[0]) for s in spans])
    weights, initial, moves = fit([s[1].split(" ") for s in spans], labels, len(names))
    return {"names": names, "shared": spark.sparkContext.broadcast((weights, initial, moves))}


class Tagger:
    """Word probabilities of many texts; scores of words are kept in a bounded table."""

    def __init__(self, model):
        self.weights, self.initial, self.moves = model
        self.count = len(self.initial)
        self.index: dict[str, int] = {}
        self.table = np.zeros((1 << 16, self.count), np.float32)

    def _lookup(self, lines: list[list[str]]) -> np.ndarray:
        if len(self.index) > TABLE_WORDS:
            self.index.clear()
        index, have = self.index, len(self.index)
        fresh = list(set(chain.from_iterable(lines)).difference(index))
        for word in fresh:
            index[word] = len(index)
        while len(index) > len(self.table):
            self.table = np.concatenate((self.table, np.zeros_like(self.table)))
        if fresh:
            self.table[have : have + len(fresh)] = scores(fresh, self.weights)
        total = sum(map(len, lines))
        return np.fromiter(map(index.__getitem__, chain.from_iterable(lines)), np.int64, total)

    def tag(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of all words of all texts in order, and the number of words per text."""
        lines = [steps_of(t) for t in texts]
        sizes = np.fromiter(map(len, lines), np.int64, len(lines))
        ids = self._lookup(lines)
        if not len(ids):
            return np.zeros((0, self.count), np.float32), sizes
        inside = np.arange(len(ids)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        step = inside % CHAIN
        lengths = np.bincount(np.cumsum(step == 0) - 1)
        out = np.empty((len(ids), self.count), np.float32)
        # Chains of like length together, so that padding stays small.
        begins = np.flatnonzero(step == 0)
        order = np.argsort(lengths, kind="stable")
        for begin in range(0, len(order), 4096):
            part = order[begin : begin + 4096]
            longest = int(lengths[part].max())
            place = begins[part][None, :] + np.arange(longest)[:, None]
            there = np.arange(longest)[:, None] < lengths[part]
            emission = np.where(there[:, :, None], self.table[ids[np.where(there, place, 0)]], 0)
            found = marginals(emission, lengths[part], self.initial, self.moves)
            out[place[there]] = found[there]
        return out, sizes


def predict(docs: DataFrame, model: dict, keep: list[str]) -> DataFrame:
    """``keep`` columns, ``lang_pred`` and ``score`` of every whole text.

    A null text, one without letters, or a model without languages gives ``und`` with score 0.
    Ties go to the first language by name.
    """
    small_batches(docs.sparkSession)
    names, shared = model["names"], model["shared"]
    rows = docs.select(*keep, F.col("text").alias("_text"))
    schema = docs.select(*keep, F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema

    def run(batches):
        tagger = Tagger(shared.value) if names else None
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            kept = batch.drop_columns(["_text"])
            for begin, end in pieces(texts):
                langs, best = [UNKNOWN] * (end - begin), np.zeros(end - begin)
                if tagger:
                    found, sizes = tagger.tag(texts[begin:end])
                    full = np.flatnonzero(sizes)
                    if len(full):
                        first = (np.cumsum(sizes) - sizes)[full]
                        total = np.add.reduceat(found.astype(np.float64), first, axis=0)
                        share = total / sizes[full][:, None]
                        top = share.argmax(axis=1)
                        best[full] = np.clip(share[np.arange(len(full)), top], 0.0, 1.0)
                        for i, k in zip(full, top):
                            langs[i] = names[k]
                part = kept.slice(begin, end - begin)
                part = part.append_column("lang_pred", pa.array(langs, pa.string()))
                yield part.append_column("score", pa.array(best, pa.float64()))

    return rows.mapInArrow(run, schema)


def held_out():
    """True for the documents that take no part in learning."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def language_query(spark, sf_dir: str) -> DataFrame:
    """Learn from four fifths of the documents, predict all."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs.where(~held_out()))
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return predict(rows, model, ["doc_id", "held_out"])
