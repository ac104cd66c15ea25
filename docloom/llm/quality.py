"""Text quality by positive-unlabelled learning.

Trusted positives and unlabelled texts train a logistic model on the shape of a text (its bytes,
repetition, word and line forms). The loss is the non-negative unbiased risk: positives weighted
by the class prior, plus the risk of the unlabelled taken as negatives less the positives' part in
it, held above zero. The prior is the share of positives among all labelled rows of the training
part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.store import small_batches
from docloom.llm.words import Words, encode, pieces, shingle_sets

# Bound of the fitted sample: that many positives and that many unlabelled texts.
SAMPLE = 12_000
THRESHOLD = 0.7
SHAPES = 24
WIDTH = 256 + SHAPES
_PUNCTUATION = np.zeros(256, np.bool_)
_PUNCTUATION[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def text_features(texts) -> np.ndarray:
    """One row per text: shares of its bytes, then measures of words, repetition and lines.

    A null or empty text has a row of zeros; whole texts are read.
    """
    raw = encode(texts)
    words = Words(raw)
    count = words.counts().astype(np.float64)
    sizes = np.fromiter(map(len, raw), np.float64, len(raw))
    out = np.zeros((len(raw), WIDTH))
    data = np.frombuffer(words.data, np.uint8)
    double = np.zeros(len(data), np.bool_)
    double[1:] = (data[1:] == data[:-1]) & _PUNCTUATION[data[1:]]
    for i, (begin, end) in enumerate(zip(words.offsets[:-1], words.offsets[1:] - 1)):
        out[i, :256] = np.bincount(data[begin:end], minlength=256)
        out[i, 256] = np.count_nonzero(double[begin:end])
    some, full = np.maximum(sizes, 1), np.maximum(count, 1)
    upper = out[:, 65:91].sum(axis=1)
    lower = out[:, 97:123].sum(axis=1)
    digits = out[:, 48:58].sum(axis=1)
    marks = out[:, :256][:, _PUNCTUATION].sum(axis=1)
    lines = out[:, 10].copy()
    double_marks = out[:, 256].copy()
    out[:, :256] = np.sqrt(out[:, :256] / some[:, None])
    owner = np.repeat(np.arange(len(raw)), words.counts())
    length = (words.ends - words.starts).astype(np.float64)
    last = _PUNCTUATION[data[words.ends - 1]] if len(owner) else np.zeros(0, np.bool_)
    alone = last & _PUNCTUATION[data[words.starts]] if len(owner) else last

    def per_text(values) -> np.ndarray:
        return np.bincount(owner, values, len(raw))

    mean = per_text(length) / full
    spread = np.sqrt(np.maximum(per_text(length * length) / full - mean * mean, 0))
    same = np.zeros(len(owner))
    if len(owner) > 1:
        same[1:] = (words.hashes[1:] == words.hashes[:-1]) & (owner[1:] == owner[:-1])
    # Frequencies of the words of each text, from one sort of (text, word).
    order = np.lexsort((words.hashes, owner))
    keys, texts_of = words.hashes[order], owner[order]
    new = np.ones(len(keys), np.bool_)
    new[1:] = (keys[1:] != keys[:-1]) | (texts_of[1:] != texts_of[:-1])
    begins = np.flatnonzero(new)
    runs = np.diff(np.append(begins, len(keys)))
    distinct = np.bincount(texts_of[begins], minlength=len(raw))
    once = np.bincount(texts_of[begins], runs == 1, len(raw))
    most = np.zeros(len(raw))
    np.maximum.at(most, texts_of[begins], runs)
    grams, first = shingle_sets(words, 3)
    three = np.diff(first) / np.maximum(count - 2, 1)
    grams, first = shingle_sets(words, 8)
    eight = np.diff(first) / np.maximum(count - 7, 1)
    shapes = [
        np.log1p(count), np.log1p(sizes), mean, spread, np.log1p(mean), distinct / full, once / full,
        most / full, per_text(same) / full, three, eight, upper / some, upper / np.maximum(upper + lower, 1),
        digits / some, marks / some, marks / full, double_marks / some, np.log1p(lines),
        lines / full, per_text(last) / full, per_text(alone) / full, (count == 0).astype(float),
        distinct / np.sqrt(full), per_text(length > 25) / full,
    ]
    out[:, 256:] = np.stack(shapes, axis=1)
    out[sizes == 0] = 0
    return out.astype(np.float32)


def _vectors(rows: DataFrame, make, column: str, kind: pa.DataType, spark_type: str) -> DataFrame:
    """``keep`` columns and what ``make`` gives for the texts of ``_text``."""
    small_batches(rows.sparkSession)
    schema = rows.drop("_text").withColumn(column, F.lit(None).cast(spark_type)).schema

    def run(batches):
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            rest = batch.drop_columns(["_text"])
            for begin, end in pieces(texts):
                part = rest.slice(begin, end - begin)
                yield part.append_column(column, pa.array(make(texts[begin:end]), kind))

    return rows.mapInArrow(run, schema)


def features_of(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns and ``features`` as little-endian 32-bit floats."""
    rows = docs.select(*keep, F.col("text").alias("_text"))

    def make(texts):
        return [row.tobytes() for row in text_features(texts)]

    return _vectors(rows, make, "features", pa.binary(), "binary")


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 600) -> dict:
    """Model that minimises the non-negative risk by full gradient steps.

    Where the negative risk falls below zero, a step raises it again instead.
    """
    both = np.concatenate((positive, unlabelled)).astype(np.float64)
    center, scale = both.mean(axis=0), both.std(axis=0) + 1e-4
    p = np.clip((positive - center) / scale, -6, 6)
    u = np.clip((unlabelled - center) / scale, -6, 6)
    weights, bias = np.zeros(p.shape[1]), np.log(prior / (1 - prior))
    moments, squares = np.zeros(len(weights) + 1), np.zeros(len(weights) + 1)

    def sigmoid(z):
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    for step in range(1, steps + 1):
        zp, zu = p @ weights + bias, u @ weights + bias
        # Slopes of the mean logistic losses: positives as positive, and all as negative.
        up, down_p, down_u = sigmoid(zp) - 1, sigmoid(zp), sigmoid(zu)
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        slope_n = np.append(u.T @ down_u, down_u.sum()) / len(u)
        slope_n -= prior * np.append(p.T @ down_p, down_p.sum()) / len(p)
        slope_p = prior * np.append(p.T @ up, up.sum()) / len(p)
        slope = slope_p + slope_n if negative >= 0 else -slope_n
        slope[:-1] += 1e-3 * weights
        moments = 0.9 * moments + 0.1 * slope
        squares = 0.99 * squares + 0.01 * slope * slope
        move = 0.03 * (moments / (1 - 0.9**step)) / (np.sqrt(squares / (1 - 0.99**step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    return {"center": center, "scale": scale, "weights": weights, "bias": float(bias)}


def predict(model: dict, features: np.ndarray) -> np.ndarray:
    """Probability that each text is of quality."""
    z = np.clip((features - model["center"]) / model["scale"], -6, 6) @ model["weights"]
    return 1 / (1 + np.exp(-np.clip(z + model["bias"], -30, 30)))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict:
    """A model from rows of ``docs`` and the ``quality`` labels of some.

    Only the positive labels of at most ``sample`` documents and the texts of as many others,
    chosen by lowest hash, are fitted. The prior counts all labels. A document labelled both ways
    counts as not positive. Without labels of both kinds every text scores the prior.
    """
    marks = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.min("quality").alias("quality")
    )
    counts = marks.agg(F.count(F.lit(1)).alias("n"), F.sum("quality").alias("ones")).first()
    total, ones = counts["n"], counts["ones"] or 0
    prior = min(max((ones + 1) / (total + 2), 0.02), 0.98)
    flat = {
        "center": np.zeros(WIDTH), "scale": np.ones(WIDTH), "weights": np.zeros(WIDTH),
        "bias": float(np.log(prior / (1 - prior))),
    }
    if ones == 0 or ones == total:
        return flat

    def lowest(ids: DataFrame, seed: int) -> DataFrame:
        return ids.orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(sample)

    trusted = lowest(marks.where("quality = 1").select("doc_id"), 1).withColumn("_role", F.lit(1))
    others = lowest(docs.select("doc_id").where("doc_id is not null"), 2).withColumn("_role", F.lit(0))
    # Twice ``sample`` ids at most, so the broadcast is bounded.
    roles = trusted.unionByName(others)
    rows = docs.select("doc_id", "text").join(F.broadcast(roles), "doc_id")
    found = features_of(rows, "doc_id", "_role").limit(4 * sample).toPandas()
    found = found.sort_values(["_role", "doc_id"], kind="stable")
    table = np.stack([np.frombuffer(f, np.float32) for f in found["features"]]) if len(found) else np.zeros((0, WIDTH))
    role = found["_role"].to_numpy()
    if not (role == 1).any() or not (role == 0).any():
        return flat
    return fit(table[role == 1], table[role == 0], prior)


def score(docs: DataFrame, model: dict, *keep: str, threshold: float = THRESHOLD) -> DataFrame:
    """``keep`` columns, ``score`` and ``predicted`` of every whole text, empty and null ones too."""
    rows = docs.select(*keep, F.col("text").alias("_text"))

    def make(texts):
        return predict(model, text_features(texts))

    scored = _vectors(rows, make, "score", pa.float64(), "double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def held_out():
    """True for the documents whose labels take no part in learning."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def quality_query(spark, sf_dir: str) -> DataFrame:
    """Learn from three quarters of the documents, score all."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    model = train(docs.where(~held_out()), labels.where(~held_out()))
    return score(docs.select("doc_id", held_out().alias("held_out"), "text"), model, "doc_id", "held_out")
