"""Passages that occur more than once, found by difference-cover anchors.

A difference cover modulo v holds, for any two offsets, a shift that brings both into the cover.
Two equal windows of ``WINDOW`` words therefore share an equal anchor of ``WINDOW - v + 1`` words
that starts at a cover position in both. Only anchors, a quarter of all positions, are exchanged;
around anchors that occur twice every whole window is then compared by its hash.

Hashes travel in sorted runs, one per batch of texts and bucket, and a hash that a batch repeats
travels once, so a very common passage costs a reducer one entry per batch. The input should be a
stored table: the order of its rows inside a partition has to be the same when a task runs again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.mixing import word_count
from docloom.llm.store import stored
from docloom.llm.words import Words, encode, pieces, windows

WINDOW = 35
# A perfect difference set: every remainder is the difference of two members in one way.
PERIOD, COVER = 21, (3, 6, 7, 12, 14)
# Characters per batch of texts.
BATCH = 8 << 20
_KNOWN = np.uint32(0xFFFFFFFF)
_RUNS = "bucket int, batch long, hashes binary, places binary"


def row_key(doc_id: Column, text: Column) -> Column:
    """Identity of a row: repeated rows share it, and their results are the same."""
    return F.xxhash64(doc_id, text)


def anchors(words: Words, _) -> tuple[np.ndarray, np.ndarray]:
    """Word places of all anchors of a batch, and their hashes."""
    size = WINDOW - PERIOD + 1
    hashes = windows(words.hashes, size)
    counts = words.counts()
    first = np.repeat(words.first[:-1], counts)
    last = np.repeat(words.first[1:], counts)
    place = np.arange(len(words.hashes))
    cover = np.zeros(PERIOD, np.bool_)
    cover[list(COVER)] = True
    # Only texts with a whole window can take part.
    use = cover[(place - first) % PERIOD] & (place + size <= last) & (last - first >= WINDOW)
    place = place[use]
    return place, hashes[place]


def around(words: Words, positions: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word places of the whole windows that hold one of the anchors at ``positions``."""
    mark = np.zeros(len(words.hashes) + 1, np.int64)
    for i, raw in enumerate(positions):
        first, last = words.first[i], words.first[i + 1]
        at = np.frombuffer(raw, np.int32).astype(np.int64)
        low = first + np.maximum(at - PERIOD + 1, 0)
        high = np.minimum(first + at, last - WINDOW)
        good = low <= high
        np.add.at(mark, low[good], 1)
        np.add.at(mark, high[good] + 1, -1)
    place = np.flatnonzero(np.cumsum(mark[:-1]) > 0)
    return place, windows(words.hashes, WINDOW)[place]


def _runs(batch: int, buckets: int, keys: np.ndarray, words: Words, place, hashes):
    """Rows of one batch: its texts, the places it repeats itself, and a run per bucket."""
    first = words.first[:-1].astype("<u4")
    yield -1, batch, keys.tobytes(), first.tobytes()
    bucket = ((hashes >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((hashes, bucket))
    bucket, hashes, place = bucket[order], hashes[order], place[order].astype("<u4")
    new = np.ones(len(hashes), np.bool_)
    new[1:] = hashes[1:] != hashes[:-1]
    begins = np.flatnonzero(new)
    many = np.diff(np.append(begins, len(hashes))) > 1
    inside = many[np.cumsum(new) - 1] if len(hashes) else many
    if inside.any():
        yield -2, batch, b"", place[inside].tobytes()
    place[inside] = _KNOWN
    bucket, hashes, place = bucket[begins], hashes[begins], place[begins]
    edges = np.searchsorted(bucket, np.arange(buckets + 1))
    for b in np.flatnonzero(edges[1:] > edges[:-1]).tolist():
        part = slice(edges[b], edges[b + 1])
        yield b, batch, hashes[part].astype("<u8").tobytes(), place[part].tobytes()


def _meet(batches):
    """Places whose hash also comes from another batch, as rows (bucket -2) of their batch."""
    batch_ids, hashes, places, sizes = [], [], [], []
    for rows in batches:
        for bucket, batch, h, p in zip(*(rows.column(i).to_pylist() for i in range(4))):
            if bucket < 0:
                yield [(bucket, batch, h, p)]
                continue
            batch_ids.append(batch)
            hashes.append(np.frombuffer(h, "<u8"))
            places.append(np.frombuffer(p, "<u4"))
            sizes.append(len(places[-1]))
    if not batch_ids:
        return
    every, place = np.concatenate(hashes), np.concatenate(places)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(every, kind="stable")
    every = every[order]
    same = every[1:] == every[:-1]
    twice = np.zeros(len(every), np.bool_)
    twice[1:] |= same
    twice[:-1] |= same
    found = order[twice]
    found = np.sort(found[place[found] != _KNOWN])
    edges = np.searchsorted(owner[found], np.arange(len(sizes) + 1))
    for i in np.flatnonzero(edges[1:] > edges[:-1]).tolist():
        yield [(-2, batch_ids[i], b"", place[found[edges[i] : edges[i + 1]]].tobytes())]


def _arrow(rows):
    return pa.RecordBatch.from_arrays([
        pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()),
        pa.array([r[2] for r in rows], pa.binary()), pa.array([r[3] for r in rows], pa.binary()),
    ], ["bucket", "batch", "hashes", "places"])


def repeated_places(rows: DataFrame, choose, extra: str | None = None) -> DataFrame:
    """(key, positions) of the words of (key, text) rows at which a repeated sequence starts.

    ``choose`` gives the places to compare and their hashes; ``extra`` names a column handed to it.
    Positions are ascending little-endian 32-bit integers; texts without any are left out.
    """
    spark = rows.sparkSession
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))

    def split(batches):
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = batch.column("text").to_pylist()
            keys = batch.column("key").to_numpy()
            more = batch.column(extra).to_pylist() if extra else texts
            for begin, end in pieces(texts, BATCH):
                words = Words(encode(texts[begin:end]))
                place, hashes = choose(words, more[begin:end])
                if len(place):
                    yield _arrow(list(_runs(number, buckets, keys[begin:end], words, place, hashes)))
                number += 1

    def meet(batches):
        for found in _meet(batches):
            yield _arrow(found)

    def back(batches):
        docs, found = {}, {}
        for rows in batches:
            for bucket, batch, h, p in zip(*(rows.column(i).to_pylist() for i in range(4))):
                if bucket == -1:
                    docs[batch] = np.frombuffer(h, np.int64), np.frombuffer(p, "<u4")
                else:
                    found.setdefault(batch, []).append(p)
        for batch, parts in found.items():
            place = np.sort(np.frombuffer(b"".join(parts), "<u4"))
            keys, first = docs[batch]
            edges = np.append(np.searchsorted(place, first), len(place))
            some = np.flatnonzero(edges[1:] > edges[:-1])
            yield pa.RecordBatch.from_arrays([
                pa.array(keys[some]),
                pa.array([
                    (place[edges[i] : edges[i + 1]] - first[i]).astype("<i4").tobytes() for i in some
                ], pa.binary()),
            ], ["key", "positions"])

    runs = rows.mapInArrow(split, _RUNS)
    # Runs meet by bucket; what already belongs to a batch goes anywhere.
    route = F.when(F.col("bucket") < 0, F.xxhash64("batch", "bucket")).otherwise(F.xxhash64("bucket"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    met = runs.repartition(parts, route).mapInArrow(meet, _RUNS)
    return met.repartition(parts, "batch").mapInArrow(back, "key long, positions binary")


def without_repeats(docs: DataFrame) -> DataFrame:
    """(key, n_words, n_removed, kept) of the texts of which some words go.

    A word goes if a window of ``WINDOW`` words that covers it starts anywhere else too; all windows
    are judged on the input. ``kept`` joins the words that stay by one space. ``key`` is ``row_key``;
    a text that is not listed keeps all its words. Null, empty and short texts are never listed.
    """
    rows = docs.select(row_key(F.col("doc_id"), F.col("text")).alias("key"), "text").where(
        F.col("text").isNotNull()
    )
    seeds = repeated_places(rows, anchors).groupBy("key").agg(F.max("positions").alias("seeds"))
    near = stored(rows.join(seeds, "key"), "repeat-texts")
    starts = repeated_places(near, around, "seeds").groupBy("key").agg(
        F.max("positions").alias("starts")
    )
    texts = near.groupBy("key").agg(F.first("text").alias("text"))

    def cut(batches):
        for batch in batches:
            texts, keys = batch.column("text").to_pylist(), batch.column("key").to_numpy()
            total, gone, kept = [], [], []
            for text, raw in zip(texts, batch.column("starts").to_pylist()):
                words = text.encode("utf-8", "surrogatepass").split()
                at = np.frombuffer(raw, "<i4")
                mark = np.zeros(len(words) + 1, np.int64)
                mark[at] = 1
                np.subtract.at(mark, at + WINDOW, 1)
                covered = np.cumsum(mark[:-1]) > 0
                total.append(len(words))
                gone.append(int(covered.sum()))
                kept.append(b" ".join(words[i] for i in np.flatnonzero(~covered)).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([
                pa.array(keys), pa.array(total, pa.int64()), pa.array(gone, pa.int64()),
                pa.array(kept, pa.string()),
            ], ["key", "n_words", "n_removed", "kept"])

    return texts.join(starts, "key").mapInArrow(
        cut, "key long, n_words long, n_removed long, kept string"
    )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated words of ``text`` gone; other texts stay as they are."""
    changed = without_repeats(docs).select(F.col("key").alias("_key"), F.col("kept").alias("_kept"))
    rows = docs.withColumn("_row", row_key(F.col("doc_id"), F.col("text")))
    joined = rows.join(changed, F.col("_row") == F.col("_key"), "left")
    return joined.withColumn("text", F.coalesce("_kept", "text")).select(*docs.columns)


def repeats_query(spark, sf_dir: str) -> DataFrame:
    """Words, removed words and digest of what stays, of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    changed = stored(
        without_repeats(docs).select("key", "n_removed", F.sha2("kept", 256).alias("digest")), "repeats"
    )
    whole = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "))
    rows = docs.select(
        "doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"),
        word_count(F.col("text")).alias("n_words"), F.sha2(whole, 256).alias("whole"),
    )
    return rows.join(changed, "key", "left").select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("digest", "whole").alias("kept_sha256"),
    )
