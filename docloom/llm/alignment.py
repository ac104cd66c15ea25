"""Alignment of the tokens of two tokenizers, with corpus-wide counts of linked id pairs.

Byte offsets where a token of either side ends cut a text into groups; every token of the one side
is linked with every token of the other that shares its group. How often a pair of ids is linked is
counted over all documents, by external spill counting: each batch of texts writes its (pair,
document) records, dealt to ``RADIX`` parts by the first id, as sorted runs of zstd frames. Runs of a
part are merged k ways from a heap of frames, so that a task holds a frame of each run and never a
whole part, and parts are cut into chunks of bounded bytes, so that an id that a third of all links
carry keeps many tasks busy. Counts of chunks are summed; in the order of the first id they give its
highest count; and a second merge of the same runs hands count and highest count back to the
documents.

Neither tokenizer merges anything across the start of white space, so a text is taken apart into units
(white space and what follows it), and each distinct unit is encoded and aligned once per task, in a
row with others unless it ends in white space.
Vocabularies for which that does not hold are handled with the whole text as one unit.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.bpe import _byte_signs
from docloom.llm.store import stored
from docloom.llm.words import pieces

# Parts of the pair space, and bytes of runs that one task merges.
RADIX, CHUNK_BYTES = 16, 24 << 20
# Characters per batch of texts, and pairs per frame of a run.
BATCH, FRAME = 3 << 20, 8192
# Units kept by a task before its table starts anew.
TABLE_UNITS = 250_000
# Characters encoded at once, and links of a group from which on its ids are counted first.
LOT, WIDE = 1 << 16, 256
# Bits of an id of the second side in a pair.
SECOND_BITS = 24
# White space by Unicode.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# The sign that stands for a space inside pieces.
MARK = "▁"


class Tokenizers:
    """A byte-level tokenizer (first) and a piece tokenizer (second) with the bytes of their tokens."""

    def __init__(self, first: str, second: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_str(first)
        self.first.encode_special_tokens = True
        spec = json.loads(first)
        vocabulary = dict(spec["model"]["vocab"]) | {t["content"]: t["id"] for t in spec["added_tokens"]}
        value = {sign: byte for byte, sign in enumerate(_byte_signs())}
        self.first_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            known = all(c in value for c in token)
            self.first_bytes[i] = bytes(value[c] for c in token) if known else token.encode()
        self.second = sentencepiece.SentencePieceProcessor()
        self.second.LoadFromSerializedProto(second)
        names = [self.second.id_to_piece(i) for i in range(self.second.get_piece_size())]
        self.second_bytes = [
            bytes([int(n[3:5], 16)]) if self.second.is_byte(i) else n.replace(MARK, " ").encode()
            for i, n in enumerate(names)
        ]
        self.lone = names.index(MARK) if MARK in names else -1
        # White space that some piece joins with other signs is no border between units.
        inner = sorted({c for n in names if len(n) > 1 for c in re.findall(f"[{_SPACE}]", n)})
        tied = f"(?:[{re.escape(''.join(inner))}][{_SPACE}]*[^{_SPACE}]*)*" if inner else ""
        self.unit = re.compile(f"[{_SPACE}]*[^{_SPACE}]+{tied}|[{_SPACE}]+")
        self.alone = re.compile(f"[{_SPACE}]\\Z")
        splitter = spec.get("pre_tokenizer") or {}
        self.local = (
            spec.get("normalizer") is None and splitter.get("type") == "ByteLevel"
            and splitter.get("use_regex") and not splitter.get("add_prefix_space") and " " not in inner
            and self.lone >= 0 and not any(MARK in n.lstrip(MARK) for n in names)
        )

    def units(self, text: str) -> list[str]:
        """Parts of a space and the text that both tokenizers encode on their own."""
        return self.unit.findall(" " + text) if self.local else [" " + text]

    def encode(self, joined: str) -> tuple[list[int], list[int]]:
        """Ids of both sides for units in a row; the second side adds a space of its own."""
        left = self.first.encode_batch_fast([joined], add_special_tokens=False)[0].ids
        if joined == " ":
            return left, [self.lone]
        if joined.startswith(" "):
            return left, self.second.encode(joined[1:], num_threads=1)
        return left, self.second.encode(joined, num_threads=1)[1:]


def _spans(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of ranges that begin at ``first``, one range after the other."""
    return np.arange(size.sum()) + np.repeat(first - (np.cumsum(size) - size), size)


class Units:
    """What distinct units add to a document: tokens, groups, links, text of groups, linked pairs.

    ``places`` numbers the units; ``counts`` are -1 for one that a side does not give back.
    """

    def __init__(self, tokenizers: Tokenizers):
        self.tokenizers = tokenizers
        self.first_size = np.array([len(b) for b in tokenizers.first_bytes], np.int64)
        self.second_size = np.array([len(b) for b in tokenizers.second_bytes], np.int64)
        # Signs of an id inside its group and at the end of its side of the group.
        self.shown = [
            f"{i}{end}".encode()
            for count, ends in ((len(self.first_size), ",|"), (len(self.second_size), ",;"))
            for i in range(count) for end in ends
        ]
        self.clear()

    def clear(self) -> None:
        self.places: dict[str, int] = {}
        self.texts: list[bytes] = []
        self.counts, self.sizes = np.zeros((0, 4), np.int64), np.zeros(0, np.int64)
        self.pairs = self.times = np.zeros(0, np.int64)

    def add(self, units: list[str]) -> None:
        found, alone = [], self.tokenizers.alone
        joined = [u for u in units if not alone.search(u)]
        ended = [u for u in units if alone.search(u)]
        # Units in lots of bounded length, as all but a few are short. White space at the end of one would
        # run into the next.
        for begin, end in pieces(joined, LOT):
            found += self._aligned(joined[begin:end])
        for unit in ended:
            found += self._aligned([unit])
        for number, unit in enumerate(joined + ended, len(self.places)):
            self.places[unit] = number
        if found:
            texts, counts, sizes, pairs, times = zip(*found)
            self.texts += chain.from_iterable(texts)
            self.counts = np.concatenate([self.counts, *counts])
            self.sizes = np.concatenate([self.sizes, *sizes])
            self.pairs = np.concatenate([self.pairs, *pairs])
            self.times = np.concatenate([self.times, *times])

    def _aligned(self, units: list[str]) -> list[tuple]:
        joined = "".join(units)
        raw = joined.encode("utf-8", "surrogatepass")
        a, b = self.tokenizers.encode(joined)
        if (
            b"".join([self.tokenizers.first_bytes[i] for i in a]) != raw
            or b"".join([self.tokenizers.second_bytes[i] for i in b]) != raw
        ):
            if len(units) > 1:
                return [r for u in units for r in self._aligned([u])]
            none = np.zeros(0, np.int64)
            return [([b""], np.full((1, 4), -1), np.zeros(1, np.int64), none, none)]
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        a_end, b_end = np.cumsum(self.first_size[a]), np.cumsum(self.second_size[b])
        cuts = np.intersect1d(a_end, b_end)
        a_group, b_group = np.searchsorted(cuts, a_end), np.searchsorted(cuts, b_end)
        every = np.arange(len(cuts))
        a_from, b_from = np.searchsorted(a_group, every), np.searchsorted(b_group, every)
        a_size, b_size = np.bincount(a_group), np.bincount(b_group)
        # Groups in order, in each the first side before the second.
        signs = np.empty(len(a) + len(b), np.int64)
        a_last, b_last = np.append(a_group[1:] != a_group[:-1], True), np.append(b_group[1:] != b_group[:-1], True)
        signs[np.arange(len(a)) + b_from[a_group]] = 2 * a + a_last
        signs[np.arange(len(b)) + (a_from + a_size)[b_group]] = 2 * (b + len(self.first_size)) + b_last
        shown = list(map(self.shown.__getitem__, signs.tolist()))
        ends = np.cumsum([len(u.encode("utf-8", "surrogatepass")) for u in units])
        last = np.searchsorted(cuts, ends) + 1
        first = np.concatenate(([0], last[:-1]))
        edges = np.append(a_from + b_from, len(signs))[np.concatenate((first, last[-1:]))].tolist()
        texts = [b"".join(shown[x:y]) for x, y in zip(edges, edges[1:])]
        add = lambda values: np.add.reduceat(values, first)
        counts = np.stack([add(a_size), add(b_size), last - first, add(a_size * b_size)], axis=1)
        # All pairs of a group; those of a wide one by how often it holds each id.
        owner = np.searchsorted(last, every, "right")
        slim = np.flatnonzero(a_size * b_size <= WIDE)
        x = _spans(a_from[slim], a_size[slim])
        y = _spans(b_from[a_group[x]], b_size[a_group[x]])
        x = np.repeat(x, b_size[a_group[x]])
        pair, held, times = [(a[x] << SECOND_BITS) | b[y]], [owner[a_group[x]]], [np.ones(len(x), np.int64)]
        for g in np.flatnonzero(a_size * b_size > WIDE).tolist():
            p, m = np.unique(a[a_from[g] : a_from[g] + a_size[g]], return_counts=True)
            q, n = np.unique(b[b_from[g] : b_from[g] + b_size[g]], return_counts=True)
            pair.append(((p[:, None] << SECOND_BITS) | q).ravel())
            times.append((m[:, None] * n).ravel())
            held.append(np.full(len(pair[-1]), owner[g]))
        pair, times, held = np.concatenate(pair), np.concatenate(times), np.concatenate(held)
        order = np.argsort(held, kind="stable")
        sizes = np.bincount(held, minlength=len(units))
        return [(texts, counts, sizes, pair[order], times[order])]


class Aligner:
    """Documents from their units, each of which is encoded once; the table of units is bounded."""

    def __init__(self, tokenizers: Tokenizers):
        self.tokenizers, self.units = tokenizers, Units(tokenizers)

    def batch(self, texts: list[str | None]) -> tuple[list, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """A row ``(n_a, n_b, n_groups, n_links, digest)`` per text, and the records of the batch:
        pair, place of the text, times linked; ordered by pair and place."""
        known = self.units
        if len(known.places) > TABLE_UNITS:
            known.clear()
        split = [self.tokenizers.units(t) if t and MARK not in t else [] for t in texts]
        known.add(list(dict.fromkeys(u for units in split for u in units if u not in known.places)))
        at = np.fromiter(
            map(known.places.__getitem__, chain.from_iterable(split)), np.int64, sum(map(len, split))
        )
        size = np.array([len(units) for units in split], np.int64)
        edge = np.concatenate(([0], np.cumsum(size)))
        owner = np.repeat(np.arange(len(texts)), size)
        lost = np.zeros(len(texts), np.bool_)
        lost[owner[known.counts[at, 0] < 0]] = True
        use = ~lost[owner]
        at, owner = at[use], owner[use]
        sums = np.zeros((len(texts), 4), np.int64)
        np.add.at(sums, owner, known.counts[at])
        rows = []
        for i, (units, counts) in enumerate(zip(split, sums.tolist())):
            if not units or lost[i]:
                rows.append((0, 0, 0, 0, ""))
                continue
            shown = b"".join([known.texts[known.places[u]] for u in units])
            rows.append((*counts, hashlib.sha256(shown[:-1]).hexdigest()))
        key, often = np.unique(owner << 32 | at, return_counts=True)
        owner, at = key >> 32, key & 0xFFFFFFFF
        first = np.cumsum(known.sizes) - known.sizes
        size = known.sizes[at]
        take = _spans(first[at], size)
        pair, place = known.pairs[take], np.repeat(owner, size)
        times = known.times[take] * np.repeat(often, size)
        order = np.lexsort((place, pair))
        pair, place, times = pair[order], place[order], times[order]
        new = np.ones(len(pair), np.bool_)
        new[1:] = (pair[1:] != pair[:-1]) | (place[1:] != place[:-1])
        begin = np.flatnonzero(new)
        return rows, (pair[begin], place[begin], np.add.reduceat(times, begin) if len(begin) else times)


def radix_of(pair: np.ndarray) -> np.ndarray:
    """Part of a pair, by its first id alone."""
    mixed = (pair >> SECOND_BITS).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(40)).astype(np.int64) % RADIX


def frames(pair: np.ndarray, place: np.ndarray, times: np.ndarray) -> bytes:
    """A sorted run as zstd frames with their sizes in front; each holds whole pairs."""
    begins = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
    ends = np.append(begins[1:], len(pair))
    packer, out = zstandard.ZstdCompressor(level=3), []
    for at in range(0, len(begins), FRAME):
        part = slice(at, min(at + FRAME, len(begins)))
        low, high = begins[part.start], ends[part.stop - 1]
        keys, sizes = pair[begins[part]], ends[part] - begins[part]
        # Differences are small numbers, which compress well.
        body = b"".join([
            np.diff(keys, prepend=0).astype("<i8").tobytes(), sizes.astype("<u4").tobytes(),
            place[low:high].astype("<u4").tobytes(), times[low:high].astype("<i8").tobytes(),
        ])
        packed = packer.compress(body)
        out.append(np.array([len(packed), len(keys), high - low], "<u4").tobytes() + packed)
    return b"".join(out)


def opened(run: bytes):
    """The frames of a run, one at a time: (pairs, documents of each, places, times)."""
    at, reader = 0, zstandard.ZstdDecompressor()
    while at < len(run):
        size, keys, records = np.frombuffer(run, "<u4", 3, at).tolist()
        body = reader.decompress(run[at + 12 : at + 12 + size])
        pair = np.cumsum(np.frombuffer(body, "<i8", keys))
        sizes = np.frombuffer(body, "<u4", keys, 8 * keys).astype(np.int64)
        place = np.frombuffer(body, "<u4", records, 12 * keys)
        yield pair, sizes, place, np.frombuffer(body, "<i8", records, 12 * keys + 4 * records)
        at += 12 + size


def merged(runs: list[bytes]):
    """Pairs of all runs in order with the number of their records, in blocks.

    A heap holds the last pair of the open frame of each run. What no other run can still
    precede, all pairs up to the smallest of these, is summed and handed out.
    """
    streams = [opened(r) for r in runs]
    heads: list = [next(s, None) for s in streams]
    heap = [(int(h[0][-1]), i) for i, h in enumerate(heads) if h is not None]
    heapq.heapify(heap)
    while heap:
        bound = heap[0][0]
        keys, sizes = [], []
        for i, head in enumerate(heads):
            if head is None:
                continue
            cut = int(np.searchsorted(head[0], bound, "right"))
            if cut:
                keys.append(head[0][:cut])
                sizes.append(head[1][:cut])
                heads[i] = (head[0][cut:], head[1][cut:])
        while heap and heap[0][0] <= bound:
            _, i = heapq.heappop(heap)
            heads[i] = next(streams[i], None)
            if heads[i] is not None:
                heapq.heappush(heap, (int(heads[i][0][-1]), i))
        pair, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        # Whole numbers below 2^53 add up exactly.
        yield pair, np.bincount(inverse, np.concatenate(sizes)).astype(np.int64)


@cache
def _tokenizers(first: str, second: str) -> tuple[str, bytes]:
    with open(first, encoding="utf-8") as a, open(second, "rb") as b:
        return a.read(), b.read()


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")
_RECORDS = (
    "run long, place int, row struct<{row}>, n_a long, n_b long, n_groups long, n_links long, "
    "groups_sha256 string, radix int, frames binary"
)


def aligned(docs: DataFrame, first: str, second: str, text: str = "text") -> DataFrame:
    """Columns of ``docs`` other than the text, and what links its tokens.

    ``n_a``, ``n_b``, ``n_groups``, ``n_links`` (long), ``n_best`` (links whose pair is linked in as
    many documents as any pair of its first id), ``count_sum`` (documents of its pair, summed over
    links) and ``groups_sha256`` replace columns of these names. ``first`` and ``second`` are the files
    of a byte-level and a piece tokenizer.

    A text that is null or empty, or that a side does not give back byte by byte, has zeros, an empty
    digest, and adds to no count. Every row is a document, a repeated row too; ids may be null or
    repeat. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    ours = {*_COUNTS, "n_best", "count_sum", "groups_sha256"}
    kept = [c for c in docs.columns if c != text and c not in ours]
    names = [f"c{i}" for i in range(len(kept))]
    body = [docs[_quoted(c)].alias(n) for c, n in zip(kept, names)]
    rows = docs.select(F.struct(F.lit(0).alias("_"), *body).alias("row"), docs[_quoted(text)].alias("text"))
    shared = spark.sparkContext.broadcast(_tokenizers(first, second))

    def encode(batches):
        aligner = Aligner(Tokenizers(*shared.value))
        number = 0
        for batch in batches:
            texts, carried = batch.column("text").to_pylist(), batch.column("row")
            for begin, end in pieces(texts, BATCH):
                # Neither depends on the attempt: a task that runs again gives the same runs.
                run = (TaskContext.get().partitionId() << 32) + number
                number += 1
                found, (pair, place, times) = aligner.batch(texts[begin:end])
                yield _rows(run, carried.slice(begin, end - begin), found)
                part = radix_of(pair)
                blobs = [
                    (r, frames(pair[part == r], place[part == r], times[part == r]))
                    for r in np.unique(part).tolist()
                ]
                if blobs:
                    yield _blobs(run, carried.type, blobs)

    schema = rows.select("row").schema["row"].dataType.simpleString()
    fields = _RECORDS.replace("struct<{row}>", schema)
    written = stored(rows.mapInArrow(encode, fields), "alignment")
    runs = written.where(F.col("radix").isNotNull()).select("run", "radix", "frames")
    # At most RADIX rows.
    sizes = runs.groupBy("radix").agg(
        F.ceil(F.sum(F.octet_length("frames").cast("long")) / CHUNK_BYTES).cast("long").alias("chunks")
    )
    runs = runs.join(F.broadcast(sizes), "radix").select(
        "radix", F.pmod(F.xxhash64("run"), "chunks").cast("int").alias("chunk"), "run", "frames"
    )

    def count(table: pa.Table) -> pa.Table:
        found = list(merged(table.column("frames").to_pylist()))
        pair = np.concatenate([p for p, _ in found])
        return pa.table({
            "radix": np.full(len(pair), table.column("radix")[0].as_py(), np.int32),
            "chunk": np.full(len(pair), table.column("chunk")[0].as_py(), np.int32),
            "pair": pair, "n": np.concatenate([n for _, n in found]),
        })

    counted = stored(
        runs.groupBy("radix", "chunk").applyInArrow(count, "radix int, chunk int, pair long, n long"), "pair-counts"
    )
    a = F.shiftright("pair", SECOND_BITS)
    totals = stored(counted.groupBy("pair").agg(F.sum("n").alias("total")).withColumn("a", a), "pair-totals")
    # One row per id of the first vocabulary.
    highest = totals.groupBy("a").agg(F.max("total").alias("highest"))
    known = totals.join(highest, "a").select("pair", "total", (F.col("total") == F.col("highest")).alias("best"))
    wanted = counted.select("radix", "chunk", "pair").join(known, "pair")

    def hand_back(left: pa.Table, right: pa.Table) -> pa.Table:
        pair = right.column("pair").to_numpy()
        order = np.argsort(pair)
        pair, total = pair[order], right.column("total").to_numpy()[order]
        best = right.column("best").to_numpy(zero_copy_only=False)[order]
        out: list[tuple] = []
        for run, blob in zip(left.column("run").to_pylist(), left.column("frames").to_pylist()):
            sums = np.zeros((2, 0), np.int64)
            for keys, sizes, place, times in opened(blob):
                at = np.repeat(np.searchsorted(pair, keys), sizes)
                top = int(place.max()) + 1
                if top > sums.shape[1]:
                    sums = np.pad(sums, ((0, 0), (0, top - sums.shape[1])))
                np.add.at(sums[0], place, times * best[at])
                np.add.at(sums[1], place, times * total[at])
            used = np.flatnonzero(sums[1])
            out.append((np.full(len(used), run), used.astype(np.int32), sums[0][used], sums[1][used]))
        run, place, n_best, count_sum = (np.concatenate(c) for c in zip(*out))
        return pa.table({"run": run, "place": place, "n_best": n_best, "count_sum": count_sum})

    given = (
        runs.groupBy("radix", "chunk").cogroup(wanted.groupBy("radix", "chunk"))
        .applyInArrow(hand_back, "run long, place int, n_best long, count_sum long")
        .groupBy("run", "place").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    )
    documents = written.where(F.col("radix").isNull()).drop("radix", "frames")
    return documents.join(given, ["run", "place"], "left").select(
        *[F.col("row")[n].alias(c) for c, n in zip(kept, names)], *_COUNTS,
        F.coalesce("n_best", F.lit(0)).alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256",
    )


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _rows(run: int, carried: pa.Array, found: list[tuple]) -> pa.RecordBatch:
    size = len(found)
    counts = [pa.array([f[i] for f in found], pa.int64()) for i in range(4)]
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(size, run)), pa.array(np.arange(size, dtype=np.int32)), carried, *counts,
        pa.array([f[4] for f in found], pa.string()), pa.nulls(size, pa.int32()), pa.nulls(size, pa.binary()),
    ], ["run", "place", "row", *_COUNTS, "groups_sha256", "radix", "frames"])


def _blobs(run: int, carried: pa.DataType, blobs: list[tuple[int, bytes]]) -> pa.RecordBatch:
    size = len(blobs)
    counts = [pa.nulls(size, pa.int64())] * 4
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(size, run)), pa.nulls(size, pa.int32()), pa.nulls(size, carried), *counts,
        pa.nulls(size, pa.string()), pa.array([r for r, _ in blobs], pa.int32()),
        pa.array([b for _, b in blobs], pa.binary()),
    ], ["run", "place", "row", *_COUNTS, "groups_sha256", "radix", "frames"])


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def alignment_query(spark, sf_dir: str) -> DataFrame:
    """Tokens, groups and links of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("long"), "text")
    return aligned(docs, *default_paths())
