"""Join of texts by the Jaccard similarity of their word n-gram sets, heavy and light sets apart.

Texts with equal sets become one set first. Tokens (n-gram hashes) have one global order: frequent
ones last, then by hash. Two sets that reach the threshold share their first k common tokens inside
the first n - c + k tokens of each, where c is the overlap that a set of n needs with any partner.

* Light sets, of at most ``boundary`` tokens, enumerate the subsets of two tokens of that prefix, and
  light pairs meet in equal subsets.
* Pairs with a heavy set meet in the inverted lists of single prefix tokens.

The boundary is the one of least estimated cost. A pair needs its token inside the prefix that its
two sizes allow, which the token's rank in each set tells. Sets that have the token of a list
early, thus few rare tokens, are its centers; sets are compared with some centers first, so that
the lists then only bring together sets that are not yet connected: large groups of near copies are
not expanded into pairs. An upper bound of the overlap from counts
per hash range drops most candidates, and the sets of the others are compared exactly.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.components import components
from docloom.llm.mixing import word_count
from docloom.llm.repeats import row_key
from docloom.llm.store import stored
from docloom.llm.words import Words, encode, mix, pieces, shingle_sets

SHINGLE = 5
# Similarity as a fraction of whole numbers, so that comparisons are exact.
UPPER, LOWER = 4, 5
# Lowest hashes of a set that estimate the length of lists.
MINIMA = 4
# Lists in which a set is compared with centers first, and centers of a long list.
CENTERS, CLASSES = 3, 8
# Frequent tokens that go last: at most so many, each counted so often or more where a task has it
# twice; the tokens that a task counts together, and the most that it reports of them.
FREQUENT, OFTEN = 400_000, 12
COUNTED, PER_BATCH = 2_000_000, 65_536
# Parts that the list of a frequent token is dealt to.
SALTS = 32
# Largest set that may count as light, and the cost of a candidate in entries.
LIGHT, CANDIDATE = 30, 5.0
# Bits of the filter that tells which texts to read again; its size is fixed.
FILTER_BITS = 1 << 23
BATCH = 4 << 20
# An entry packs the size of its set, the rank of its token, and whether it is a subset of two.
_RANK, _TWO = 31, 62
_LOW = (1 << 31) - 1


def least_overlap(n):
    """Overlap that a set of ``n`` tokens needs with any partner."""
    return (UPPER * n + LOWER - 1) // LOWER


def needed_overlap(n, m):
    """Overlap that sets of ``n`` and ``m`` tokens need."""
    return (UPPER * (n + m) + LOWER + UPPER - 1) // (LOWER + UPPER)


def _key(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def ranges(tokens: np.ndarray) -> bytes:
    """Counts of a set's tokens over equal hash ranges, about four tokens to a range."""
    bits = max(2, int(len(tokens) - 1).bit_length() - 2)
    where = (tokens >> np.uint64(64 - bits)).astype(np.int64)
    return np.bincount(where, minlength=1 << bits).astype("<u4" if len(tokens) > 65_535 else "<u2").tobytes()


def overlap_bound(one: bytes, n: int, two: bytes, m: int) -> int:
    """Upper bound of the overlap of two sets from their counts."""
    a = np.frombuffer(one, "<u4" if n > 65_535 else "<u2").astype(np.int64)
    b = np.frombuffer(two, "<u4" if m > 65_535 else "<u2").astype(np.int64)
    size = min(len(a), len(b))
    a, b = a.reshape(size, -1).sum(axis=1), b.reshape(size, -1).sum(axis=1)
    return int(np.minimum(a, b).sum())


def _sets(batches, first_only: bool):
    """(keys, tokens, edges, digests) per piece of (key, text) batches.

    With ``first_only``, texts whose set this task has just seen come without tokens.
    """
    seen: set[bytes] = set()
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for begin, end in pieces(texts, BATCH):
            tokens, edges = shingle_sets(Words(encode(texts[begin:end], lower=True)), SHINGLE)
            digests, repeated = [], np.zeros(end - begin, np.bool_)
            for i in range(end - begin):
                part = tokens[edges[i] : edges[i + 1]]
                digests.append(hashlib.blake2b(part.tobytes(), digest_size=16).digest())
                repeated[i] = digests[-1] in seen
                seen.add(digests[-1])
            if len(seen) > 200_000:
                seen.clear()
            if first_only and repeated.any():
                sizes = np.diff(edges)
                tokens = tokens[np.repeat(~repeated, sizes)]
                edges = np.concatenate(([0], np.cumsum(np.where(repeated, 0, sizes))))
            yield batch.slice(begin, end - begin), tokens, edges, digests, repeated


_SUMMARY = (
    "kind int, doc_id long, row long, n int, set_key long, digest binary, ranges binary, minima array<long>, "
    "token long, cnt long"
)


def _summaries(rows: DataFrame) -> DataFrame:
    """Kind 0: one row per text with its set's size, digest and sketches. Kind 1: token counts."""

    def counted(held):
        every, counts = np.unique(np.concatenate(held), return_counts=True)
        every, counts = every[counts > 1], counts[counts > 1]
        top = np.lexsort((every, -counts))[:PER_BATCH]
        none = len(top)
        return pa.RecordBatch.from_arrays([
            pa.array(np.ones(none, np.int32)), pa.nulls(none, pa.int64()), pa.nulls(none, pa.int64()),
            pa.nulls(none, pa.int32()), pa.nulls(none, pa.int64()), pa.nulls(none, pa.binary()),
            pa.nulls(none, pa.binary()), pa.nulls(none, pa.list_(pa.int64())),
            pa.array(every[top].astype(np.int64)), pa.array(counts[top].astype(np.int64)),
        ], [c.split()[0] for c in _SUMMARY.split(", ")])

    def run(batches):
        held: list[np.ndarray] = []
        for part, tokens, edges, digests, repeated in _sets(batches, False):
            sizes = np.diff(edges)
            count = len(sizes)
            sketches = [b"" if r else ranges(tokens[edges[i] : edges[i + 1]]) if sizes[i] else b""
                        for i, r in enumerate(repeated)]
            minima = [tokens[edges[i] : min(edges[i] + MINIMA, edges[i + 1])].astype(np.int64).tolist()
                      if not repeated[i] else [] for i in range(count)]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.zeros(count, np.int32)), part.column("doc_id"), part.column("key"),
                pa.array(sizes.astype(np.int32)), pa.array(list(map(_key, digests)), pa.int64()),
                pa.array(digests, pa.binary()), pa.array(sketches, pa.binary()), pa.array(minima, pa.list_(pa.int64())),
                pa.nulls(count, pa.int64()), pa.nulls(count, pa.int64()),
            ], [c.split()[0] for c in _SUMMARY.split(", ")])
            held.append(tokens[np.repeat(~repeated, sizes)])
            if sum(map(len, held)) >= COUNTED:
                yield counted(held)
                held = []
        if held:
            yield counted(held)

    return rows.mapInArrow(run, _SUMMARY)


def choose_boundary(sizes: dict[int, int], length: float) -> int:
    """Largest size of a light set: that of least cost, given the small sets and a list's length.

    An entry of a list costs one, and every other set in its list a candidate. Sets that share a
    token are taken to share a second one as often as an entry is not alone in its list.
    """
    others = length - 1
    pairs = others * others / length
    best, choice, cost = 0.0, 0, 0.0
    for n in range(2, LIGHT + 1):
        spare = n - least_overlap(n)
        scan = (spare + 1) * (1 + CANDIDATE * others)
        subsets = (spare + 2) * (spare + 1) / 2 * (1 + CANDIDATE * pairs)
        cost += sizes.get(n, 0) * (subsets - scan)
        if cost < best:
            best, choice = cost, n
    return choice


def _entries(tokens: np.ndarray, edges: np.ndarray, frequent: np.ndarray, boundary: int):
    """(set place, hash, rank, subset of two) of the prefix tokens and subsets of each set.

    The rank of a subset is that of its later token less one: the prefix for two tokens is one longer.
    """
    sizes = np.diff(edges)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    at = np.minimum(np.searchsorted(frequent, tokens), max(len(frequent) - 1, 0))
    often = frequent[at] == tokens if len(frequent) else np.zeros(len(tokens), np.bool_)
    rare = np.concatenate(([0], np.cumsum(~often)))
    inside = np.arange(len(tokens)) - edges[owner]
    rare_before = rare[:-1] - rare[edges[owner]]
    rare_total = (rare[edges[1:]] - rare[edges[:-1]])[owner]
    rank = np.where(often, rare_total + inside - rare_before, rare_before)
    spare = sizes - least_overlap(sizes)
    # Light sets far below the boundary have no heavy partner.
    scanned = (sizes > 1) & (sizes * LOWER > boundary * UPPER)
    single = np.flatnonzero((rank <= spare[owner]) & scanned[owner])
    out = [(owner[single], tokens[single], rank[single], np.zeros(len(single), np.bool_))]
    for i in np.flatnonzero((sizes > 1) & (sizes <= boundary)):
        part = slice(edges[i], edges[i + 1])
        use = rank[part] <= spare[i] + 1
        lead, place = tokens[part][use], rank[part][use]
        one, two = np.triu_indices(len(lead), 1)
        pair = mix(mix(lead[one]) + lead[two])
        later = np.maximum(place[one], place[two]) - 1
        out.append((np.full(len(pair), i), pair, later, np.ones(len(pair), np.bool_)))
    return [np.concatenate(p) for p in zip(*out)]


_RUNS = "bucket long, hashes binary, keys binary, sizes binary"
_LISTS = "token long, key long, n int, rank int, two boolean"


def _lists(rows: DataFrame, frequent: np.ndarray, boundary: int) -> DataFrame:
    """(token, key, n, rank, two) entries of the lists that hold more than one set."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = 4 * parts
    shared = spark.sparkContext.broadcast(frequent)

    def split(batches):
        often = shared.value
        for _, tokens, edges, digests, _ in _sets(batches, True):
            place, hashes, rank, two = _entries(tokens, edges, often, boundary)
            if not len(place):
                continue
            keys = np.fromiter(map(_key, digests), np.int64, len(digests))[place]
            sizes = np.diff(edges)[place].astype(np.int64)
            sizes |= (rank.astype(np.int64) << _RANK) | (two.astype(np.int64) << _TWO)
            route = hashes.copy()
            if len(often):
                at = np.minimum(np.searchsorted(often, hashes), len(often) - 1)
                hot = (often[at] == hashes) & ~two
                route[hot] = mix(hashes[hot] + (keys[hot].view(np.uint64) % np.uint64(SALTS)))
            bucket = (mix(route) % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((hashes, bucket))
            bucket, hashes, keys, sizes = bucket[order], hashes[order], keys[order], sizes[order]
            ends = np.searchsorted(bucket, np.arange(buckets + 1))
            full = np.flatnonzero(ends[1:] > ends[:-1])
            cut = [slice(ends[b], ends[b + 1]) for b in full]
            yield pa.RecordBatch.from_arrays([
                pa.array(full), pa.array([hashes[c].tobytes() for c in cut], pa.binary()),
                pa.array([keys[c].tobytes() for c in cut], pa.binary()),
                pa.array([sizes[c].tobytes() for c in cut], pa.binary()),
            ], ["bucket", "hashes", "keys", "sizes"])

    def meet(batches):
        often, parts = shared.value, [[], [], []]
        for rows in batches:
            for i, kind in ((1, np.uint64), (2, np.int64), (3, np.int64)):
                parts[i - 1] += [np.frombuffer(b, kind) for b in rows.column(i).to_pylist()]
        if not parts[0]:
            return
        hashes, keys, sizes = (np.concatenate(p) for p in parts)
        order = np.lexsort((keys, hashes))
        hashes, keys, sizes = hashes[order], keys[order], sizes[order]
        new = np.ones(len(hashes), np.bool_)
        new[1:] = (hashes[1:] != hashes[:-1]) | (keys[1:] != keys[:-1])
        hashes, keys, sizes = hashes[new], keys[new], sizes[new]
        same = hashes[1:] == hashes[:-1]
        keep = np.zeros(len(hashes), np.bool_)
        keep[1:] |= same
        keep[:-1] |= same
        if len(often):  # their lists are dealt to several tasks
            keep |= np.isin(hashes, often)
        hashes, keys, sizes = hashes[keep], keys[keep], sizes[keep]
        for i in range(0, len(hashes), 50_000):
            part = slice(i, i + 50_000)
            packed = sizes[part]
            yield pa.RecordBatch.from_arrays([
                pa.array(hashes[part].view(np.int64)), pa.array(keys[part]),
                pa.array((packed & _LOW).astype(np.int32)),
                pa.array(((packed >> _RANK) & _LOW).astype(np.int32)), pa.array((packed >> _TWO) > 0),
            ], ["token", "key", "n", "rank", "two"])

    runs = rows.mapInArrow(split, _RUNS)
    return runs.repartition(parts, "bucket").mapInArrow(meet, _LISTS)


def _bounded(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes whose sketches allow the overlap they need."""
    side = lambda x: reps.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("ranges").alias(f"r_{x}"))
    ratio = F.least("n_a", "n_b") * LOWER >= F.greatest("n_a", "n_b") * UPPER
    both = pairs.join(side("a"), "a").join(side("b"), "b").where(ratio)

    def run(batches):
        for rows in batches:
            a, b, n, r, m, s = (rows.column(c).to_pylist() for c in ("a", "b", "n_a", "r_a", "n_b", "r_b"))
            keep = [i for i in range(len(a)) if overlap_bound(r[i], n[i], s[i], m[i]) >= needed_overlap(n[i], m[i])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([a[i] for i in keep], pa.int64()), pa.array([b[i] for i in keep], pa.int64())], ["a", "b"]
            )

    return both.select("a", "b", "n_a", "r_a", "n_b", "r_b").mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, reps: DataFrame, rows: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes whose sets reach the threshold, from their whole texts."""
    spark = rows.sparkSession
    pairs = stored(_bounded(pairs, reps), "jaccard-pairs")
    nodes = stored(
        pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        .join(reps.select("node", "row", "digest"), "node"), "jaccard-nodes",
    )
    # A filter of fixed size tells most texts that are not needed; the join after it is exact.
    words = nodes.select(F.pmod("row", F.lit(FILTER_BITS)).alias("at")).groupBy(
        F.shiftright("at", 5).alias("word")
    ).agg(F.expr("bit_or(shiftleft(cast(1 as bigint), cast(at & 31 as int)))").alias("bits")).toPandas()
    bits = np.zeros(FILTER_BITS // 32, np.uint32)
    bits[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).astype(np.uint32)
    shared = spark.sparkContext.broadcast(bits)

    def read(batches):
        def wanted():
            for batch in batches:
                at = np.mod(batch.column("key").to_numpy(), FILTER_BITS)
                hit = (shared.value[at >> 5] >> (at & 31).astype(np.uint32)) & 1
                if hit.any():
                    yield batch.filter(pa.array(hit.astype(np.bool_)))

        for part, tokens, edges, digests, _ in _sets(wanted(), False):
            yield pa.RecordBatch.from_arrays([
                part.column("key"), pa.array(digests, pa.binary()),
                pa.array([tokens[edges[i] : edges[i + 1]].tobytes() for i in range(len(digests))], pa.binary()),
            ], ["row", "digest", "tokens"])

    found = rows.mapInArrow(read, "row long, digest binary, tokens binary")
    sets = stored(
        found.join(nodes, ["row", "digest"]).groupBy("node").agg(F.first("tokens").alias("tokens")), "jaccard-sets"
    )
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("t_a")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("tokens").alias("t_b")), "b"
    ).select("a", "b", "t_a", "t_b")

    def compare(batches):
        for rows in batches:
            keep = []
            for x, y in zip(rows.column("t_a").to_pylist(), rows.column("t_b").to_pylist()):
                one, two = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(common >= needed_overlap(len(one), len(two)))
            yield rows.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return stored(both.mapInArrow(compare, "a long, b long"), "jaccard-links")


def similar(docs: DataFrame) -> DataFrame:
    """(doc_id, row, part, n_shingles, component_id) of every row of (doc_id, text).

    ``row`` is ``row_key`` of the text, ``part`` a number of its component, null for an empty set. A set holds the distinct n-grams of ``SHINGLE`` words, A-Z
    lowered; fewer words are one n-gram, and a text without words has an empty set and is linked with
    nothing. ``component_id`` is the smallest doc_id reachable by links; ids that are null name no
    component unless it has no other.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), row_key(F.col("doc_id"), F.col("text")).alias("key"), "text"
    )
    summary = stored(_summaries(rows), "jaccard-summary")
    # A task writes the sketches of a set once, so the largest is the one that is there.
    reps = stored(
        summary.where("kind = 0 and n > 0").groupBy("digest").agg(
            F.min("doc_id").alias("doc_id"), F.min("row").alias("row"), F.max("n").alias("n"),
            F.max("set_key").alias("set_key"), F.max("ranges").alias("ranges"),
            F.max("minima").alias("minima"),
        ).withColumn("node", F.monotonically_increasing_id()),
        "jaccard-reps",
    )
    often = (
        summary.where("kind = 1").groupBy("token").agg(F.sum("cnt").alias("cnt"))
        .where(F.col("cnt") >= OFTEN).orderBy(F.col("cnt").desc(), "token").limit(FREQUENT).toPandas()
    )
    frequent = np.sort(often["token"].to_numpy(np.int64).view(np.uint64))
    small = reps.where(F.col("n") <= LIGHT)
    sizes = {r["n"]: r["count"] for r in small.groupBy("n").count().collect()}
    seen = small.select(F.explode("minima").alias("m")).agg(
        F.count(F.lit(1)).alias("n"), F.approx_count_distinct("m").alias("d")
    ).first()
    boundary = choose_boundary(sizes, max(1.0, seen["n"] / max(1, seen["d"])))

    lists = stored(
        _lists(rows, frequent, boundary)
        .join(reps.select(F.col("set_key").alias("key"), "node"), "key")
        .select("token", "two", "node", "n", "rank"), "jaccard-lists",
    )
    first = _verified(_centers(lists), reps, rows)
    linked = components(first)
    pairs = _unlinked(lists, linked, boundary)
    more = _verified(pairs, reps, rows)
    # The later links join components, so only those are searched again.
    part = lambda x: linked.select(F.col("node").alias(x), F.col("component").alias(f"c_{x}"))
    between = more.join(part("a"), "a", "left").join(part("b"), "b", "left").select(
        F.coalesce("c_a", "a").alias("a"), F.coalesce("c_b", "b").alias("b")
    )
    joined = components(between).select(F.col("node").alias("_part"), F.col("component").alias("_whole"))
    named = stored(
        reps.select("node", "digest", "doc_id").join(linked, "node", "left")
        .withColumn("_first", F.coalesce("component", "node"))
        .join(joined, F.col("_first") == F.col("_part"), "left")
        .select("digest", "doc_id", F.coalesce("_whole", "_first").alias("component")),
        "jaccard-named",
    )
    names = stored(named.groupBy("component").agg(F.min("doc_id").alias("component_id")), "jaccard-names")
    result = named.join(names, "component").select(
        "digest", F.col("component").alias("part"), "component_id"
    )
    texts = summary.where("kind = 0").select("doc_id", "row", F.col("n").alias("n_shingles"), "digest")
    return texts.join(result, "digest", "left").select(
        "doc_id", "row", "part", F.col("n_shingles").cast("long").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )


def one_per_group(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component: that of the smallest doc_id, null last.

    Of rows that repeat it one stays. Documents without words are in no component and all stay.
    """
    found = similar(docs)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    keepers = stored(
        found.where(F.col("part").isNotNull()).groupBy("part").agg(F.min(order).alias("best"))
        .select(F.col("best.row").alias("_keep")).distinct(), "jaccard-keepers",
    )
    packed = docs.select(
        row_key(F.col("doc_id").cast("long"), F.col("text")).alias("_key"),
        (word_count(F.col("text")) == 0).alias("_empty"), F.struct(*docs.columns).alias("_row"),
    )
    kept = packed.where(~F.col("_empty")).join(keepers, F.col("_key") == F.col("_keep"), "left_semi")
    single = kept.groupBy("_key").agg(F.first("_row").alias("_row")).select("_row")
    return single.unionByName(packed.where("_empty").select("_row")).select("_row.*")


def _possible(boundary: int | None = None):
    """Whether entries a and b of one list may be a similar pair: by size, and by rank."""
    n_a, n_b = F.col("a.n"), F.col("b.n")
    ratio = F.least(n_a, n_b) * LOWER >= F.greatest(n_a, n_b) * UPPER
    needed = F.ceil((n_a + n_b) * UPPER / (LOWER + UPPER))
    inside = (F.col("a.rank") + needed <= n_a) & (F.col("b.rank") + needed <= n_b)
    use = F.lit(True) if boundary is None else F.col("a.two") | (F.greatest(n_a, n_b) > boundary)
    return ratio & inside & use


def _centers(lists: DataFrame) -> DataFrame:
    """Pairs of each set with the centers of its longest lists."""
    key = ["token", "two"]
    lengths = stored(lists.groupBy(*key).agg(F.count(F.lit(1)).alias("length")), "jaccard-lengths")
    # The set with the token first is the center of its class; a long list has one in each class.
    ends = stored(
        lists.groupBy(*key, F.pmod(F.xxhash64("node"), F.lit(CLASSES)).alias("class"))
        .agg(F.min(F.struct("rank", "n", "node")).alias("c")).select(*key, "c.*"), "jaccard-centers",
    )
    # A set has no more entries than its prefix; its longest lists are those it is compared in.
    every = lists.join(lengths, key).groupBy("node").agg(
        F.collect_list(F.struct("length", "token", "two", "rank", "n")).alias("all")
    )
    near = every.select("node", F.explode(F.slice(F.sort_array("all", asc=False), 1, CENTERS)).alias("e"))
    a, b = near.select("node", "e.*").alias("a"), ends.alias("b")
    same = (F.col("a.token") == F.col("b.token")) & (F.col("a.two") == F.col("b.two"))
    return a.join(b, same & (F.col("a.node") != F.col("b.node")) & _possible()).select(
        F.least("a.node", "b.node").alias("a"), F.greatest("a.node", "b.node").alias("b")
    ).distinct()


def _unlinked(lists: DataFrame, linked: DataFrame, boundary: int) -> DataFrame:
    """Pairs (a, b) of sets in one list that are not connected yet."""
    placed = stored(
        lists.join(linked, "node", "left").withColumn("part", F.coalesce("component", "node")).drop("component"),
        "jaccard-parts",
    )
    mixed = stored(
        placed.groupBy("token", "two").agg(F.min("part").alias("lo"), F.max("part").alias("hi"))
        .where("lo < hi").select("token", "two"), "jaccard-mixed",
    )
    open_ = stored(placed.join(mixed, ["token", "two"], "left_semi"), "jaccard-open")
    a, b = open_.alias("a"), open_.alias("b")
    same = (F.col("a.token") == F.col("b.token")) & (F.col("a.two") == F.col("b.two"))
    return a.join(b, same & (F.col("a.part") < F.col("b.part")) & _possible(boundary)).select(
        F.least("a.node", "b.node").alias("a"), F.greatest("a.node", "b.node").alias("b")
    ).distinct()


def jaccard_query(spark, sf_dir: str) -> DataFrame:
    """Set size and component of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return similar(docs).drop("row", "part")
