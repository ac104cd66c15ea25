"""Approximate nearest neighbours by inner product with an adaptive scan of dimensions.

Vectors get one more component that makes all lengths equal, so the largest inner product is the
smallest angle, and each goes to the list of its nearest center. Centers are fitted on a bounded
sample; every vector is indexed. A query probes a share of the lists, nearest first, and goes on until
they hold ``AMPLE`` times the rows it asks for or all are probed. Inside a list vectors are
rotated and read in blocks of columns: after each block the partial distance estimates the whole
one, and a candidate is given up if a hypothesis test rejects that it is as near as the query needs. Scores of what remains are exact, from the original vectors.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.store import lowest, stored
from docloom.llm.vectors import matrix, rotation, usable

# Bound of the sample that the centers are fitted on, and the most lists.
SAMPLE, LISTS = 16_384, 1024
# Share of the lists that a query probes, and how many of them set its first bound.
PROBED, FIRST = 0.75, 2
# Candidates that the probed lists hold at least, for each row that is asked for.
AMPLE = 20
# Columns of a block, and the level of the test.
COLUMNS, LEVEL = 16, 1.6
CHUNK_ROWS, CHUNK_QUERIES, TILE = 4096, 2048, 128


def extended(rows: np.ndarray, longest: float) -> np.ndarray:
    """Rows with one more component that brings every length to ``longest``."""
    rest = np.sqrt(np.maximum(longest**2 - (rows * rows).sum(axis=1), 0))
    return np.hstack([rows, rest[:, None]]) / longest


def fit_centers(rows: np.ndarray, lists: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """Unit centers by spherical k-means; an empty list keeps its center."""
    random = np.random.default_rng(seed)
    centers = rows[random.choice(len(rows), min(lists, len(rows)), replace=False)].copy()
    for _ in range(rounds):
        near = np.concatenate([(rows[i : i + 2048] @ centers.T).argmax(axis=1) for i in range(0, len(rows), 2048)])
        total = np.zeros_like(centers)
        np.add.at(total, near, rows)
        length = np.sqrt((total * total).sum(axis=1))
        full = length > 0
        centers[full] = total[full] / length[full, None]
    return centers


class Index:
    """Centers for each size of vectors, and the rows that each list holds once they are counted."""

    def __init__(self, centers: dict[int, np.ndarray], longest: dict[int, float], held: dict | None = None):
        self.centers, self.longest, self.held = centers, longest, held or {}

    def _of(self, size: int) -> np.ndarray:
        return self.centers.get(size, np.eye(1, size + 1))

    def lists(self, rows: np.ndarray) -> np.ndarray:
        size = rows.shape[1]
        return (extended(rows, self.longest[size]) @ self._of(size).T).argmax(axis=1)

    def probes(self, rows: np.ndarray, share: float, least: int, needed: np.ndarray) -> tuple:
        """Lists of each query, nearest first, and how many of them it probes to see ``needed`` rows."""
        size = rows.shape[1]
        centers = self._of(size)
        order = np.argsort(-(rows @ centers[:, :-1].T), axis=1, kind="stable")
        sizes = np.zeros(len(centers), np.int64)
        for place, n in self.held.get(size, ()):
            sizes[place] = n
        short = (np.cumsum(sizes[order], axis=1) < needed[:, None]).sum(axis=1) + 1
        return order, np.minimum(len(centers), np.maximum(short, max(least, math.ceil(share * len(centers)))))


def scan(queries: np.ndarray, needed: np.ndarray, ids: np.ndarray, rows: np.ndarray, own: np.ndarray, k: int):
    """Best ``k`` of one list for each query: (query place, row place, score) arrays.

    ``needed`` is the score below which a candidate is of no use. Candidates with the id of the
    query (``own``) take no part.
    """
    size = rows.shape[1]
    turn = rotation(size)
    edges = [*range(0, size, COLUMNS), size]
    x, q = rows @ turn, queries @ turn
    # Squared lengths of what the blocks up to each column hold.
    head_x, head_q = np.cumsum(x * x, axis=1), np.cumsum(q * q, axis=1)
    out = []
    for top in range(0, len(q), TILE):
        part = slice(top, min(top + TILE, len(q)))
        partial = q[part, : edges[1]] @ x[:, : edges[1]].T
        partial[own[part][:, None] == ids] = -np.inf
        need = needed[part].copy()
        sure = np.zeros(partial.shape, bool)
        if len(ids) > k:
            # A first bound from the rows that lead after one block, scored exactly.
            lead = np.argpartition(-partial, min(2 * k, len(ids) - 1), axis=1)[:, : 2 * k]
            exact = np.einsum("id,ijd->ij", queries[part], rows[lead])
            exact[np.take_along_axis(partial, lead, 1) == -np.inf] = -np.inf
            kept = min(k, lead.shape[1])
            need = np.maximum(need, np.sort(exact, axis=1)[:, -kept])
            # What is known to be near enough is not tested.
            np.put_along_axis(sure, lead, exact >= need[:, None], axis=1)
        i, j = np.nonzero(partial > -np.inf)
        got, sure = partial[i, j], sure[i, j]
        need = need - 1e-9 * np.maximum(1, np.abs(need))
        # Squared distance at which the inner product is just what the query needs.
        reach = np.maximum(head_q[top + i, -1] + head_x[j, -1] - 2 * need[i], 0)
        for begin, end in zip(edges[1:], [*edges[2:], None]):
            gap = head_q[top + i, begin - 1] + head_x[j, begin - 1] - 2 * got
            # After a random rotation the gap over some columns estimates the whole distance; the
            # margin shrinks as columns come in and is gone when all are read.
            margin = (1 + LEVEL / math.sqrt(begin)) ** 2 if begin < size else 1.0
            stay = sure | (gap * (size / begin) <= reach * margin + 1e-9 * (1 + head_x[j, -1]))
            i, j, got, reach, sure = i[stay], j[stay], got[stay], reach[stay], sure[stay]
            if end is None or not len(i):
                break
            got = got + (q[top + i, begin:end] * x[j, begin:end]).sum(axis=1)
        score = (queries[top + i] * rows[j]).sum(axis=1)
        order = np.lexsort((ids[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        place = np.arange(len(i)) - np.searchsorted(i, i)
        good = (place < k) & (score >= needed[part][i])
        out.append((top + i[good], j[good], score[good]))
    return [np.concatenate(p) for p in zip(*out)] if out else [np.zeros(0, np.int64)] * 3


def build(vectors: DataFrame, sample: int = SAMPLE, lists: int | None = None) -> Index:
    """Index centers from at most ``sample`` vectors of lowest hash; lengths are read from all."""
    size = F.size("embedding")
    square = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    stats = vectors.groupBy(size.alias("size")).agg(
        F.count(F.lit(1)).alias("n"), F.sqrt(F.max(square)).alias("longest")
    ).collect()
    longest = {r["size"]: r["longest"] for r in stats}
    total = {r["size"]: r["n"] for r in stats}
    chosen = lowest(vectors, sum(total.values()), sample, "vec_id").select("embedding").collect()
    by_size: dict[int, list] = {}
    for row in chosen:
        by_size.setdefault(len(row[0]), []).append(row[0])
    centers = {}
    for n, rows in by_size.items():
        count = lists or max(1, min(LISTS, round(math.sqrt(total[n]))))
        centers[n] = fit_centers(extended(np.array(rows, np.float64), longest[n]), count)
    return Index(centers, longest)


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 20, probed: float = PROBED, index: Index | None = None
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each query, nearest first.

    Both tables have (vec_id, embedding). Nearness is the inner product in double precision, ties
    go to the smaller vec_id. Rows without id, and vectors that are null, zero or not finite, take
    no part; a vector is compared with queries of its own size. Rows with the id of a query are not
    its candidates; a query row that is repeated counts once.
    """
    def clean(df: DataFrame) -> DataFrame:
        rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
        return rows.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))

    rows, asked = clean(vectors), clean(queries).distinct()
    index = index or build(rows)
    shared = rows.sparkSession.sparkContext.broadcast((index.centers, index.longest))

    def by_size(batch):
        sizes = batch.column("embedding").value_lengths().to_numpy()
        for size in np.unique(sizes).tolist():
            chosen = pa.array(np.flatnonzero(sizes == size))
            yield size, batch.column("vec_id").take(chosen).to_numpy(), matrix(
                batch.column("embedding").take(chosen), size
            )

    def assign(batches):
        model = Index(*shared.value)
        for batch in batches:
            for size, ids, given in by_size(batch):
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(ids), size, np.int32)),
                    pa.array(model.lists(given).astype(np.int32)),
                    pa.array(ids), pa.array([v.tobytes() for v in given], pa.binary()),
                ], ["size", "list", "vec_id", "vector"])

    listed = stored(rows.mapInArrow(assign, "size int, list int, vec_id long, vector binary"), "lists")
    key = ["size", "list"]
    counted = stored(listed.groupBy(*key).agg(F.count(F.lit(1)).alias("n")), "list-chunks")
    chunks = counted.select(*key, F.ceil(F.col("n") / CHUNK_ROWS).cast("int").alias("chunks"))
    held: dict[int, list] = {}
    for row in counted.collect():
        held.setdefault(row["size"], []).append((row["list"], row["n"]))
    counts = rows.sparkSession.sparkContext.broadcast(held)
    # Rows with the id of a query are no candidates and come on top of what its lists must hold.
    own = listed.join(asked.select("vec_id").distinct(), "vec_id", "left_semi")
    own = own.groupBy("size", "vec_id").agg(F.count(F.lit(1)).alias("own"))
    asked = asked.withColumn("size", F.size("embedding")).join(own, ["size", "vec_id"], "left").select(
        "vec_id", "embedding", F.coalesce("own", F.lit(0)).alias("own")
    )

    def probe(batches):
        model = Index(*shared.value, counts.value)
        for batch in batches:
            same = batch.column("own").to_numpy()
            sizes = batch.column("embedding").value_lengths().to_numpy()
            for size, ids, given in by_size(batch):
                if size not in model.longest:
                    continue
                needed = AMPLE * k + same[sizes == size]
                for begin in range(0, len(ids), 256):
                    part = given[begin : begin + 256]
                    found, width = model.probes(part, probed, FIRST, needed[begin : begin + 256])
                    turn = np.arange(found.shape[1])
                    used = turn < width[:, None]
                    raw = [v.tobytes() for v in part]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(used.sum(), size, np.int32)),
                        pa.array(found[used].astype(np.int32)),
                        pa.array(np.broadcast_to(turn, used.shape)[used].astype(np.int32)),
                        pa.array(np.repeat(ids[begin : begin + 256], width)),
                        pa.array([v for v, n in zip(raw, width) for _ in range(n)], pa.binary()),
                    ], ["size", "list", "turn", "query_id", "query"])

    probes = asked.mapInArrow(probe, "size int, list int, turn int, query_id long, query binary")

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        columns = ["query_id", "query", "vec_id", "score"]
        if not len(left) or not len(right):
            return pd.DataFrame({c: [] for c in columns})
        given = np.stack([np.frombuffer(v, np.float64) for v in left["vector"]])
        wanted = np.stack([np.frombuffer(v, np.float64) for v in right["query"]])
        ids, own = left["vec_id"].to_numpy(), right["query_id"].to_numpy()
        i, j, score = scan(wanted, right["needed"].to_numpy(), ids, given, own, k)
        return pd.DataFrame({
            "query_id": own[i], "query": right["query"].to_numpy()[i], "vec_id": ids[j], "score": score
        })

    def run(asking: DataFrame) -> DataFrame:
        """Search of (size, list, query_id, query, needed) rows, in groups of bounded size."""
        asking = asking.join(chunks, key)
        parts = stored(
            asking.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / CHUNK_QUERIES).cast("int").alias("parts")),
            "list-parts",
        )
        left = (
            listed.join(chunks, key).join(parts, key)
            .withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.col("chunks")).cast("int"))
            .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .select(*key, "chunk", "part", "vec_id", "vector")
        )
        right = (
            asking.join(parts, key)
            .withColumn("part", F.pmod(F.xxhash64("query_id"), F.col("parts")).cast("int"))
            .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
            .select(*key, "chunk", "part", "query_id", "query", "needed")
        )
        group = [*key, "chunk", "part"]
        return left.groupBy(*group).cogroup(right.groupBy(*group)).applyInPandas(
            search, "query_id long, query binary, vec_id long, score double"
        )

    order = Window.partitionBy("query_id", "query").orderBy(F.col("score").desc(), "vec_id")
    best = lambda df: df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    floor = F.lit(float("-inf"))
    first = stored(best(run(probes.where(F.col("turn") < FIRST).withColumn("needed", floor))), "first-found")
    bounds = first.where(F.col("rank") == k).select("query_id", "query", F.col("score").alias("bound"))
    later = probes.where(F.col("turn") >= FIRST).join(bounds, ["query_id", "query"], "left")
    more = run(later.withColumn("needed", F.coalesce("bound", floor)))
    return best(first.drop("rank").unionByName(more)).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )


def search_query(spark, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"))
