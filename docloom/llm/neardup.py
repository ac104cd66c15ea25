"""Near-duplicate embeddings by a subspace pigeonhole join.

Unit vectors with cosine of at least t lie within the squared distance 2 (1 - t). Vectors are
rotated and split into blocks; of two such vectors, some block differs by at most its part of that
budget, in proportion to its dimensions. Each block is range-joined over a grid on its first
coordinates, and candidates are verified exactly. A pair belongs to the first block within its
budget and to the cell of its midpoint there, so it is counted once, and no pair leaves a task:
tasks return link counts and spanning links.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.llm.components import components, local_roots
from docloom.llm.store import stored
from docloom.llm.vectors import matrix, rotation, units, usable

THRESHOLD = 0.95
BLOCKS = 4
# Coordinates of a block that make its grid, and the width of a cell in reaches of the budget.
# Every vector goes to about (1 + 1 / CELL) ** GRID cells of each block.
GRID, CELL = 2, 2.0
# Rows of a cell that one task compares; larger cells are cut into chunks, compared by twos.
CHUNK_ROWS = 16_384
TILE = 512


class _Plan:
    """Blocks, budgets and grid for vectors of one size."""

    def __init__(self, size: int, threshold: float, blocks: int):
        self.size, self.threshold = size, threshold
        self.rotation = rotation(size)
        count = min(blocks, size)
        edges = [size * b // count for b in range(count + 1)]
        self.blocks = list(zip(edges[:-1], edges[1:]))
        total = 2 * (1 - threshold) * (1 + 1e-9) + 1e-12
        self.budgets = [total * (e - b) / size for b, e in self.blocks]
        self.grids = [min(GRID, e - b) for b, e in self.blocks]

    def rotated(self, unit: np.ndarray) -> np.ndarray:
        """Rotation with one order of additions, so that every task gets the same bits."""
        out = np.empty_like(unit)
        for begin in range(0, len(unit), 256):
            part = unit[begin : begin + 256]
            out[begin : begin + 256] = (part[:, None, :] * self.rotation.T[None]).sum(axis=2)
        return out

    def cells(self, block: int, coordinates: np.ndarray) -> np.ndarray:
        return np.floor(coordinates / (CELL * math.sqrt(self.budgets[block]))).astype(np.int64)

    def spread(self, block: int, rotated: np.ndarray):
        """(row, cell) for each cell that holds a midpoint with some vector within the budget."""
        begin, _ = self.blocks[block]
        near = rotated[:, begin : begin + self.grids[block]]
        reach = math.sqrt(self.budgets[block]) / 2 * (1 + 1e-6)
        low, high = self.cells(block, near - reach), self.cells(block, near + reach)
        for choice in range(1 << self.grids[block]):
            bits = np.array([choice >> i & 1 for i in range(self.grids[block])], np.bool_)
            rows = np.flatnonzero((high != low)[:, bits].all(axis=1))
            yield rows, np.where(bits, high[rows], low[rows])

    def links(self, block: int, cell: np.ndarray, unit: np.ndarray, other: np.ndarray | None):
        """Index pairs (of ``unit``, of ``other`` or ``unit``) that are linked and belong here."""
        begin, end = self.blocks[block]
        budget, same = self.budgets[block], other is None
        second = unit if same else other
        turned = [(u @ self.rotation).astype(np.float32) for u in (unit, second)]
        part = [t[:, begin:end] for t in turned]
        halves = [(p * p).sum(axis=1, keepdims=True) / 2 for p in part]
        ones = [np.ones_like(h) for h in halves]
        # One product gives half the negative squared distance.
        left = np.hstack([part[0], -halves[0], ones[0]])
        right = np.hstack([part[1], ones[1], -halves[1]]).T.copy()
        least = np.float32(-(budget * 1.001 + 1e-5) / 2)
        for top in range(0, len(unit), TILE):
            i, j = np.nonzero(left[top : top + TILE] @ right >= least)
            i += top
            if same:
                i, j = i[i < j], j[i < j]
            for first in range(0, len(i), 1 << 16):
                yield self._verified(
                    block, cell, unit, second, turned, i[first : first + (1 << 16)], j[first : first + (1 << 16)]
                )

    def _verified(self, block, cell, unit, second, turned, i, j):
        # Pairs that are clearly within an earlier budget belong there.
        keep = np.ones(len(i), np.bool_)
        for b in range(block):
            begin, end = self.blocks[b]
            gap = turned[0][i, begin:end] - turned[1][j, begin:end]
            keep &= (gap * gap).sum(axis=1) > self.budgets[b] * 0.999 - 1e-5
        i, j = i[keep], j[keep]
        close = (unit[i] * second[j]).sum(axis=1) >= self.threshold
        i, j = i[close], j[close]
        if not len(i):
            return i, j
        rows, back = np.unique(i, return_inverse=True)
        x = self.rotated(unit[rows])[back]
        rows, back = np.unique(j, return_inverse=True)
        y = self.rotated(second[rows])[back]
        owner = np.full(len(i), -1)
        for b in range(block, -1, -1):
            begin, end = self.blocks[b]
            owner[((x[:, begin:end] - y[:, begin:end]) ** 2).sum(axis=1) <= self.budgets[b]] = b
        begin, grid = self.blocks[block][0], self.grids[block]
        middle = (x[:, begin : begin + grid] + y[:, begin : begin + grid]) / 2
        mine = (owner == block) & (self.cells(block, middle) == cell[:grid]).all(axis=1)
        return i[mine], j[mine]


def near_duplicates(
    vectors: DataFrame, threshold: float = THRESHOLD, blocks: int = BLOCKS, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of (vec_id, embedding).

    Equal vectors are joined as one with its number of copies. Vectors of different sizes, and
    those that are null, zero or not finite, link with nothing. Rows that repeat an id are vectors
    of their own; the component is named by the smallest id in it, null only if it has none.
    """
    if not 0.5 <= threshold < 1:
        raise ValueError("threshold must be at least 0.5 and below 1")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    good = rows.where(usable(F.col("embedding")))
    reps = stored(
        good.groupBy("embedding")
        .agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("copies"))
        .withColumn("node", F.monotonically_increasing_id()),
        "vector-reps",
    )
    # Components travel in their own precision; sums are in double precision.
    number = "<f4" if rows.schema["embedding"].dataType == T.ArrayType(T.FloatType()) else "<f8"
    columns = "cell binary, size int, block int, node long, copies long, vector binary"

    def assign(batches):
        plans: dict[int, _Plan] = {}
        for batch in batches:
            column = batch.column("embedding")
            sizes = column.value_lengths().to_numpy()
            for size in np.unique(sizes).tolist():
                plan = plans.setdefault(size, _Plan(size, threshold, blocks))
                chosen = pa.array(np.flatnonzero(sizes == size))
                given = matrix(column.take(chosen), size)
                node = batch.column("node").take(chosen).to_numpy()
                copies = batch.column("copies").take(chosen).to_numpy()
                rotated = units(given) @ plan.rotation
                for block in range(len(plan.blocks)):
                    for at, cell in plan.spread(block, rotated):
                        if len(at):
                            yield pa.RecordBatch.from_arrays([
                                pa.array([c.tobytes() for c in cell], pa.binary()),
                                pa.array(np.full(len(at), size, np.int32)),
                                pa.array(np.full(len(at), block, np.int32)),
                                pa.array(node[at]), pa.array(copies[at]),
                                pa.array([v.tobytes() for v in given[at].astype(number)], pa.binary()),
                            ], ["cell", "size", "block", "node", "copies", "vector"])

    key = ["size", "block", "cell"]
    placed = reps.select("embedding", "node", "copies").mapInArrow(assign, columns)
    crowded = stored(
        placed.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > chunk_rows)
        .select(*key, F.ceil(F.col("n") / chunk_rows).cast("int").alias("chunks")),
        "vector-cells",
    )
    own = F.coalesce(F.pmod(F.xxhash64("node"), F.col("chunks")), F.lit(0)).cast("int")
    spread = (
        placed.join(crowded, key, "left")
        .withColumn("own", own)
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.coalesce("chunks", F.lit(1)) - 1)))
        .select(
            *key, F.least("own", "with").alias("low"), F.greatest("own", "with").alias("high"),
            "own", "node", "copies", "vector",
        )
    )

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        size, block = int(group["size"].iloc[0]), int(group["block"].iloc[0])
        low, high = group["low"].iloc[0], group["high"].iloc[0]
        cell = np.frombuffer(group["cell"].iloc[0], np.int64)
        plan = _Plan(size, threshold, blocks)
        group = group.sort_values(["own", "node"], kind="stable")
        unit = units(np.stack([np.frombuffer(v, number) for v in group["vector"]]).astype(np.float64))
        node, copies = group["node"].to_numpy(), group["copies"].to_numpy()
        border = int((group["own"] == low).sum()) if low != high else 0
        found = (
            plan.links(block, cell, unit, None) if low == high
            else plan.links(block, cell, unit[:border], unit[border:])
        )
        total = np.zeros(len(node), np.int64)
        roots = np.arange(len(node))
        for i, j in found:
            if not len(i):
                continue
            j = j + border
            np.add.at(total, i, copies[j])
            np.add.at(total, j, copies[i])
            # Links found before stay in the labels.
            every = np.arange(len(node))
            roots = local_roots(np.concatenate((every, i)), np.concatenate((roots, j)), len(node))
        some = np.flatnonzero(total)
        return pd.DataFrame({"node": node[some], "links": total[some], "other": node[roots[some]]})

    found = stored(
        spread.groupBy(*key, "low", "high").applyInPandas(compare, "node long, links long, other long"),
        "vector-links",
    )
    linked = found.groupBy("node").agg(F.sum("links").alias("links"))
    parts = components(found.select(F.col("node").alias("a"), F.col("other").alias("b")))
    joined = stored(
        reps.join(linked, "node", "left").join(parts, "node", "left").select(
            "node", "embedding", "vec_id",
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "node").alias("component"),
        ),
        "vector-joined",
    )
    names = stored(joined.groupBy("component").agg(F.min("vec_id").alias("component_id")), "vector-names")
    table = stored(
        joined.join(names, "component").select(
            F.col("embedding").alias("_vector"), "n_links", "component_id"
        ),
        "vector-result",
    )
    bad = rows.where(~usable(F.col("embedding"))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    matched = good.join(table, good["embedding"] == table["_vector"]).select(
        "vec_id", "n_links", "component_id"
    )
    return matched.unionByName(bad).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def neardup_query(spark, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
