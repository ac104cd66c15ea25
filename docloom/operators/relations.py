"""Parent and child rows, foreign fields, and filtered views, as equi-joins and filters.

Only the keys of the side that is merely asked about travel, each once, so that a parent with a
third of all children weighs no more than any other; joins that return the children leave hot
keys to adaptive skew handling.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def filtered_view(
    docs: DataFrame, name: str, field: str, term: object,
    routing_field: str | None = None, routing: object = None,
) -> DataFrame:
    """Register the rows whose field equals the term as a view, optionally of one route only."""
    rows = docs.where(F.col(field) == F.lit(term))
    if routing_field is not None:
        rows = rows.where(F.col(routing_field) == F.lit(routing))
    rows.createOrReplaceTempView(name)
    return docs.sparkSession.table(name)


def _keys(rows: DataFrame, key: str, name: str) -> DataFrame:
    return rows.select(F.col(key).alias(name)).where(F.col(name).isNotNull()).distinct()


def parent_children(parent: DataFrame, child: DataFrame, key: str, parent_key: str) -> DataFrame:
    """Each parent with each of its children; ``parent_key`` is the child's column."""
    return parent.join(child, F.col(key) == F.col(parent_key))


def has_child(
    parent: DataFrame, child: DataFrame, key: str, parent_key: str, condition: Column | None = None
) -> DataFrame:
    """Parents with at least one child meeting the condition."""
    matching = child if condition is None else child.where(condition)
    return parent.join(_keys(matching, parent_key, key), key, "left_semi")


def childless(parent: DataFrame, child: DataFrame, key: str, parent_key: str) -> DataFrame:
    """Parents without any child."""
    return parent.join(_keys(child, parent_key, key), key, "left_anti")


def has_parent(
    child: DataFrame, parent: DataFrame, key: str, parent_key: str, condition: Column
) -> DataFrame:
    """Children whose parent meets the condition."""
    return child.join(_keys(parent.where(condition), key, parent_key), parent_key, "left_semi")


def children_rollup(
    parent: DataFrame, child: DataFrame, key: str, parent_key: str, totals: dict[str, Column]
) -> DataFrame:
    """Child count and totals per parent; parents without children get zeros."""
    rolled = child.groupBy(F.col(parent_key).alias(key)).agg(
        F.count(F.lit(1)).alias("children"),
        *[F.sum(amount).alias(name) for name, amount in totals.items()],
    )
    return parent.join(rolled, key, "left").na.fill(0, ["children", *totals])


def multi_level(levels: list[tuple[DataFrame, str | None, str | None]]) -> DataFrame:
    """Join a chain of levels: each ``(rows, parent's column, own column naming the parent)``."""
    (joined, _, _), *rest = levels
    for rows, key, parent_key in rest:
        joined = joined.join(rows, F.col(key) == F.col(parent_key))
    return joined


def foreign_field(rows: DataFrame, foreign: DataFrame, field: str, foreign_key: str) -> DataFrame:
    """Rows with the foreign row their field names; unresolved ones keep NULLs."""
    return rows.join(foreign, F.col(field) == F.col(foreign_key), "left")


def store_routed(rows: DataFrame, key: str, table: str, path: str, buckets: int = 64) -> DataFrame:
    """Store rows by the hash of their routing key, so that tables of one route and equally many buckets
    are joined and rolled up without moving a row.

    ``table`` names the table in the session's catalog, ``path`` its folder. Every operator of this module
    takes the result as it takes other rows.
    """
    writer = rows.write.mode("errorifexists").option("path", path).bucketBy(buckets, key).sortBy(key)
    writer.saveAsTable(table)
    return rows.sparkSession.table(table)


def store_chain(
    levels: list[tuple[DataFrame, str | None, str | None]], root_key: str, name: str, path: str, buckets: int = 64,
) -> list[tuple[DataFrame, str | None, str | None]]:
    """Store a chain of levels, as ``multi_level`` takes it, by the key of the root each row belongs to.

    Every row gets the route of its root, ``_route0``, ``_route1`` and so on by level, once, when it is
    stored; a row without a root is not in the chain and is left out. ``multi_level_routed`` then joins
    without moving rows.
    """
    stored, routes = [], None
    for i, (rows, key, parent_key) in enumerate(levels):
        route = f"_route{i}"
        if routes is None:
            routed = rows.withColumn(route, F.col(root_key))
        else:
            routed = rows.join(routes, F.col(parent_key) == F.col("_parent")).drop("_parent").withColumnRenamed("_route", route)
        table = store_routed(routed.where(F.col(route).isNotNull()), route, f"{name}_{i}", f"{path}/{i}", buckets)
        stored.append((table, key, parent_key))
        if i + 1 < len(levels):
            routes = table.select(F.col(levels[i + 1][1]).alias("_parent"), F.col(route).alias("_route")).distinct()
    return stored


def multi_level_routed(levels: list[tuple[DataFrame, str | None, str | None]]) -> DataFrame:
    """Join a stored chain by route and key, bucket by bucket.

    The session is told that rows of one route need not be dealt again by the other keys of a join.
    """
    (joined, _, _), *rest = levels
    joined.sparkSession.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    for i, (rows, key, parent_key) in enumerate(rest, 1):
        same = (F.col(f"_route{i - 1}") == F.col(f"_route{i}")) & (F.col(key) == F.col(parent_key))
        joined = joined.join(rows.hint("merge"), same)
    return joined.drop(*[f"_route{i}" for i in range(len(levels))])
