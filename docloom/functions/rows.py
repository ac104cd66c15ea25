"""Arrays to rows.

A plain ``explode`` makes the optimizer add a filter on the array's size, which evaluates the
array a second time for every row. The arrays here are costly (parsed documents, tokenized
texts), so the outer form is used and its one row for an empty array dropped afterwards.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), 0)


def held(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a column computed once per row, whatever is derived from it later.

    The optimizer copies a column's expression into every filter on what is derived from it, and there
    each mention is computed anew; a generated column is not copied.
    """
    rest = [c for c in df.columns if c != name]
    generated = df.select(*rest, F.explode_outer(F.array(name)).alias(name))
    return generated.select(*df.columns)


# Parts that the rows of one key are dealt to.
SALTS = 32


def spread_join(many: DataFrame, few: DataFrame, on: list[str], by: str, how: str = "inner") -> DataFrame:
    """``many.join(few, on, how)`` for keys that a large part of ``many`` may share.

    The rows of a key are dealt by the hash of column ``by`` to ``SALTS`` parts, and ``few`` is repeated for
    each: no task gets all rows of a key. For inner, left and semi joins, which keep rows of ``many``.
    """
    dealt = many.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int"))
    repeated = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return dealt.join(repeated, [*on, "_salt"], how).drop("_salt")


def explode_rows(df: DataFrame, array: Column, name: str, *keep: str) -> DataFrame:
    """``keep`` and one row per non-null element."""
    rows = df.select(*keep, F.explode_outer(array).alias(name))
    return rows.where(F.col(name).isNotNull())


def posexplode_rows(df: DataFrame, array: Column, name: str, *keep: str) -> DataFrame:
    """``keep``, ``pos`` and one row per element."""
    rows = df.select(*keep, F.posexplode_outer(array).alias("pos", name))
    return rows.where(F.col("pos").isNotNull())


def inline_rows(df: DataFrame, array: Column, names: list[str], *keep: str) -> DataFrame:
    """``keep`` and the struct fields of every element; the first field is never null."""
    rows = df.select(*keep, F.inline_outer(array).alias(*names))
    return rows.where(F.col(names[0]).isNotNull())
