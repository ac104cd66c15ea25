"""Small tables with awkward rows, shared by the tests of this folder."""

from __future__ import annotations

import duckdb
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # Names that the operators use for their own columns.
    T.StructField("score", T.StringType()), T.StructField("key", T.IntegerType()),
    T.StructField("_text", T.StringType()), T.StructField("n", T.StringType()),
])
SMALL = "/root/testdata/sf0.001"
TAIL = ("x", 1, "y", "z")


def given(limit: int | None = None, table: str = "documents", sf: str = SMALL) -> list[tuple]:
    sql = f"SELECT * FROM '{sf}/{table}.parquet' ORDER BY 1" + (f" LIMIT {limit}" if limit else "")
    return duckdb.connect().execute(sql).fetchall()


def awkward() -> list[tuple]:
    """Null columns, empty and very long texts, repeated rows, ids that clash or are missing."""
    words = " ".join(f"w{i % 977}x{i // 977}" for i in range(60_000))
    plain = "the quick brown fox jumps over the lazy dog and runs away from the old bear"
    rows = [
        (900_001, None, "en", "src0"), (900_002, "", "en", None), (900_003, " \n\t ", None, "src0"),
        (900_004, "123 456 !!", "de", "src1"), (900_005, words, "en", "src1"),
        (900_006, "a" * 200_000, None, None), (900_007, plain, "en", "src2"),
        (900_008, plain, "en", "src2"), (900_008, plain, "en", "src2"),
        (None, plain + " again", "en", "src0"), (None, plain + " again", "en", "src0"),
        (None, None, None, None), (900_009, "Ünï cödé 日本語 ΑΣ \x00 nul", "fr", ""),
        (900_010, plain.upper(), "en", "src3"), (900_010, "another text under one id", "en", "src3"),
        (900_011, "one", "en", "src3"), (900_012, "one two", "en", "src3"),
    ]
    return [(*r, len(r[1]) if r[1] else None) for r in rows]


def documents(spark, rows: list[tuple]):
    return spark.createDataFrame([(*r, *TAIL) for r in rows], DOCS)
