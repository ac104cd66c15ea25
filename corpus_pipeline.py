"""From raw documents to tokens: language, near copies, personal data, mixture, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm import bpe, jaccard, language, mixing, pii
from docloom.llm.store import stored


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in some language, a null one as predicted; those with null text or without letters go."""
    model = language.train(docs.where(~language.held_out()))
    packed = docs.select(F.struct(*docs.columns).alias("_row"), "text")
    found = language.predict(packed, model, ["_row"])
    # Without any labelled text there is nothing to tell languages by, and nothing goes.
    if not model["names"]:
        return found.select("_row.*")
    kept = found.where(F.col("lang_pred") != language.UNKNOWN)
    named = F.col("_row").withField("lang", F.coalesce("_row.lang", "lang_pred"))
    return kept.select(named.alias("_row")).select("_row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard.one_per_group(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by tags; ``n_chars`` follows."""
    masked = pii.mask(docs, pii.train(docs))
    if "n_chars" not in docs.columns:
        return masked
    kind = docs.schema["n_chars"].dataType
    chars = F.when(F.col("text").isNotNull(), F.char_length("text").cast(kind)).otherwise(F.col("n_chars"))
    return masked.withColumn("n_chars", chars)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mixture takes it."""
    return mixing.emit(docs)


def encode_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, their number, and digests of the ids and of the decoded text."""
    rows = docs.select("doc_id", "lang", "source", "text")
    return bpe.round_trip(rows, bpe.default_path()).select(
        "doc_id", "lang", "source",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language", identify_language),
    ("near_copies", drop_near_copies),
    ("personal_data", mask_personal_data),
    ("mixture", mix_sources),
    ("encoding", encode_documents),
]

# Learned models, hashes of shingles and byte-pair merges have no SQL; tests compare the stages
# with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
