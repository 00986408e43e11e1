"""From raw documents to packed sequences: each stage works on what the one before it kept.

Every stage but the last returns the columns of its input. Nulls, repeated rows and further columns pass through; a null
text is an empty one to every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import toxicity as toxic
from tidemark.llm.exact_dedup import exact_duplicates
from tidemark.llm.jaccard import jaccard_components
from tidemark.llm.packing import pack_documents
from tidemark.llm.secrets import mask_secrets
from tidemark.session import materialise, ship_package, text_batches

#: As the operators lower-case: A-Z only.
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SHA = "_text_sha256_of_stage"
#: Pieces that a worker remembers while it packs: workers of earlier stages still hold memory beside it.
_REMEMBERED = 200_000


def _with_digest(docs: DataFrame) -> DataFrame:
    return docs.withColumn(_SHA, F.sha2(F.translate(F.coalesce("text", F.lit("")), _UPPER, _LOWER), 256))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain of classifiers rejects go. It learns from the labels of ``sf_dir`` that ``docs`` still has.

    Rows of one id stand and fall together; an id that has none rejected stays, as do null ids.
    """
    ship_package(spark)
    with text_batches(spark):
        rejected = toxic.toxic_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).filter("rejected")
        gone = materialise(rejected.select("doc_id").distinct(), "rejected")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays; of rows that repeat both id and text, one."""
    ship_package(spark)
    with text_batches(spark):
        kept = exact_duplicates(docs).filter("kept").select(F.col("doc_id").alias("_kept_id"), F.col("text_sha256").alias("_kept_sha"))
    marked = _with_digest(docs)
    same = marked["doc_id"].eqNullSafe(kept["_kept_id"]) & (marked[_SHA] == kept["_kept_sha"])
    return marked.join(kept, same, "left_semi").dropDuplicates(["doc_id", _SHA]).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by links the one with the smallest id stays; documents without links and null ids stay."""
    ship_package(spark)
    gone = jaccard_components(docs).filter("component_id < doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text, and n_chars follows it; every document stays."""
    return mask_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens, a row per piece."""
    ship_package(spark)
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), remembered=_REMEMBERED)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("jaccard_join", near_dedup),
    ("secret_scan", secrets),
    ("best_fit_packing", packing),
]

#: Trained models, tokens and a packing have no SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each result is stored and read by the next."""
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = materialise(docs, name)
    return docs
