"""A training corpus from raw documents: five stages, each a job of its own over what the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``docs``. NULL texts count as empty and stay as they
are, rows with a NULL id stay unless their own text rejects them, columns
beyond ``doc_id`` and ``text`` are carried along whatever their names, and an
empty table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.llm import exact_dedup, packing, secret_scan, shingle_join, toxicity
from ledgerline.llm.common import documents, stored

WORD_DEFINITION = "word_bpe_49k.json"
#: Neither model scores nor packing can be said in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def _extras(docs: DataFrame) -> dict[str, str]:
    return {c: f"_extra{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the classifier chain rejects."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    extras = _extras(docs)
    plain = docs.withColumnsRenamed(extras)
    kept = toxicity.score_toxicity(plain, labels).where(~F.col("rejected")).select(*plain.columns)
    return kept.withColumnsRenamed({new: old for old, new in extras.items()})


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts keep the one with the largest id."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return exact_dedup.exact_dedup(docs, carry=[row]).where("kept").select("row.*")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by shingle similarity keep the document with the smallest id.

    Documents that share an id are told apart by the hash of their text.
    """
    row = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", F.xxhash64("text").alias("text_hash")))
    groups = shingle_join.jaccard_components(docs.select(row.alias("row"), "text"), "row")
    dropped = groups.where("component_id <> row").select("row.*").alias("dropped")
    same = (F.col("docs.doc_id") == F.col("dropped.doc_id")) & (F.xxhash64("docs.text") == F.col("dropped.text_hash"))
    return docs.alias("docs").join(dropped, same, "left_anti")


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the texts; ``n_chars`` follows the text."""
    redacted = secret_scan.redact_secrets(docs)
    if "n_chars" in docs.columns:
        length = F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType)
        redacted = redacted.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(length))
    return redacted


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in training sequences."""
    return packing.pack_documents(docs, public_tokenizers.path(WORD_DEFINITION))


STAGES = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("ngram_jaccard", without_near_copies),
    ("secrets", without_secrets),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each is written and read again before the next."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
