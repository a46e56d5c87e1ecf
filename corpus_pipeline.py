"""Corpus pipeline: toxicity filter, near-duplicate removal, secret redaction, source mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and read again as the next stage's documents.  All but the
last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantspark.llm.catalog import tokenizer_path
from quantspark.llm.common import crc_mod, shared_dir, table, tuned
from quantspark.llm.mixing import mixed_documents
from quantspark.llm.neardup import deduplicated
from quantspark.llm.packing import pack_documents
from quantspark.llm.secret_scan import redacted_documents
from quantspark.llm.toxicity import score_documents, train_toxicity

# No stage but the mix is expressible in SQL (trained scores, text rewriting, a public tokenizer).
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the noisy-or classifier does not call toxic."""
    model = train_toxicity(docs, table(spark, sf_dir, "labels"), crc_mod(F.col("doc_id"), 5) != 0)
    scored = score_documents(docs, model, keep_columns=True)
    return scored.filter(F.col("predicted") == 0).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return deduplicated(docs).select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked in the text or in the encoded run that holds them; n_chars follows."""
    tuned(spark)
    out = redacted_documents(docs)
    return out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast("bigint"))) \
        if "n_chars" in docs.columns else out


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources reach their target shares of words."""
    return mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces with their sequence and offset."""
    return pack_documents(docs, tokenizer_path())


STAGES = [("toxicity", drop_toxic), ("near_dedup", drop_near_duplicates), ("secret_scan", redact_secrets),
          ("source_mix", mix), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is a Parquet table in the cluster's shared folder."""
    docs = table(spark, sf_dir, "documents")
    base = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
