"""Corpus pipeline: quality, near-duplicates, decontamination, personal data, packing.

Each stage is written as Parquet and read again as the next one's documents; all but the
last return the columns of ``documents``. The filtering stages decide about each row by its own text, so
rows without a doc_id and different texts under one doc_id are judged like all others. A null or empty text has no
near-duplicates and no benchmark passage; what its quality score is, the classifier decides. An empty
table gives empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontaminate, minhash, packing, pii, quality
from millrace.llm.common import materialize, table
from millrace.llm.queries import tokenizer_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text the classifier accepts."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: one with the least doc_id. Rows without a doc_id come after all others."""
    names = docs.columns
    rows = materialize(docs.select(F.struct(*names).alias("row")).withColumn("key", F.monotonically_increasing_id()), "rows", "zstd")
    told = minhash.near_duplicates(rows.select(F.col("key").alias("doc_id"), F.col("row.text").alias("text"))).select(F.col("doc_id").alias("key"), F.col("component_id").alias("group"))
    order = F.struct(F.col("row.doc_id").isNull().alias("last"), F.col("row.doc_id").alias("doc_id"), "key")
    kept = rows.select("key", order.alias("x")).join(told, "key").groupBy("group").agg(F.min("x").alias("x"))
    return rows.join(kept.select(F.col("x.key").alias("key")), "key", "left_semi").select("row.*")


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text holds no benchmark passage."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def remove_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with personal data replaced; n_chars follows the new text."""
    safe = pii.sanitize(docs)
    return safe.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packing.digest_pieces(packing.pack_documents(docs, tokenizer_path()))


STAGES = [
    ("quality classifier", keep_quality),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark),
    ("PII", remove_personal_data),
    ("packing", pack),
]

#: The stages learn, hash and tokenise; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"stage{k}")
    return docs
