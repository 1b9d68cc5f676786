"""Registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import chat, decontaminate, media, minhash, packing, pii, quality, sharding, suffix, urls
from millrace.llm.common import table


#: Bytes in a shard: less than the operator's own limit, so that tables of any size are split.
SHARD_BYTES = 1 << 20


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest_pieces(packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path()))


def op3_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.digest_media(media.media_documents(table(spark, sf_dir, "documents")))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest_spans(pii.annotate(table(spark, sf_dir, "documents")))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), minhash.Params(words=4))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.digest_kept(suffix.repeated_strings(table(spark, sf_dir, "documents")))


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render(table(spark, sf_dir, "conversations"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge(urls.captured(table(spark, sf_dir, "pages")), urls.events(spark))
    return judged.withColumn("fetched_at", judged["fetched_at"].cast("string"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"), SHARD_BYTES)


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_packing": op2_packing,
    "op3_media_columns": op3_media_columns,
    "op4_pii": op4_pii,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_chat_formatting": op6_chat_formatting,
    "op7_minhash": op7_minhash,
    "op8_url_filter": op8_url_filter,
    "op9_sharding": op9_sharding,
    "op10_quality_classifier": op10_quality_classifier,
}
ORACLE_SQL = {
    "op1_decontamination": decontaminate.oracle(),
    "op5_suffix_dedup": suffix.oracle(),
    "op6_chat_formatting": chat.ORACLE,
    "op7_minhash": minhash.oracle(minhash.Params(words=4)),
    "op8_url_filter": urls.ORACLE,
    "op9_sharding": sharding.oracle(SHARD_BYTES),
}
