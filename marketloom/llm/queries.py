"""The corpus operators as registered queries over whole tables, and the SQL that some are compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm import answers
from marketloom.llm.common import table
from marketloom.llm.dialog_repair import repaired_conversations
from marketloom.llm.kd_shards import document_shards
from marketloom.llm.langid import languages
from marketloom.llm.mixing import mixed
from marketloom.llm.periodic_runs import run_digests
from marketloom.llm.quality_rules import host_verdicts
from marketloom.llm.secrets import document_secrets
from marketloom.llm.sentencepiece_codec import Codec, encode_documents
from marketloom.llm.simhash import near_duplicates
from marketloom.llm.suffix_dedup import removal_digests
from marketloom.llm.topk import quantised, top_k
from marketloom.llm.training_order import load_ranks, materialised, token_records
from marketloom.llm.url_filter import crawl_list, url_verdicts


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = quantised(table(spark, sf_dir, "embeddings"))
    return top_k(vectors.where(F.col("id") % 50 == 0), vectors, k=5)


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(table(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_verdicts(pages, crawl_list(pages))


def op4_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_shards(table(spark, sf_dir, "documents"), leaves=24)


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), Codec.load())


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op7_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialised(token_records(table(spark, sf_dir, "documents"), load_ranks()))


def op8_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_verdicts(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_secrets(table(spark, sf_dir, "documents"))


def op11_dialog_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired_conversations(table(spark, sf_dir, "conversations"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_digests(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [op1_topk, op2_langid, op3_url_filter, op4_kd_shards, op5_sentencepiece, op6_simhash, op7_training_order, op8_host_rules, op9_mixing, op10_secrets, op11_dialog_repair, op12_suffix_dedup, op13_periodic_runs]
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return answers.ANSWERS
