"""The registered queries of this subpackage, one per operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm import (conversation_trie, decontaminate, embedding_dedup, filter_audit, fingerprints, langid, licenses, mixing,
                         pii, secrets, simhash_vptree, toxicity, warc)
from cadenza.llm.common import table
from cadenza.llm.sql import CONVERSATION_TRIE, FILTER_AUDIT, MIXING
from cadenza.session import shared_dir

QueryFn = Callable[[SparkSession, str], DataFrame]


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_vptree.near_duplicates(table(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "warc")
    pages = table(spark, sf_dir, "pages")
    warc.write_warc(pages, folder)
    kind = dict(pages.dtypes)["page_id"]
    return warc.read_warc(spark, folder).select(
        F.col("record_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.digest(secrets.scan(docs, secrets.fit(docs)))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.predict(docs, *toxicity.train(docs, table(spark, sf_dir, "labels")))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.digest(fingerprints.compare_edits(table(spark, sf_dir, "documents")))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def queries() -> dict[str, QueryFn]:
    return {f.__name__: f for f in (op1_simhash, op2_warc, op3_decontaminate, op4_secrets, op5_toxicity, op6_mixing, op7_pii,
                                    op8_licenses, op9_langid, op10_embedding_dedup, op11_fingerprints, op12_filter_audit,
                                    op13_conversation_trie)}


def oracle_sql() -> dict[str, str]:
    return {"op6_mixing": MIXING, "op12_filter_audit": FILTER_AUDIT, "op13_conversation_trie": CONVERSATION_TRIE}
