"""Corpus pipeline: five stages over ``documents``, each written and read again.

Every stage takes ``(spark, docs, sf_dir)``, works on all rows its predecessor
kept and returns the columns of ``documents``; the last returns the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm import decontaminate, mixing, pii, simhash_vptree, toxicity
from cadenza.llm.common import table
from cadenza.session import delete_paths, shared_dir, stage_scope

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go."""
    lexicon, weights = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity.score_column(lexicon, weights)(F.col("text")) < 0.5).select(*COLUMNS)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays: that of the smallest
    id, null ids last.  Rows that share an id are told apart by their text; of
    those that share both, one stays."""
    parts = {"_null": F.col("doc_id").isNull(), "_id": F.coalesce("doc_id", F.lit(0)),
             "_text": F.md5(F.coalesce("text", F.lit("")).cast("binary"))}
    keyed = docs.select(*COLUMNS, *[c.alias(name) for name, c in parts.items()])
    found = simhash_vptree.near_duplicates(keyed.select(F.struct(*parts).alias("_key"), "text"), id_col="_key")
    stays = found.where("_key = component_id").select("_key.*").distinct()
    # repeated rows go before the texts are dealt out; the join then finds them dealt by its own keys
    return keyed.dropDuplicates(list(parts)).join(stays, list(parts), "left_semi").select(*COLUMNS)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more of the words lie in benchmark windows go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced; ``n_chars`` follows the text."""
    return pii.pseudonymize(docs).select(
        "doc_id", "text", "lang", "source", F.length("text").cast(dict(docs.dtypes)["n_chars"]).alias("n_chars"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document that is left."""
    return mixing.mix(docs)


STAGES = [("toxicity", toxicity_stage), ("simhash_near_dedup", simhash_stage), ("benchmark_decontamination", decontaminate_stage),
          ("pii", pii_stage), ("source_mixing", mixing_stage)]

#: the first stage's score and the second's classes are not SQL; see tests/llm
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five stages in turn.  What a stage wrote for itself is deleted when
    its result is written, and that when the next one has read it."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = shared_dir(spark, f"pipeline-{name}")
        with stage_scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            delete_paths(spark, [before])
        docs, before = spark.read.parquet(path), path
    return docs
