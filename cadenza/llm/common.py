"""Helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.session import checkpoint

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spare(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def id_crc(col: str) -> Column:
    """CRC-32 of an id written as text (null id: null)."""
    return F.crc32(F.col(col).cast("string").cast("binary"))


def hash_sample(df: DataFrame, bound: int, *cols: str, least_step: int = 1) -> DataFrame:
    """About ``bound`` rows at most, chosen by a hash of ``cols``, the same on every run."""
    step = max(least_step, -(-df.count() // bound))
    return df.where(F.pmod(F.xxhash64(F.lit(7), *cols), F.lit(step)) == 0)


def connected_components(edges: DataFrame) -> DataFrame:
    """``(a, b)`` links of long ids to ``(node, component)``: the smallest id
    reachable from each linked node.

    Alternating large-star and small-star rounds.  Each round groups by node
    with map-side minima and joins the minimum back, so the links of a hub
    never meet in one group, and is written to the checkpoint folder: a lost
    executor re-reads it.  Rounds grow with the logarithm of a chain's length.
    """
    edges = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges, before = checkpoint(edges.distinct(), "links"), None
    while (now := _digest(edges)) != before:
        before = now
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))))
        edges = checkpoint(small.distinct(), "links")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")),
                           F.sum(F.pmod(F.xxhash64("b", "a"), F.lit(1 << 31)))).first())


def forest(n: int, pair_blocks, start=None):
    """Labels (smallest index of the class) of ``n`` items after joining the
    index pairs of each ``(i, j)`` block."""
    import numpy as np

    label = np.arange(n) if start is None else start
    for i, j in pair_blocks:
        while True:
            low = np.minimum(label[i], label[j])
            new = label.copy()
            for side in (i, j):
                np.minimum.at(new, side, low)
                np.minimum.at(new, label[side], low)
            new = new[new]
            if (new == label).all():
                break
            label = new
    while not (label == label[label]).all():
        label = label[label]
    return label
