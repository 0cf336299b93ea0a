"""SimHash near-duplicates through a vantage-point tree.

A document's 64-bit fingerprint takes a bit where over half of its shingle
hashes have it.  Distinct fingerprints are dealt to the leaves of a
vantage-point tree: at each node those within ``mu`` bits of the vantage point
go inside, the others outside, and of the others those within ``mu + r`` bits
also go inside (triangle bound: a pair at distance ``r`` or less that the
sphere parts meets inside).  Every leaf then holds, for every close pair that
belongs to it, both members; it searches them with the same kind of tree and
exact bit counts.

Only a forest of each leaf leaves its task, never all pairs of a group; the
forests are joined by connected components over fingerprints.  The tree is
fitted on a bounded hash sample (``SAMPLE``) of the fingerprints; every
fingerprint is dealt.  A leaf that the sample shows to be larger than
``LEAF_ROWS`` and that no sphere divides is searched in pairs of row chunks, so
a task's memory stays bounded whatever lies in one place.

Defined results: a null or blank text has fingerprint 0, linked like any other;
a null id takes part in links, and its component is the smallest non-null id
reachable, null if there is none; repeated ids and rows each give a row.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import connected_components, forest
from cadenza.session import checkpoint

SAMPLE = 65_536
LEAF_ROWS = 16_384
SEED = 42


def simhash(text: bytes | None, width: int = 3) -> int:
    """Fingerprint of one text in UTF-8, as a signed 64-bit integer."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    width = min(width, len(words))
    line = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    ones, total = np.zeros(64, np.int64), len(words) - width + 1
    for lo in range(0, total, 65_536):
        hi = min(lo + 65_536, total)
        h = np.fromiter((xxhash.xxh64_intdigest(line[s:e - 1], SEED)
                         for s, e in zip(starts[lo:hi], ends[lo + width - 1:hi + width - 1])), ">u8", hi - lo)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > total)
    return int(bits.view(">i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    @F.pandas_udf("long")
    def udf(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(t, width) for t in texts], dtype="int64")

    return docs.select(F.col(id_col).alias("id"), udf(F.col(text_col).cast("binary")).alias("fp"))


# --- the tree ---------------------------------------------------------------------

def _split(fps: np.ndarray, radius: int, rng) -> tuple | None:
    """The vantage point and radius that copy least and divide best, or None."""
    best = None
    for point in fps[rng.integers(0, len(fps), 6)]:
        d = np.bitwise_count(fps ^ point)
        at = np.cumsum(np.bincount(d, minlength=65 + radius))
        for mu in range(int(d.min()), int(d.max())):
            inside, outside = int(at[min(mu + radius, 64)]), len(fps) - int(at[mu])
            cost = (inside ** 1.6 + outside ** 1.6) / len(fps) ** 1.6
            if max(inside, outside) <= 0.8 * len(fps) and (best is None or cost < best[0]):
                best = cost, point, mu
    return best and best[1:]


def build_tree(sample: np.ndarray, leaf: int, radius: int) -> tuple[list, list[int]]:
    """Nodes ``(point, mu, inside, outside)`` and the sample's size at each
    leaf; a child below zero is the leaf ``-child - 1``."""
    rng = np.random.default_rng(SEED)
    nodes, leaves = [], []

    def grow(fps: np.ndarray) -> int:
        found = _split(fps, radius, rng) if len(fps) > leaf else None
        if found is None:
            leaves.append(len(fps))
            return -len(leaves)
        at = len(nodes)
        nodes.append(None)
        d = np.bitwise_count(fps ^ found[0])
        nodes[at] = (*found, grow(fps[d <= found[1] + radius]), grow(fps[d > found[1]]))
        return at

    root = grow(sample)
    assert root in (0, -1)
    return nodes, leaves


def route(nodes: list, fps: np.ndarray, radius: int):
    """``(leaf, indices)`` of the leaves that the fingerprints reach."""
    todo = [(0 if nodes else -1, np.arange(len(fps)))]
    while todo:
        at, idx = todo.pop()
        if at < 0:
            if len(idx):
                yield -at - 1, idx
            continue
        point, mu, inside, outside = nodes[at]
        d = np.bitwise_count(fps[idx] ^ point)
        todo += [(inside, idx[d <= mu + radius]), (outside, idx[d > mu])]


def close_pairs(fps: np.ndarray, radius: int, side: np.ndarray | None = None):
    """Blocks of index pairs at ``radius`` bits or fewer, by a local tree;
    with ``side`` only pairs of different sides.  A pair may come twice."""
    rng, todo = np.random.default_rng(SEED), [np.arange(len(fps))]
    while todo:
        idx = todo.pop()
        own = fps[idx]
        found = _split(own, radius, rng) if len(idx) > 512 else None
        if found:
            d = np.bitwise_count(own ^ found[0])
            todo += [idx[d <= found[1] + radius], idx[d > found[1]]]
            continue
        for lo in range(0, len(idx), 1024):
            near = np.bitwise_count(own[lo:lo + 1024, None] ^ own[None, lo:]) <= radius
            i, j = np.nonzero(near)
            i, j = idx[i + lo], idx[j + lo]
            keep = i != j if side is None else side[i] != side[j]
            yield i[keep], j[keep]


def links(distinct: DataFrame, radius: int, sample_rows: int = SAMPLE, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """``(a, b)`` links of distinct fingerprints ``fp`` that join each class of
    close ones: a forest of each leaf, not all pairs."""
    step = max(8, -(-distinct.count() // sample_rows))
    sample = distinct.where(F.pmod(F.xxhash64(F.lit(7), "fp"), F.lit(step)) == 0).toPandas()["fp"].to_numpy("int64")
    sample = np.sort(sample)
    nodes, sizes = build_tree(sample.view(np.uint64), max(16, leaf_rows // step), radius)
    chunks = [max(1, -(-s * step // (2 * leaf_rows))) for s in sizes]

    def deal(batches):
        for pdf in batches:
            fps = pdf["fp"].to_numpy("int64")
            for leaf, idx in route(nodes, fps.view(np.uint64), radius):
                own, p = fps[idx], chunks[leaf]
                part = (own.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % p
                for other in range(p):
                    yield pd.DataFrame({"leaf": leaf, "lo": np.minimum(part, other), "hi": np.maximum(part, other),
                                        "part": part, "fp": own})

    def search(key, pdf):
        pdf = pdf.drop_duplicates("fp")
        fps = pdf["fp"].to_numpy("int64")
        side = pdf["part"].to_numpy() if key[1] != key[2] else None
        label = forest(len(fps), close_pairs(fps.view(np.uint64), radius, side))
        odd = np.flatnonzero(label != np.arange(len(fps)))
        return pd.DataFrame({"a": fps[odd], "b": fps[label[odd]]})

    return (distinct.select("fp").mapInPandas(deal, "leaf int, lo long, hi long, part long, fp long")
            .groupBy("leaf", "lo", "hi").applyInPandas(search, "a long, b long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                    radius: int = 2, sample_rows: int = SAMPLE, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """``(id_col, fingerprint, component_id)`` for every row; other columns
    are not carried.  Exact copies meet by their fingerprint before the tree."""
    rows = checkpoint(fingerprints(docs, id_col, text_col, width), "simhash")
    distinct = checkpoint(rows.groupBy("fp").agg(F.min("id").alias("least")), "simhash-distinct")
    comp = connected_components(links(distinct, radius, sample_rows, leaf_rows))
    classes = (distinct.join(comp.withColumnRenamed("node", "fp"), "fp", "left")
               .select("fp", "least", F.coalesce("component", "fp").alias("class")))
    least = classes.groupBy("class").agg(F.min("least").alias("component_id"))
    named = classes.join(least, "class").select("fp", "component_id")
    return (rows.join(named, "fp")
            .select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    "component_id"))
