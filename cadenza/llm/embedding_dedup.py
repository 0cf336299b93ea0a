"""Embedding near-duplicates by a subspace pigeonhole join.

Unit vectors at cosine ``c`` or more lie within squared distance ``2 - 2c``.
A seeded rotation spreads that distance evenly over the coordinates; cut into
blocks, at least one block of a close pair lies within its proportional share
of the budget.  Each block is range-joined under its share: rows of equal label
meet in cells of the block, cut by medians of a bounded hash sample, where a row
within the block's radius beyond a cut is also copied to the lower side.  In a
cell the block distances are taken for all its rows, and the pairs under the
share are verified exactly, in double precision on the whole vectors.

A pair is counted in the first block that lets it through and in the one cell
that it belongs to, so counts need no list of pairs; only a count per row and a
forest of links leave a task.  Exact copies meet beforehand and are counted by
their number.  Cells that the sample shows to be larger than ``CELL_ROWS`` and
that no cut divides are joined in pairs of row chunks, so memory stays bounded.

Defined results: a vector that is null, zero, or holds a null or non-finite
component, and a row with a null label or id, links with nothing: no links, its
own component.  Vectors of different length never link.  Rows of equal label and
vector are copies of each other, whatever their ids; an id that other labels or
vectors share names nothing but its rows, so it joins no classes.  Vectors are
scaled by powers of two before lengths are taken, so very small and very large
components neither vanish nor overflow.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import connected_components, forest
from cadenza.session import checkpoint

COSINE = 0.93
BLOCK_DIMS = 8
SAMPLE = 65_536
CELL_ROWS = 8_192
SEED = 5


def rotation(dims: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def _scaled(vectors) -> np.ndarray:
    """The vectors with largest components between a half and one: exact, for any length."""
    x = np.array([np.asarray(v, np.float64) for v in vectors])
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])


def _units(vectors) -> np.ndarray:
    x = _scaled(vectors)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _blocks(dims: int, block_dims: int) -> list[slice]:
    n = max(1, dims // block_dims)
    cuts = [round(i * dims / n) for i in range(n + 1)]
    return [slice(a, b) for a, b in zip(cuts, cuts[1:])]


def _cuts(points: np.ndarray, rows: int, radius: float):
    """A tree of cuts over a block: ``(axis, value, low, high)`` or a leaf's sample size."""
    if len(points) <= rows:
        return len(points)
    best = None
    for axis in range(points.shape[1]):
        value = np.median(points[:, axis])
        low = points[:, axis] <= value + radius
        high = points[:, axis] > value
        worst = max(low.sum(), high.sum())
        if worst <= 0.85 * len(points) and (best is None or worst < best[0]):
            best = worst, axis, float(value), low, high
    if best is None:
        return len(points)
    _, axis, value, low, high = best
    return axis, value, _cuts(points[low], rows, radius), _cuts(points[high], rows, radius)


def _deal(tree, points: np.ndarray, radius: float):
    """``(cell, sample size, indices, copied)``; ``copied`` has a bit for each
    cut at which the row is a copy on the lower side."""
    todo = [(tree, "", np.arange(len(points)), np.zeros(len(points), np.int64), 0)]
    while todo:
        node, name, idx, copied, depth = todo.pop()
        if not isinstance(node, tuple):
            yield name, node, idx, copied
            continue
        axis, value, low, high = node
        x = points[idx, axis]
        under, over = x <= value + radius, x > value
        bit = np.where(x[under] > value, np.int64(1) << min(depth, 62), 0)
        todo += [(low, name + "0", idx[under], copied[under] | bit, depth + 1),
                 (high, name + "1", idx[over], copied[over], depth + 1)]


def _square(x: np.ndarray, i: np.ndarray, j: np.ndarray, block: slice) -> np.ndarray:
    out = np.zeros(len(i))
    for c in range(block.start, block.stop):
        d = x[i, c] - x[j, c]
        out += d * d
    return out


def _search(raw: np.ndarray, k: int, cosine: float, block_dims: int, copied, side, weight):
    """Linked weight of each row and forest labels, for one cell of block ``k``."""
    norm = np.linalg.norm(raw, axis=1)
    x = (raw / norm[:, None]) @ rotation(raw.shape[1])
    blocks = _blocks(raw.shape[1], block_dims)
    budget = [(2 - 2 * cosine + 1e-9) * (b.stop - b.start) / raw.shape[1] for b in blocks]
    part = x[:, blocks[k]]
    half = (part * part).sum(axis=1) / 2
    linked, label = np.zeros(len(raw), np.int64), np.arange(len(raw))
    for lo in range(0, len(raw), 512):
        near = part[lo:lo + 512] @ part[lo:].T
        near -= half[lo:lo + 512, None]
        near -= half[None, lo:]
        i, j = np.nonzero(near >= -budget[k] / 2 - 1e-9)
        i, j = i + lo, j + lo
        keep = (i < j) & (copied[i] & copied[j] == 0)
        if side is not None:
            keep &= side[i] != side[j]
        i, j = i[keep], j[keep]
        for at in range(0, len(i), 1 << 18):
            a, b = i[at:at + (1 << 18)], j[at:at + (1 << 18)]
            ok = _square(x, a, b, blocks[k]) <= budget[k]
            for earlier in range(k):  # counted there
                ok[ok] = _square(x, a[ok], b[ok], blocks[earlier]) > budget[earlier]
            a, b = a[ok], b[ok]
            close = np.einsum("ij,ij->i", raw[a], raw[b]) >= cosine * norm[a] * norm[b]
            a, b = a[close], b[close]
            np.add.at(linked, a, weight[b])
            np.add.at(linked, b, weight[a])
            label = forest(len(raw), [(a, b)], label)
    return linked, label


def links(distinct: DataFrame, cosine: float = COSINE, block_dims: int = BLOCK_DIMS, sample_rows: int = SAMPLE,
          cell_rows: int = CELL_ROWS) -> DataFrame:
    """``(node, linked, parent)`` from distinct ``(label, v, node, copies)`` rows."""
    step = max(8, -(-distinct.count() // sample_rows))
    sample = distinct.where(F.pmod(F.xxhash64(F.lit(3), "node"), F.lit(step)) == 0).select("label", "v").toPandas()
    sample["dims"] = sample["v"].map(len)
    rows = max(16, cell_rows // step)
    trees, sizes = {}, {}
    for (label, dims), own in sample.groupby(["label", "dims"]):
        sizes[label, dims] = len(own)
        if len(own) > rows:
            x, parts = _units(own["v"]) @ rotation(dims), _blocks(dims, block_dims)
            radius = [float(np.sqrt((2 - 2 * cosine + 1e-9) * (b.stop - b.start) / dims)) + 1e-9 for b in parts]
            trees[label, dims] = [_cuts(x[:, b], rows, r) for b, r in zip(parts, radius)]
    trees = distinct.sparkSession.sparkContext.broadcast((trees, sizes))  # grows with the sample, not with the rows

    def deal(batches):
        for pdf in batches:
            pdf = pdf.reset_index(drop=True)
            for (label, dims), own in pdf.groupby([pdf["label"], pdf["v"].map(len)]):
                own = own.reset_index(drop=True)
                x = _units(own["v"]) @ rotation(dims)
                for k, b in enumerate(_blocks(dims, block_dims)):
                    radius = float(np.sqrt((2 - 2 * cosine + 1e-9) * (b.stop - b.start) / dims)) + 1e-9
                    cut, sampled = trees.value
                    # without a tree the label is one cell of its sampled size
                    tree = cut[label, dims][k] if (label, dims) in cut else sampled.get((label, dims), 1)
                    for cell, size, idx, copied in _deal(tree, x[:, b], radius):
                        p = max(1, -(-size * step // (2 * cell_rows)))
                        part = own["node"].to_numpy()[idx] % p
                        for other in range(p):
                            if len(idx):
                                yield own.loc[idx, ["label", "v", "node", "copies"]].assign(
                                    dims=dims, block=k, cell=cell, copied=copied, part=part,
                                    lo=np.minimum(part, other), hi=np.maximum(part, other))

    def search(key, pdf):
        lo, hi = key[4], key[5]
        raw = _scaled(pdf["v"])
        node = pdf["node"].to_numpy()
        linked, label = _search(raw, int(key[2]), cosine, block_dims, pdf["copied"].to_numpy(),
                                pdf["part"].to_numpy() if lo != hi else None, pdf["copies"].to_numpy())
        hit = linked > 0
        return pd.DataFrame({"node": node[hit], "linked": linked[hit], "parent": node[label[hit]]})

    kind = dict(distinct.dtypes)
    dealt = distinct.select("label", "v", "node", "copies").mapInPandas(
        deal, f"label {kind['label']}, v {kind['v']}, node long, copies long, dims int, block int, cell string, "
              "copied long, part long, lo long, hi long")
    return dealt.groupBy("label", "dims", "block", "cell", "lo", "hi").applyInPandas(
        search, "node long, linked long, parent long")


def near_duplicates(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    cosine: float = COSINE, block_dims: int = BLOCK_DIMS, sample_rows: int = SAMPLE,
                    cell_rows: int = CELL_ROWS) -> DataFrame:
    """Per row: ``id_col, n_links, component_id, kept``."""
    v = F.col("v")
    number = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    fine = (F.col("id").isNotNull() & F.col("label").isNotNull() & v.isNotNull()
            & ~F.exists(v, number) & F.exists(v, lambda x: x != 0))
    own = rows.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v"))
    own = own.withColumn("key", F.when(F.coalesce(fine, F.lit(False)), F.md5(F.array_join(v.cast("array<string>"), ",").cast("binary"))))
    copies = own.where("key IS NOT NULL").groupBy("label", "key").agg(
        F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("v").alias("v"))
    # the numbers are written with the classes, so nothing renumbers them
    copies = checkpoint(copies.withColumn("node", F.monotonically_increasing_id()), "vectors")
    found = checkpoint(links(copies.drop("least"), cosine, block_dims, sample_rows, cell_rows), "vector-links")
    comp = connected_components(found.select(F.col("node").alias("a"), F.col("parent").alias("b")))
    linked = found.groupBy("node").agg(F.sum("linked").alias("linked"))
    classes = (copies.select("label", "key", "node", "copies", "least").join(linked, "node", "left").join(comp, "node", "left")
               .select("label", "key", "least", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                       F.coalesce("component", "node").alias("class")))
    least = classes.groupBy("class").agg(F.min("least").alias("component_id"))
    named = classes.join(least, "class").select(F.col("label").alias("l"), F.col("key").alias("k"), "n_links", "component_id")
    return (own.select("id", "label", "key")
            .join(named, (F.col("label") == F.col("l")) & (F.col("key") == F.col("k")), "left")
            .select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False))))
