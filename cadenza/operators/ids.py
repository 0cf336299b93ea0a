"""Dense, sorted surrogate ids and dense ranks without a one-partition window
over the rows.

``dense_ids`` numbers the distinct values of some columns 1..n in sort order
(the pandas ``astype('category').cat.codes + 1`` rule); a null value gets 0.
Only the distinct keys are ever ranked: they are written once to the shared
checkpoint folder, range-partitioned and sorted across the cluster, numbered
inside each partition, written with those numbers (so recomputation after
executor loss cannot renumber them), and shifted by the running count of the
partitions before it.  Only one row per partition ever meets in a single place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.session import checkpoint

_LOW_BITS = (1 << 33) - 1  # monotonically_increasing_id: partition << 33 | row


def _sort_exprs(cols: list[str], ascending) -> list[Column]:
    if isinstance(ascending, bool):
        ascending = [ascending] * len(cols)
    # ascending puts nulls first, descending puts them last (the SQL default)
    return [F.col(c).asc_nulls_first() if a else F.col(c).desc_nulls_last()
            for c, a in zip(cols, ascending)]


def dense_ids(df: DataFrame, cols, id_col: str, ascending=True, null_id: int | None = 0) -> DataFrame:
    """Distinct ``cols`` with a dense id in sort order.

    With ``null_id`` set, rows whose key is entirely null get that id instead
    of a position (surrogate-key rule); with ``null_id=None`` nulls are ranked
    like any value (dense-rank rule).
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    distinct = checkpoint(df.select(*cols).distinct(), "keys")
    all_null = None
    if null_id is not None:
        is_null = F.lit(True)
        for c in cols:
            is_null = is_null & F.col(c).isNull()
        all_null = distinct.where(is_null).select(F.lit(null_id).cast("long").alias(id_col), *cols)
        distinct = distinct.where(~is_null)
    mid = F.monotonically_increasing_id()
    # partition number and row number inside it are stored with the keys,
    # so the numbering is fixed once written, whatever re-reads it later
    pos = checkpoint(distinct.orderBy(*_sort_exprs(cols, ascending)).select(
        *cols, F.shiftright(mid, 33).alias("_part"), mid.bitwiseAND(F.lit(_LOW_BITS)).alias("_row")), "ids")
    sizes = pos.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: the running total needs no shuffle of the data
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    numbered = (pos.join(F.broadcast(offsets), "_part")
                .select((F.col("_off") + F.col("_row") + 1).alias(id_col), *cols))
    return numbered if all_null is None else numbered.unionByName(all_null)


def dense_rank_all(df: DataFrame, cols, rank_col: str, ascending=False) -> DataFrame:
    """``DENSE_RANK() OVER (ORDER BY cols)`` for every row, computed on the
    distinct keys and joined back (null-safe) -- no single-partition window
    over the rows.  Adaptive execution broadcasts the ranks where they are few."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    return _join_back(df, dense_ids(df, cols, rank_col, ascending=ascending, null_id=None), cols, rank_col, broadcast=False)


def top_k_dense(df: DataFrame, cols, k: int, rank_col: str, ascending=False) -> DataFrame:
    """Rows whose ``DENSE_RANK() OVER (ORDER BY cols)`` is at most ``k``.

    The k best distinct keys come from a distributed top-k (each task keeps
    k), so the broadcast side has at most k rows: a proven bound.
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    order = _sort_exprs(cols, ascending)
    best = df.select(*cols).distinct().orderBy(*order).limit(k)
    ranked = best.select(*cols, F.dense_rank().over(Window.orderBy(*order)).cast("long").alias(rank_col))
    return _join_back(df, ranked, cols, rank_col, broadcast=True)


def _join_back(df: DataFrame, keyed: DataFrame, cols: list[str], value_col: str,
               broadcast: bool) -> DataFrame:
    """Attach ``value_col`` from ``keyed`` to ``df`` by null-safe equality on ``cols``."""
    renamed = keyed.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(cols)], value_col)
    if broadcast:
        renamed = F.broadcast(renamed)
    cond = None
    for i, c in enumerate(cols):
        e = F.col(c).eqNullSafe(F.col(f"_k{i}"))
        cond = e if cond is None else cond & e
    return df.join(renamed, cond, "inner").drop(*[f"_k{i}" for i in range(len(cols))])
