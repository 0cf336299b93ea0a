"""Ordered string aggregation of groups of any size.

The rows are sorted by (group, value) across the cluster and written with the
number of their sort partition.  Each partition's share of a group is joined
where it lies, and a group's pieces, one per partition that it reaches, are
joined in partition order.  So no task ever holds or sorts a group's rows; only
the finished text, which is one value, meets in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza import schema as S
from cadenza.functions.columns import concat_sorted
from cadenza.session import checkpoint


def string_agg(df: DataFrame, keys: list[str], value: str, out: str, distinct: bool = False, sep: str = S.CONCAT_SEPARATOR,
               partitions: int | None = None) -> DataFrame:
    """``GROUP_CONCAT([DISTINCT] value ORDER BY value SEPARATOR sep)`` per group
    of ``keys``: nulls skipped, null for a group without values.

    ``partitions`` fixes the number of sort partitions; by default adaptive
    execution chooses it by the bytes sorted.
    """
    rows = df.select(*keys, value)
    rows = rows.distinct() if distinct else rows
    order = [F.col(c).asc_nulls_first() for c in (*keys, value)]
    rows = rows.repartitionByRange(partitions, *order).sortWithinPartitions(*order) if partitions else rows.orderBy(*order)
    placed = checkpoint(rows.select(*keys, value, F.shiftright(F.monotonically_increasing_id(), 33).alias("_piece")), "text-rows")
    # a piece lies in one partition: it is whole before the shuffle
    pieces = placed.groupBy(*keys, "_piece").agg(concat_sorted(F.collect_list(value), sep).alias("_text"))
    parts = F.filter(F.array_sort(F.collect_list(F.struct("_piece", "_text"))), lambda p: p["_text"].isNotNull())
    texts = F.transform(parts, lambda p: p["_text"])
    return (pieces.groupBy(*keys).agg(texts.alias("_texts"))
            .select(*keys, F.when(F.size("_texts") > 0, F.array_join("_texts", sep)).alias(out)))
