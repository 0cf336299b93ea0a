"""Cleaning: null filter, full-row dedup, time-signature repair."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza import schema as S


def filter_not_null(df: DataFrame, column: str) -> DataFrame:
    """Keep rows where ``column`` is present."""
    return df.where(F.col(column).isNotNull())


def filter_ne_nullsafe(df: DataFrame, column: str, value) -> DataFrame:
    """``df[col != value]`` with pandas semantics: a missing value is kept."""
    return df.where(~F.col(column).eqNullSafe(F.lit(value)))


def replace_values(df: DataFrame, column: str, mapping: dict) -> DataFrame:
    """Replace exact values in one column (``Series.replace``)."""
    c = F.col(column)
    expr = None
    for old, new in mapping.items():
        expr = F.when(c == old, F.lit(new)) if expr is None else expr.when(c == old, F.lit(new))
    return df.withColumn(column, expr.otherwise(c).cast(df.schema[column].dataType))


def dedup_rows(df: DataFrame, cols: list[str] | None = None, order_col: str = S.ROW_NO,
               deal_by: list[str] | None = None) -> DataFrame:
    """Full-row duplicate removal keeping the first row in file order.

    The position column is not part of row equality; the kept row carries the
    smallest position of its duplicates.  Nulls and NaNs compare equal, as in
    pandas.  By default partial aggregation runs before the shuffle, and the
    shuffle key is the whole row.  With ``deal_by``, some of ``cols``, rows that
    agree in these meet in one task and leave it side by side: they are
    compressed together, and later groupings by ``deal_by`` or more need no
    shuffle.  The rows of one such group must be no more than a task can read
    (memory is bounded by spilling).
    """
    cols = cols or [c for c in df.columns if c != order_col]
    if deal_by:
        df = df.repartition(*deal_by)
    return df.groupBy(*cols).agg(F.min(order_col).alias(order_col)).select(order_col, *cols)


def clean_tracks(raw: DataFrame) -> DataFrame:
    """Null-name filter -> dedup -> drop time signature 0 -> 1 becomes 4 (in this order)."""
    df = filter_not_null(raw, "track_name")
    df = dedup_rows(df, S.DATA_COLS, deal_by=S.DEAL_COLS)
    df = filter_ne_nullsafe(df, "time_signature", S.DROP_TIME_SIGNATURE)
    return replace_values(df, "time_signature", S.REPLACE_TIME_SIGNATURE)


def track_rows(clean: DataFrame) -> DataFrame:
    """Distinct track rows: every column but the genre (``iloc[:, :-1]`` + dedup)."""
    return clean.select(*S.TRACK_COLS).distinct()


def with_key_signature(df: DataFrame) -> DataFrame:
    from cadenza.functions.columns import key_signature
    return df.withColumn("key_signature", key_signature("key", "mode"))
