"""Profiling: shape, types, null counts, frequencies, distinct values, head,
summary statistics.  Each is one distributed aggregate; nothing is pulled
to the driver except where the result itself is a handful of numbers."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.session import checkpoint


def shape(df: DataFrame, exclude=("row_no",)) -> DataFrame:
    """One row: number of rows and of data columns (the index is not a column)."""
    n_cols = len([c for c in df.columns if c not in exclude])
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", F.lit(n_cols).cast("long").alias("n_cols"))


#: types by the text of the values, narrowest first
_TEXT_TYPES = {"bigint": r"^[+-]?[0-9]+$", "double": r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$",
               "boolean": r"^([Tt]rue|[Ff]alse)$"}


def dtypes(df: DataFrame, exclude=("row_no",)) -> DataFrame:
    """(column_name, data_type, inferred_type, n_values) of every column: the
    declared type, and the narrowest one that the text of all values fits
    (``string`` if none, ``void`` without values), found in one pass."""
    kept = [(c, k) for c, k in df.dtypes if c not in exclude]
    parts = []
    for i, (c, _) in enumerate(kept):
        text = F.col(c).cast("string")
        parts += [F.count(c).alias(f"n{i}"), *[F.count_if(text.rlike(p)).alias(f"{name}{i}") for name, p in _TEXT_TYPES.items()]]
    wide, rows = df.agg(*parts), []
    for i, (c, kind) in enumerate(kept):
        n, found = F.col(f"n{i}"), F.lit("string")
        for name in reversed(_TEXT_TYPES):
            found = F.when(F.col(f"{name}{i}") == n, name).otherwise(found)
        rows.append(F.struct(F.lit(c).alias("column_name"), F.lit(kind).alias("data_type"),
                             F.when(n == 0, "void").otherwise(found).alias("inferred_type"), n.alias("n_values")))
    return wide.select(F.inline(F.array(*rows)))


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Long form (column_name, null_count): one pass, then unpivot."""
    columns = columns or [c for c in df.columns if c != "row_no"]
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return wide.unpivot([], columns, "column_name", "null_count")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(value, count) for non-null values, most frequent first."""
    return (df.where(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), F.col(column)))


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def head(df: DataFrame, n: int = 10, order=("row_no", "track_genre", "track_id")) -> DataFrame:
    """First n rows in file order (a distributed top-n, not a full sort).

    Position, then genre, then track id: a total order on the cleaned rows,
    so the n rows are the same on every run.
    """
    return df.orderBy(*order).limit(n)


def value_frequencies(df: DataFrame, column: str) -> DataFrame:
    """(value, n) for non-null values: the distributed pre-aggregation that
    the exact quantiles below run on."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def frequency_table(df: DataFrame, column: str) -> DataFrame:
    """``(v, n)``: the distinct values of a numeric column as doubles with
    their numbers, written once, since every statistic reads it several times.
    Null and NaN are missing values."""
    value = F.col(column).cast("double")
    kept = df.where(value.isNotNull() & ~F.isnan(value))
    return checkpoint(value_frequencies(kept, column).select(value.alias("v"), "n"), "frequencies")


#: slots into which one counting pass divides a range of values
SLOTS = 1_024


def select_ranks(freq: DataFrame, ranks: list[int]) -> dict[int, float]:
    """The values at 0-based ``ranks`` of a frequency table, in order.

    A counting pass divides the range that holds a rank into ``SLOTS`` equal
    slots and keeps the slot where the running count meets the rank, narrowed to
    the smallest and largest value found there, until these are one value.
    Smallest and largest never share a slot, so every pass gets nearer; each
    brings at most ``SLOTS`` + 2 rows for each rank to the driver, whatever the
    number of values.  No value is sorted and nothing is written.
    """
    infinite = float("inf")
    v, n = F.col("v"), F.col("n")
    ends = freq.where((v > -infinite) & (v < infinite)).agg(F.min(v).alias("lo"), F.max(v).alias("hi")).first()
    lo, hi = (0.0, 0.0) if ends["lo"] is None else (ends["lo"], ends["hi"])
    # range: members from, to; slots between; rows before; ranks wanted
    todo, found = [(-infinite, infinite, lo, hi, 0, sorted(set(ranks)))], {}
    while todo:
        at = slot = None
        for j, (first, last, lo, hi, _, _) in enumerate(todo):
            inside = (v >= F.lit(first)) & (v <= F.lit(last))
            # halves where the difference would overflow, else tiny ones would vanish
            half = 2.0 if hi - lo == infinite else 1.0
            share = (v / half - F.lit(lo / half)) / F.lit((hi / half - lo / half) or 1.0)
            own = (F.when(v == -infinite, -1).when(v == infinite, SLOTS)
                   .otherwise(F.least(F.lit(SLOTS - 1), F.floor(share * SLOTS))).cast("int"))
            at = F.when(inside, j) if at is None else at.when(inside, j)
            slot = F.when(inside, own) if slot is None else slot.when(inside, own)
        counts = (freq.select("v", "n", at.alias("at"), slot.alias("slot")).where("at IS NOT NULL").groupBy("at", "slot")
                  .agg(F.sum(n).alias("n"), F.min(v).alias("first"), F.max(v).alias("last")).collect())
        narrower = []
        for j, (*_, before, wanted) in enumerate(todo):
            for row in sorted((r for r in counts if r["at"] == j), key=lambda r: r["slot"]):
                own = [k for k in wanted if before <= k < before + row["n"]]
                if own and row["first"] == row["last"]:
                    found |= {k: row["first"] for k in own}
                elif own:
                    narrower.append((row["first"], row["last"], row["first"], row["last"], before, own))
                before += row["n"]
        todo = narrower
    return found


def quantile_values(freq: DataFrame, total: int | None, probs: dict[str, float]) -> dict[str, float | None]:
    """Exact quantiles of a frequency table of ``total`` rows, with linear
    interpolation between ranks (the NumPy/pandas default)."""
    if not total:
        return dict.fromkeys(probs)
    places = {name: float(p) * (total - 1) for name, p in probs.items()}
    values = select_ranks(freq, [k for x in places.values() for k in (math.floor(x), math.ceil(x))])

    def between(x):
        lower, higher = math.floor(x), math.ceil(x)
        low, high = values[lower], values[higher]
        return low if low == high else (higher - x) * low + (x - lower) * high
    return {name: between(x) for name, x in places.items()}


def exact_quantiles(df: DataFrame, column: str, probs: dict[str, float]) -> DataFrame:
    """Exact quantiles of one column, one row with one column per entry of ``probs``."""
    freq = frequency_table(df, column)
    values = quantile_values(freq, freq.agg(F.sum("n")).first()[0], probs)
    return df.sparkSession.range(1).select(*[F.lit(x).cast("double").alias(name) for name, x in values.items()])


def describe(df: DataFrame, column: str) -> DataFrame:
    """``describe()`` of one numeric column: count, mean, sample std, min,
    exact quartiles, max, from the written frequency table (exact sums for
    integer values)."""
    freq = frequency_table(df, column)
    v, n = F.col("v"), F.col("n").cast("double")
    total, mean = freq.agg(F.sum("n"), F.sum(v * n) / F.sum(n)).first()
    quartiles = quantile_values(freq, total, {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    # squares of deviations from the mean: sums of squares would cancel
    off, count = v - F.lit(mean).cast("double"), F.sum(n)
    moments = freq.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("count"), (F.sum(v * n) / count).alias("mean"),
        F.when(count > 1, F.sqrt(F.sum(off * off * n) / (count - 1))).alias("std"),
        F.min(v).alias("min"), F.max(v).alias("max"))
    return moments.select("count", "mean", "std", "min", *[F.lit(x).cast("double").alias(name) for name, x in quartiles.items()], "max")
