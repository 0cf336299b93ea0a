"""Column expressions (all JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from cadenza import schema as S


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- keys and categories ----------------------------------------------------

def key_scale(key) -> Column:
    """Note name of a pitch class; null for -1, null or unknown keys."""
    notes = F.create_map(*[x for k, v in S.KEY_NAMES.items() for x in (F.lit(k), F.lit(v))])
    return F.element_at(notes, _col(key))


def key_signature(key, mode) -> Column:
    """'<note> Minor' when mode is 0, else '<note> Major'; null without a note.

    A null mode is not 0, so it reads as major; the concatenation propagates
    a missing note to a null signature.
    """
    scale = key_scale(key)
    return F.when(_col(mode) == 0, F.concat(scale, F.lit(S.MINOR_SUFFIX))) \
            .otherwise(F.concat(scale, F.lit(S.MAJOR_SUFFIX)))


def album_category(num_songs) -> Column:
    """Album type by its number of songs."""
    n = _col(num_songs)
    expr = None
    for lo, hi, name in S.ALBUM_BANDS:
        cond = (n == lo) if lo == hi else ((n >= lo) & (n <= hi))
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr.otherwise(S.ALBUM_OTHER)


# --- vectors -----------------------------------------------------------------

def l2_norm(*cols) -> Column:
    return F.sqrt(reduce(lambda a, b: a + b, [_col(c) * _col(c) for c in cols]))


def l2_normalize(cols, norm=None) -> list[Column]:
    """Unit-length components; a zero vector stays zero (no division)."""
    n = norm if norm is not None else l2_norm(*cols)
    return [F.when(n == 0, _col(c)).otherwise(_col(c) / n) for c in cols]


def dot(a_cols, b_cols) -> Column:
    return reduce(lambda x, y: x + y, [_col(a) * _col(b) for a, b in zip(a_cols, b_cols)])


# --- rounding with the reference's numeric rules ------------------------------

def half_even_int(x) -> Column:
    """Round half to even, then integer (pandas/NumPy ``round(0).astype(int)``)."""
    return F.bround(_col(x), 0).cast("int")


def exact_avg(x) -> Column:
    """Exact average of an integer-valued column as a decimal with four more
    decimals, rounded half up -- the SQL-database AVG the questions rely on."""
    return F.avg(_col(x).cast("decimal(20,0)"))


def rounded_quotient(total: Column, count: Column, n: int) -> Column:
    """total / count at ``n`` decimals, half away from zero, rounded once from
    the exact integers; DOUBLE, null for no rows."""
    total, count = total.cast("decimal(28,0)"), count.cast("decimal(19,0)")
    scaled = F.abs(total) * F.lit(2 * 10 ** n).cast("decimal(7,0)") + count
    whole = F.call_function("div", scaled, count * F.lit(2).cast("decimal(1,0)"))
    return F.when(count > 0, F.signum(total.cast("double")) * whole.cast("double") / F.lit(float(10 ** n)))


def rounded_avg(x, n: int, divisor: int = 1) -> Column:
    """ROUND(AVG(x) / divisor, n) of an integer column, rounded once."""
    x = _col(x)
    return rounded_quotient(F.sum(x.cast("decimal(18,0)")), F.count(x) * F.lit(divisor), n)


# --- string aggregation -------------------------------------------------------

def concat_sorted(values_array, sep: str = S.CONCAT_SEPARATOR) -> Column:
    """Join a sorted array; null when there is nothing to join (GROUP_CONCAT)."""
    arr = F.array_sort(values_array)
    return F.when(F.size(arr) == 0, F.lit(None).cast("string")).otherwise(F.array_join(arr, sep))


def group_concat(x, sep: str = S.CONCAT_SEPARATOR) -> Column:
    """GROUP_CONCAT(x ORDER BY x SEPARATOR sep): duplicates kept, nulls skipped."""
    return concat_sorted(F.collect_list(_col(x)), sep)


def group_concat_distinct(x, sep: str = S.CONCAT_SEPARATOR) -> Column:
    """GROUP_CONCAT(DISTINCT x ORDER BY x SEPARATOR sep)."""
    return concat_sorted(F.collect_set(_col(x)), sep)
