"""Distribution statistics behind the notebook's charts: correlation matrix,
30-bin histogram, Gaussian kernel density, box-plot numbers.

The whole-column numbers each chart needs (min, max, count) are scalar
subqueries: Spark computes each once and feeds it to the per-row expressions.
Quartiles are selected by counting passes (:mod:`cadenza.operators.profile`).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.operators.profile import frequency_table, quantile_values


def correlation_matrix(df: DataFrame, features: list[str]) -> DataFrame:
    """Pearson correlation of every pair, long form (feature_x, feature_y, r).

    Pairs with a null are skipped per pair (pairwise complete observations);
    NaN counts as missing.  A first pass takes means and numbers of values; a
    second one sums products of the centred columns: one sum per column and one
    per pair, and only for pairs with a column that has missing values the sums
    over the rows where both are there.  The one-row result is turned into rows
    by ``stack``; the diagonal is exactly 1.
    """
    # as texts: hundreds of Column objects would cost more than the two passes
    cols = {c: f"`{c.replace('`', '``')}`" for c in features}
    names = {c: "'" + c.replace("\\", "\\\\").replace("'", "\\'") + "'" for c in features}
    clean = df.selectExpr(*[f"CASE WHEN NOT isnan({x}) THEN double({x}) END AS {x}" for x in cols.values()])
    first = clean.selectExpr("count(1)", *[f"avg({x})" for x in cols.values()], *[f"count({x})" for x in cols.values()]).first()
    rows, means, counts = first[0], first[1:1 + len(features)], first[1 + len(features):]
    whole = {c for c, n in zip(features, counts) if n == rows}
    shift = ["NULL" if m is None else f"double('{m!r}')" for m in means]
    centred = clean.selectExpr(*[f"{x} - {m} AS {x}" for x, m in zip(cols.values(), shift)])
    pairs = [(a, b) for i, a in enumerate(features) for b in features[i + 1:]]
    sums = {f"s{i}": f"sum({x} * {x})" for i, x in enumerate(cols.values())}
    made = []
    for i, (a, b) in enumerate(pairs):
        x, y = cols[a], cols[b]
        sums[f"p{i}"] = f"sum({x} * {y})"
        if {a, b} <= whole:
            top, spread = f"p{i}", f"sqrt(s{features.index(a)}) * sqrt(s{features.index(b)})"
        else:
            both = f"{x} IS NOT NULL AND {y} IS NOT NULL"
            sums |= {f"{k}{i}": f"sum(CASE WHEN {both} THEN {v} END)" for k, v in
                     (("n", "1.0D"), ("x", x), ("y", y), ("xx", f"{x} * {x}"), ("yy", f"{y} * {y}"))}
            top = f"p{i} - x{i} * y{i} / n{i}"
            spread = f"sqrt(xx{i} - x{i} * x{i} / n{i}) * sqrt(yy{i} - y{i} * y{i} / n{i})"
        made.append(f"CASE WHEN {spread} > 0 THEN ({top}) / ({spread}) END AS c{i}")
    wide = centred.selectExpr(*[f"{x} AS {name}" for name, x in sums.items()]).selectExpr(*made or ["1 AS one"])
    cells = [f"{names[a]}, {names[b]}, c{i}, {names[b]}, {names[a]}, c{i}" for i, (a, b) in enumerate(pairs)]
    cells += [f"{n}, {n}, 1.0D" for n in names.values()]
    return wide.selectExpr(f"stack({2 * len(pairs) + len(features)}, {', '.join(cells)}) AS (feature_x, feature_y, r)")


def _edge(i, lo, step, hi, n_bins):
    """Bin edge i as NumPy's linspace computes it; the last edge is exact."""
    return F.when(i == n_bins, hi).otherwise(i.cast("double") * step + lo)


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width histogram between min and max, NumPy semantics: bin i holds
    edge_i <= x < edge_{i+1}, the last bin is closed; all bins are listed."""
    vals = df.where(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("x"))
    rng = vals.select(F.struct(F.min("x").alias("mn"), F.max("x").alias("mx"))).scalar()
    mn, mx = rng["mn"], rng["mx"]
    lo = F.when(mn == mx, mn - 0.5).otherwise(mn)
    hi = F.when(mn == mx, mx + 0.5).otherwise(mx)
    # one projection per step keeps the expression tree linear
    staged = vals.select("x", lo.alias("lo"), hi.alias("hi"))
    staged = staged.select("x", "lo", "hi", ((F.col("hi") - F.col("lo")) / F.lit(float(bins))).alias("step"),
                           (F.lit(float(bins)) / (F.col("hi") - F.col("lo"))).alias("norm"))
    lo_c, hi_c, step_c = F.col("lo"), F.col("hi"), F.col("step")
    b = F.col("b")
    staged = staged.withColumn("b", F.least(((F.col("x") - lo_c) * F.col("norm")).cast("long"), F.lit(bins - 1)))
    staged = staged.withColumn("b", F.when(F.col("x") < _edge(b, lo_c, step_c, hi_c, bins), b - 1).otherwise(b))
    staged = staged.withColumn("b", F.when((F.col("x") >= _edge(b + 1, lo_c, step_c, hi_c, bins)) & (b != bins - 1),
                                           b + 1).otherwise(b))
    counts = staged.groupBy("b").agg(F.count(F.lit(1)).alias("count"))
    grid = (vals.agg(F.min("x").alias("_m"))
            .select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bins - 1).cast("long"))).alias("bin"),
                    lo.alias("lo"), hi.alias("hi")))
    grid = grid.withColumn("step", (F.col("hi") - F.col("lo")) / F.lit(float(bins)))
    i = F.col("bin")
    return (grid.join(counts, grid["bin"] == counts["b"], "left")
            .select("bin", _edge(i, lo_c, step_c, hi_c, bins).alias("bin_start"),
                    _edge(i + 1, lo_c, step_c, hi_c, bins).alias("bin_end"),
                    F.coalesce(F.col("count"), F.lit(0)).alias("count")))


#: beyond so many bandwidths a kernel is below 1e-16 of its peak
_REACH = math.sqrt(2 * math.log(1e16))


def kde(df: DataFrame, column: str, gridsize: int = 200) -> DataFrame:
    """Gaussian kernel density on ``gridsize`` points from min to max.

    Bandwidth is Scott's rule, h = sd(x) * n^(-1/5) (sample sd), the
    density at g is sum_i exp(-((g - x_i)/h)^2 / 2) / (n h sqrt(2 pi)).
    Values are first reduced to (value, frequency) pairs, written once; each
    goes to the grid points where its kernel is above 1e-16 of its peak.
    """
    freq = frequency_table(df, column)
    v = F.col("v")
    st = freq.select(F.struct(F.sum("n").cast("double").alias("n"), F.min(v).alias("mn"), F.max(v).alias("mx"),
                              F.sum(v * F.col("n")).alias("s1"))).scalar()
    n_tot, mn, mx = st["n"], st["mn"], st["mx"]
    off = v - st["s1"] / n_tot
    sd = F.sqrt(freq.select(F.sum(off * off * F.col("n"))).scalar() / (n_tot - 1))
    step = (mx - mn) / F.lit(float(gridsize - 1))
    gi = F.col("gi")
    gx = F.when(gi == gridsize - 1, mx).otherwise(gi.cast("double") * step + mn)
    # a constant column has no bandwidth: no density (NULL), not a division by zero
    wide = freq.select("v", "n", (sd * F.pow(n_tot, F.lit(-0.2))).alias("h"), mn.alias("mn"), step.alias("step")).where("h > 0")
    reach = F.col("h") * F.lit(_REACH)
    first = F.greatest(F.lit(0), F.ceil((v - reach - F.col("mn")) / F.col("step"))).cast("int")
    last = F.least(F.lit(gridsize - 1), F.floor((v + reach - F.col("mn")) / F.col("step"))).cast("int")
    # a value lies within half a step of a grid point, but its kernel may be narrower
    near = wide.select("v", "n", "h", first.alias("first"), last.alias("last")).where("first <= last")
    summed = (near.select("v", "n", "h", F.explode(F.sequence("first", "last")).alias("gi"))
              .select("gi", (F.col("n") * F.exp(-0.5 * F.pow((gx - v) / F.col("h"), 2))).alias("k"))
              .groupBy("gi").agg(F.sum("k").alias("_k")).withColumnRenamed("gi", "at"))
    grid = freq.agg(F.count(F.lit(1)).alias("values")).where("values > 0").select(
        F.explode(F.sequence(F.lit(0), F.lit(gridsize - 1))).alias("gi"), (sd * F.pow(n_tot, F.lit(-0.2))).alias("h"))
    density = F.when(F.col("h") > 0, F.coalesce("_k", F.lit(0.0)) / (n_tot * F.col("h") * F.lit(math.sqrt(2 * math.pi))))
    return (grid.join(summed, gi == F.col("at"), "left")
            .select(gi.cast("long").alias("grid_index"), gx.alias("x"), density.alias("density")))


def boxplot_stats(df: DataFrame, column: str, whis: float = 1.5) -> DataFrame:
    """Box-plot numbers: quartiles, IQR, whiskers at the most extreme values
    within ``whis`` x IQR of the box, number of outliers, mean.

    The quartiles are selected from the written frequency table, then one
    aggregate over it does the rest.  A value below the low whisker is exactly
    a value below the low fence, so the outliers are counted in the same pass.
    """
    freq = frequency_table(df, column)
    v, n = F.col("v"), F.col("n")
    quartiles = quantile_values(freq, freq.agg(F.sum("n")).first()[0], {"q1": 0.25, "median": 0.5, "q3": 0.75})
    q1, med, q3 = (F.lit(quartiles[x]).cast("double") for x in ("q1", "median", "q3"))
    iqr = q3 - q1
    lo_fence, hi_fence = q1 - F.lit(whis) * iqr, q3 + F.lit(whis) * iqr
    stats = freq.agg(
        (F.sum(v * n) / F.sum(n)).alias("mean"),
        F.coalesce(F.min(F.when(v >= lo_fence, v)), q1).alias("whisker_low"),
        F.coalesce(F.max(F.when(v <= hi_fence, v)), q3).alias("whisker_high"),
        F.coalesce(F.sum(F.when((v < lo_fence) | (v > hi_fence), n)), F.lit(0)).cast("long").alias("n_outliers"))
    return stats.select("mean", q1.alias("q1"), med.alias("median"), q3.alias("q3"), iqr.alias("iqr"),
                        "whisker_low", "whisker_high", "n_outliers")


def boxplot_outliers(df: DataFrame, column: str, whis: float = 1.5, keep=("track_id",)) -> DataFrame:
    """The rows drawn as fliers: outside the whiskers."""
    st = boxplot_stats(df, column, whis).select(F.struct("whisker_low", "whisker_high")).scalar()
    wl, wh = st["whisker_low"], st["whisker_high"]
    v = F.col(column).cast("double")
    return df.where((v < wl) | (v > wh)).select(*keep, column)
