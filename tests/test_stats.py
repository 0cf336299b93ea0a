import math

import numpy as np
import pandas as pd
import pytest

from cadenza.operators import profile as P
from cadenza.operators import stats as ST

VALUES = [0, 3, 10, 10, 17, 33, 33, 34, 50, 66, 67, 90, 99, 100, 100, 45, 12, 3, 77, 58]


@pytest.fixture
def pop(spark):
    return spark.createDataFrame([(f"t{i}", v) for i, v in enumerate(VALUES)], "track_id string, popularity int")


def test_histogram_matches_numpy(pop):
    counts, edges = np.histogram(np.array(VALUES, dtype=float), bins=30)
    rows = sorted(ST.histogram(pop, "popularity", 30).collect(), key=lambda r: r.bin)
    assert [r["count"] for r in rows] == counts.tolist()
    assert [r.bin_start for r in rows] == edges[:-1].tolist()
    assert rows[-1].bin_end == edges[-1]


def test_kde_matches_scott_rule(pop):
    x = np.array(VALUES, dtype=float)
    n = len(x)
    h = x.std(ddof=1) * n ** (-0.2)
    grid = np.linspace(x.min(), x.max(), 200)
    dens = np.exp(-0.5 * ((grid[:, None] - x[None, :]) / h) ** 2).sum(axis=1) / (n * h * math.sqrt(2 * math.pi))
    rows = sorted(ST.kde(pop, "popularity", 200).collect(), key=lambda r: r.grid_index)
    assert np.allclose([r.x for r in rows], grid, rtol=0, atol=1e-12)
    assert np.allclose([r.density for r in rows], dens, rtol=1e-10, atol=0)


def test_boxplot_matches_numpy(pop):
    x = np.array(VALUES, dtype=float)
    q1, med, q3 = np.percentile(x, [25, 50, 75])
    iqr = q3 - q1
    lo = x[x >= q1 - 1.5 * iqr].min()
    hi = x[x <= q3 + 1.5 * iqr].max()
    r = ST.boxplot_stats(pop, "popularity").collect()[0]
    assert (r.q1, r.median, r.q3, r.whisker_low, r.whisker_high) == (q1, med, q3, lo, hi)
    assert r.n_outliers == int(((x < lo) | (x > hi)).sum())


def test_describe_matches_pandas(pop):
    d = pd.Series(VALUES).describe()
    r = P.describe(pop, "popularity").collect()[0]
    assert r["count"] == d["count"]
    assert math.isclose(r.mean, d["mean"]) and math.isclose(r["std"], d["std"], rel_tol=1e-12)
    assert (r["min"], r.q25, r.q50, r.q75, r["max"]) == (d["min"], d["25%"], d["50%"], d["75%"], d["max"])


def test_correlation_matches_pandas(spark):
    rng = np.random.default_rng(7)
    data = rng.normal(size=(50, 3))
    data[5, 1] = np.nan
    pdf = pd.DataFrame(data, columns=["a", "b", "c"])
    df = spark.createDataFrame(pdf)
    got = {(r.feature_x, r.feature_y): r.r for r in ST.correlation_matrix(df, ["a", "b", "c"]).collect()}
    ref = pdf.corr()
    for (x, y), v in got.items():
        assert math.isclose(v, ref.loc[x, y], rel_tol=1e-9)


def test_null_counts_and_value_counts(spark):
    df = spark.createDataFrame([(1, None), (1, "x"), (None, "y"), (3, None)], "a int, b string")
    nulls = {r.column_name: r.null_count for r in P.null_counts(df).collect()}
    assert nulls == {"a": 1, "b": 2}
    vc = [(r.a, r["count"]) for r in P.value_counts(df, "a").collect()]
    assert vc == [(1, 2), (3, 1)]


def test_constant_column_statistics(spark):
    df = spark.createDataFrame([(f"t{i}", 7) for i in range(5)], "track_id string, popularity int")
    assert all(r.density is None for r in ST.kde(df, "popularity", 10).collect())
    h = ST.histogram(df, "popularity", 30).collect()
    assert sum(r["count"] for r in h) == 5
    b = ST.boxplot_stats(df, "popularity").collect()[0]
    assert (b.q1, b.q3, b.whisker_low, b.whisker_high, b.n_outliers) == (7.0, 7.0, 7.0, 7.0, 0)


def test_distributed_quantiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(50, 20, size=3000), 1)          # many distinct values, some repeats
    df = spark.createDataFrame([(float(v),) for v in x], "v double").repartition(5)
    probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    got = P.exact_quantiles(df, "v", probs).collect()[0]
    ref = np.percentile(x, [0, 25, 50, 90, 100])
    for k, r in zip("abcde", ref):
        assert math.isclose(got[k], r, rel_tol=1e-12)


def test_variance_does_not_cancel(spark):
    x = [10 ** 9 + i % 5 for i in range(500)]
    df = spark.createDataFrame([(v,) for v in x], "v long")
    row = P.describe(df, "v").collect()[0]
    assert math.isclose(row["std"], np.std(x, ddof=1), rel_tol=1e-9)
    density = [r.density for r in ST.kde(df, "v", 20).collect()]
    h = np.std(x, ddof=1) * len(x) ** -0.2
    grid = np.linspace(min(x), max(x), 20)
    want = [np.exp(-0.5 * ((g - np.array(x)) / h) ** 2).sum() / (len(x) * h * math.sqrt(2 * math.pi)) for g in grid]
    assert np.allclose(sorted(density), sorted(want), rtol=1e-6)


def test_dtypes_is_a_frame(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    assert [(r.column_name, r.data_type) for r in P.dtypes(df).collect()] == [("a", "int"), ("b", "string")]


@pytest.mark.parametrize("values", [
    [2.0 ** -i for i in range(300)] + [-(3.0 ** i) for i in range(60)], [float("inf"), 1.0, 2.0, 2.0, float("-inf"), float("-inf")],
    [1.7e308, -1.7e308, 5e-324, 0.0, -0.0, 1.0], [7.0], [1.0, 1.0 + 2 ** -52, 1.0 + 2 ** -51]])
def test_ranks_are_selected_by_counting(spark, values):
    df = spark.createDataFrame([(v,) for v in values + [None, float("nan")]], "v double")
    freq = P.frequency_table(df, "v")
    got = P.select_ranks(freq, list(range(len(values))))
    assert [got[k] for k in range(len(values))] == sorted(values)


def test_quantiles_sort_and_write_nothing_more(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=3_000), rng.integers(0, 5, 2_000)])
    freq = P.frequency_table(spark.createDataFrame([(float(v),) for v in x], "v double"), "v")
    monkeypatch.setattr(P, "checkpoint", None)
    got = P.quantile_values(freq, len(x), {"a": 0.01, "b": 0.37, "c": 0.999})
    assert list(got.values()) == pytest.approx(list(np.quantile(x, [0.01, 0.37, 0.999])), rel=1e-15)


def test_kernels_reach_their_bandwidth_only(spark):
    # two far groups: most grid points lie beyond every kernel
    x = np.concatenate([np.linspace(0, 1, 4_000), np.linspace(1_000, 1_001, 3)])
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    h = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min(), x.max(), 50)
    want = np.exp(-0.5 * ((grid[:, None] - x) / h) ** 2).sum(axis=1) / (len(x) * h * math.sqrt(2 * math.pi))
    got = sorted(ST.kde(df, "v", 50).collect(), key=lambda r: r.grid_index)
    assert len(got) == 50 and np.allclose([r.density for r in got], want, rtol=1e-9, atol=1e-15)


def test_correlation_of_complete_and_incomplete_columns(spark):
    rng = np.random.default_rng(8)
    data = rng.normal(size=(80, 4)) + 1e6
    data[3, 2], data[9, 3], data[10, 3] = np.nan, np.nan, np.nan
    pdf = pd.DataFrame(data, columns=list("abcd"))
    pdf["e"] = 5.0
    rows = [[None if v != v else float(v) for v in r] for r in pdf.to_numpy()]
    got = {(r.feature_x, r.feature_y): r.r for r in ST.correlation_matrix(
        spark.createDataFrame(rows, "a double, b double, c double, d double, e double"), list("abcde")).collect()}
    want = pdf.corr()
    assert all(got[x, y] == pytest.approx(want.loc[x, y], abs=1e-9) for x in "abcd" for y in "abcd")
    assert got["a", "e"] is None and got["e", "e"] == 1.0
