from pyspark.sql import functions as F

from cadenza.functions.columns import (album_category, exact_avg, group_concat, group_concat_distinct, half_even_int,
                                       key_signature, rounded_avg)


def test_key_signature(spark):
    df = spark.createDataFrame([(0, 0), (1, 1), (-1, 0), (11, None), (None, 1)], "key int, mode int")
    out = [r.ks for r in df.select(key_signature("key", "mode").alias("ks")).collect()]
    assert out == ["C Minor", "C#/Db Major", None, "B Major", None]


def test_album_category_bands(spark):
    sizes = [1, 2, 7, 8, 15, 16, 20, 21, 30, 31]
    df = spark.createDataFrame([(n,) for n in sizes], "n int")
    out = [r.c for r in df.select(album_category("n").alias("c")).collect()]
    assert out == ["Single", "EP", "EP", "Standard Album", "Standard Album", "Deluxe Album",
                   "Deluxe Album", "Double Album", "Double Album", "Compilations"]


def test_half_even_and_half_up(spark):
    df = spark.createDataFrame([(2.5,), (3.5,), (0.5,)], "x double")
    assert [r.v for r in df.select(half_even_int("x").alias("v")).collect()] == [2, 4, 0]
    g = spark.createDataFrame([(0,), (0,), (2,)], "p int")
    row = g.agg(exact_avg("p").alias("a"), rounded_avg("p", 1).alias("r")).collect()[0]
    assert str(row.a) == "0.6667" and float(row.r) == 0.7


def test_group_concat_rules(spark):
    df = spark.createDataFrame([("g1", "b"), ("g1", "a"), ("g1", "a"), ("g2", None), ("g3", "")],
                               "g string, x string")
    out = {r.g: (r.all, r.dist) for r in df.groupBy("g").agg(
        group_concat("x").alias("all"), group_concat_distinct("x").alias("dist")).collect()}
    assert out["g1"] == ("a, a, b", "a, b")
    assert out["g2"] == (None, None)       # nothing to join -> NULL
    assert out["g3"] == ("", "")           # an empty name is still a value


def test_split_and_explode_keep_missing_and_empty(spark):
    from cadenza.operators.star import artist_names
    df = spark.createDataFrame([("t1", "A;B"), ("t2", None), ("t3", "A;;C")], "track_id string, artists string")
    out = sorted(((r.track_id, r.artist_name) for r in artist_names(df).collect()),
                 key=lambda t: (t[0], t[1] or ""))
    assert out == [("t1", "A"), ("t1", "B"), ("t2", None), ("t3", ""), ("t3", "A"), ("t3", "C")]


def test_means_are_rounded_once_from_exact_integers(spark):
    # 999 / 20,000 = 0.04995: four decimals first would give 0.1
    df = spark.range(20_000).selectExpr("CAST(id < 999 AS INT) AS p", "CAST(300 AS INT) AS ms")
    row = df.agg(rounded_avg("p", 1).alias("p"), rounded_avg("ms", 2, 60000).alias("m")).collect()[0]
    assert (row.p, row.m) == (0.0, 0.01)                    # 300 ms = 0.005 min, half away from zero
    neg = spark.createDataFrame([(-1,), (-2,)], "p int").agg(rounded_avg("p", 0).alias("r")).collect()[0]
    assert neg.r == -2.0
    assert spark.createDataFrame([(None,)], "p int").agg(rounded_avg("p", 0).alias("r")).collect()[0].r is None
