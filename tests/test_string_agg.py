from pyspark.sql import functions as F

from cadenza.operators.string_agg import string_agg


def _plain(rows, distinct):
    out = {}
    for k, v in rows:
        out.setdefault(k, []).append(v)
    return {k: ", ".join(sorted(set(x) if distinct else x)) if (x := [v for v in vs if v is not None]) else None for k, vs in out.items()}


def test_groups_of_all_sizes(spark):
    rows = [("a", "x"), ("a", None), ("a", "b"), ("a", "x"), (None, "n"), (None, "m"), ("empty", None), ("blank", ""), ("blank", "")]
    rows += [("hot", f"name {i % 700:04d}") for i in range(3_000)]
    df = spark.createDataFrame(rows, "g string, v string").withColumn("_piece", F.lit(1)).repartition(5)
    for distinct in (False, True):
        for partitions in (None, 1, 13):
            got = {r.g: r.t for r in string_agg(df, ["g"], "v", "t", distinct=distinct, partitions=partitions).collect()}
            assert got == _plain(rows, distinct)


def test_a_hot_group_never_meets_in_one_task(spark):
    """One group of 400,000 names: sorted and joined in pieces of bounded size."""
    df = spark.range(400_000).select(F.lit(0).alias("g"), F.format_string("name %08d", F.pmod(F.xxhash64("id"), F.lit(10 ** 8))).alias("v"))
    from cadenza.operators import string_agg as module
    seen = []
    real = module.checkpoint
    module.checkpoint = lambda d, label: seen.append(real(d, label)) or seen[-1]
    try:
        text = string_agg(df, ["g"], "v", "t", partitions=40).select(F.length("t").alias("n"), F.substring("t", 1, 30).alias("s")).first()
    finally:
        module.checkpoint = real
    assert seen[0].groupBy("_piece").count().agg(F.max("count")).first()[0] < 40_000
    assert text.n == 400_000 * 15 - 2 and text.s == ", ".join(sorted(r.v for r in df.orderBy("v").limit(3).collect()))[:30]


def test_no_rows(spark):
    df = spark.createDataFrame([], "g int, h string, v string")
    assert string_agg(df, ["g", "h"], "v", "t").columns == ["g", "h", "t"] and string_agg(df, ["g", "h"], "v", "t").count() == 0
