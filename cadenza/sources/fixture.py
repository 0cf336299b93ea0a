"""Raw track table derived from the driver's parquet tables.

The reference reads one public CSV that is not available here.  This source
builds a table with the same 20 columns from ``lineitem`` joined to ``part``:
one part is one track, one line item is one (track, genre) row.  Every line
item is used; nothing is sampled.  ``row_no`` (with ``track_genre`` as tie
breaker) plays the role of the file position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.schema import RAW_SCHEMA


def _pad(x: Column, width: int) -> Column:
    """Zero-padded to ``width``; a longer number is kept whole."""
    s = x.cast("string")
    return F.lpad(s, F.greatest(F.lit(width), F.length(s)), F.lit("0"))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20-column raw table plus ``row_no`` (see FIXTURES.md for the mapping)."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", "l_linestatus")
    part = read_table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size")
    # number of suppliers: a scalar subquery, evaluated once by Spark
    n_sup = read_table(spark, sf_dir, "supplier").select(F.count(F.lit(1))).scalar()

    k = F.col("p_partkey")
    first_artist = F.concat(F.lit("Supplier#"), _pad((k * 7) % n_sup, 9))
    second_artist = F.concat(F.lit(";Supplier#"), _pad((k * 13 + 5) % n_sup, 9))
    artists = (F.when(k % 101 == 7, F.lit(None))
               .when((k % 4).isin(1, 2), F.concat(first_artist, second_artist))
               .otherwise(first_artist))
    album = (F.when(k % 103 == 9, F.lit(None))
             .when(k % 3 == 0, F.concat(F.col("p_brand"), F.lit(" "), F.col("p_name")))
             .when(k % 3 == 1, F.concat(F.col("p_brand"), F.lit(" "), F.col("p_type")))
             .otherwise(F.concat(F.lit("Volume "), F.floor(F.sqrt(k)).cast("bigint").cast("string"))))
    bump = F.when(k % 11 == 0, F.col("l_linenumber")).otherwise(F.lit(0))
    ts_band = k % 50
    time_signature = (F.when(ts_band == 0, 0).when(ts_band <= 3, 1).when(ts_band <= 9, 3)
                      .when(ts_band <= 13, 5).otherwise(4))

    def ratio(m: int) -> Column:
        return (k % m).cast("double") / F.lit(float(m))

    cols = {
        "row_no": F.col("l_orderkey") * 8 + F.col("l_linenumber"),
        "track_id": F.concat(F.lit("trk"), _pad(k, 8)),
        "artists": artists,
        "album_name": album,
        "track_name": F.when(k % 97 == 5, F.lit(None)).otherwise(F.col("p_name")),
        "popularity": F.least(F.lit(100), (k * 37) % 101 + bump),
        "duration_ms": F.lit(60000) + (k * 7919) % 300000,
        "explicit": k % 10 == 0,
        "danceability": F.col("p_size").cast("double") / F.lit(50.0),
        "energy": ratio(97),
        "key": k % 13 - 1,
        "loudness": F.lit(-60.0) + (k % 600).cast("double") / F.lit(10.0),
        "mode": k % 2,
        "speechiness": ratio(89),
        "acousticness": ratio(83),
        "instrumentalness": ratio(79),
        "liveness": ratio(73),
        "valence": ratio(71),
        "tempo": F.lit(60.0) + (k % 1400).cast("double") / F.lit(10.0),
        "time_signature": time_signature,
        "track_genre": F.concat(F.col("l_returnflag"), F.col("l_linestatus"), F.lit("-"),
                                F.col("l_linenumber").cast("string")),
    }
    # a shuffle of the narrow rows; the part table grows with the input and is not broadcast
    joined = li.join(part.hint("merge"), li.l_partkey == part.p_partkey, "inner")
    return joined.select(*[cols[f.name].cast(f.dataType).alias(f.name) for f in RAW_SCHEMA.fields])
