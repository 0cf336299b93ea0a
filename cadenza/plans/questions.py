"""The six business questions (and the variants the reference's copies
disagree on) as DataFrame plans over a :class:`~cadenza.operators.star.Star`.

Numeric rules: averages of integers are exact, and ``ROUND`` of one rounds the
exact quotient once, half away from zero; an unrounded ``AVG`` is a decimal with
four more decimals.  Values are returned as DOUBLE.

Global ``DENSE_RANK`` windows are never run in one partition: a rank filter
becomes a top-k over the distinct keys (broadcast, at most k rows) and a
kept rank column is computed on the distinct keys (:mod:`cadenza.operators.ids`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.functions.columns import album_category, exact_avg, group_concat, rounded_avg, rounded_quotient
from cadenza.operators.ids import dense_rank_all, top_k_dense
from cadenza.operators.star import Star
from cadenza.operators.string_agg import string_agg
from cadenza.session import checkpoint

TOP_K = 10


def _dbl(c, name: str):
    return c.cast("double").alias(name)


def q1_top_tracks(star: Star, k: int = TOP_K) -> DataFrame:
    """Tracks whose popularity is among the k highest values (ties kept),
    with their artists joined in name order.  Where the track dimension
    is not there yet, these tracks are written once and voted on alone."""
    top = top_k_dense(star.fact_track_popularity, ["popularity"], k, "track_rank")
    if star.votes_on_some:
        top = checkpoint(top, "top-tracks")
        titles = star.genres_of(top.select("track_id"))
    else:
        titles = star.dim_tracks.select("track_id", "track_name", "primary_genre")
    joined = (top.join(titles, "track_id")
              .join(star.artist_track_mapping, "track_id")
              .join(star.dim_artists, "artist_id"))
    return (joined.groupBy("track_id", "track_name", "primary_genre", "popularity", "track_rank")
            .agg(group_concat("artist_name").alias("artist_names"))
            .select("track_name", "primary_genre", "artist_names", "popularity", "track_rank")
            .orderBy("track_rank"))


def _duration_popularity(star: Star, keys: list[str]) -> DataFrame:
    joined = star.dim_tracks_unvoted.join(star.fact_track_popularity, "track_id")
    mins = rounded_avg("duration_ms", 2, 60000)
    avg_pop = rounded_avg("popularity", 1)
    return (joined.groupBy(*keys)
            .agg(_dbl(mins, "mins"), _dbl(avg_pop, "avg_popularity"))
            .orderBy(F.col("avg_popularity").desc()))


def q2_duration_popularity(star: Star) -> DataFrame:
    """Track length in minutes against popularity, per track id."""
    return _duration_popularity(star, ["track_id"])


def q2_duration_popularity_named(star: Star) -> DataFrame:
    """Same, grouped by track id and name (the SQL-file copy)."""
    return _duration_popularity(star, ["track_id", "track_name"])


def artist_popularity(star: Star) -> DataFrame:
    joined = (star.fact_track_popularity.join(star.artist_track_mapping, "track_id")
              .join(star.dim_artists, "artist_id"))
    return joined.groupBy("artist_name").agg(
        F.count_distinct("track_id").alias("num_songs"),
        rounded_avg("popularity", 0).alias("avg_popularity_score"))


def q3_top_artists(star: Star, k: int = TOP_K, min_songs: int = 5) -> DataFrame:
    """Top-k artists (ties kept) by rounded mean popularity, then song count,
    among artists with more than ``min_songs`` songs."""
    ap = artist_popularity(star).where(F.col("num_songs") > min_songs)
    ranked = top_k_dense(ap, ["avg_popularity_score", "num_songs"], k, "artist_rank")
    return ranked.select("artist_name", "num_songs",
                         _dbl(F.col("avg_popularity_score"), "avg_popularity_score"), "artist_rank")


def album_popularity_by_name(star: Star) -> DataFrame:
    joined = (star.dim_tracks_unvoted.join(star.fact_track_popularity, "track_id")
              .join(star.dim_albums, "album_id"))
    return joined.groupBy("album_name").agg(
        F.count("track_id").alias("num_songs"),
        rounded_avg("popularity", 0).alias("avg_popularity_score"))


def q4_album_categories(star: Star) -> DataFrame:
    """Albums banded by song count; album count and popularity per band."""
    ap = album_popularity_by_name(star)
    cat = ap.select("album_name", album_category("num_songs").alias("album_category"),
                    "avg_popularity_score")
    return (cat.groupBy("album_category")
            .agg(F.count("album_name").alias("num_albums"),
                 _dbl(rounded_avg("avg_popularity_score", 0), "avg_pop_score"))
            .orderBy(F.col("avg_pop_score").desc()))


def _key_join(star: Star) -> DataFrame:
    return star.dim_tracks_unvoted.join(star.fact_track_popularity, "track_id")


def q5_key_popularity(star: Star) -> DataFrame:
    """Mean popularity per key signature, one decimal."""
    return (_key_join(star).groupBy("key_signature")
            .agg(_dbl(rounded_avg("popularity", 1), "avg_popularity"))
            .orderBy(F.col("avg_popularity").desc()))


def q5_key_avg_raw(star: Star) -> DataFrame:
    """Mean popularity per key signature, unrounded (four decimals, exact)."""
    return (_key_join(star).groupBy("key_signature")
            .agg(_dbl(exact_avg("popularity"), "avg_popularity"))
            .orderBy(F.col("avg_popularity").desc()))


def q5_key_counts(star: Star) -> DataFrame:
    """Number of track rows per key signature."""
    return (star.dim_tracks_unvoted.groupBy("key_signature")
            .agg(F.count("track_id").alias("num_songs"))
            .orderBy(F.col("num_songs").desc()))


def _texts(star: Star, members: DataFrame) -> DataFrame:
    """``(album_id, artists, genres)`` of track rows with ``album_id, track_id,
    primary_genre``: distinct names and genres in order, joined by sort ranges
    in one go."""
    names = (members.select("album_id", "track_id").distinct().join(star.artist_track_mapping, "track_id")
             .select("album_id", "artist_id").distinct().join(star.dim_artists, "artist_id"))
    both = (names.select("album_id", F.lit("artists").alias("what"), F.col("artist_name").alias("value"))
            .unionByName(members.select("album_id", F.lit("genres").alias("what"), F.col("primary_genre").alias("value"))))
    texts = string_agg(both, ["album_id", "what"], "value", "text", distinct=True)
    return texts.groupBy("album_id").agg(*[F.max(F.when(F.col("what") == c, F.col("text"))).alias(c) for c in ("artists", "genres")])


def _albums(star: Star, scores: DataFrame) -> DataFrame:
    """``scores`` (by album id) with album name, artists and genres."""
    members = star.dim_tracks.select("album_id", "track_id", "primary_genre")
    return scores.join(star.dim_albums, "album_id").join(_texts(star, members), "album_id")


def album_popularity_by_id(star: Star) -> DataFrame:
    """Per album: distinct artists and genres, distinct songs, mean popularity
    over the artist fan-out (a two-artist track weighs twice)."""
    return _albums(star, album_scores(star)).select("album_id", "album_name", "artists", "genres", "num_songs",
                                                    F.col("score").alias("avg_popularity_score"))


def albums_ranked(star: Star) -> DataFrame:
    """Every album with its category and its dense rank by score among all
    albums (singles included).  Only ids and scores are ranked; names follow."""
    scores = checkpoint(album_scores(star), "album-scores")
    ranked = dense_rank_all(scores, ["score"], "album_rank", ascending=False)
    return _albums(star, ranked).select("album_name", "artists", "genres", album_category("num_songs").alias("album_category"),
                                        "num_songs", F.col("score").alias("avg_popularity_score"), "album_rank")


def album_scores(star: Star) -> DataFrame:
    """``(album_id, num_songs, score)``: mean popularity where a track weighs
    once per artist, from per-track artist counts, without any names."""
    artists = star.artist_track_mapping.groupBy("track_id").agg(F.count(F.lit(1)).alias("weight"))
    joined = (star.dim_tracks_unvoted.select("track_id", "album_id").join(star.fact_track_popularity, "track_id")
              .join(artists, "track_id"))
    total = F.sum((F.col("popularity") * F.col("weight")).cast("decimal(18,0)"))
    weight = F.sum(F.when(F.col("popularity").isNotNull(), F.col("weight")))
    return joined.groupBy("album_id").agg(F.count_distinct("track_id").alias("num_songs"),
                                          rounded_quotient(total, weight, 0).alias("score"))


def q6_top_albums(star: Star, k: int = TOP_K) -> DataFrame:
    """Top-k non-single albums by score with their overall rank among all
    albums (singles included); ties are broken by rank and name, which is
    unique.  The k albums are written once; only their tracks are voted on, and
    artist and genre texts are built for them alone."""
    scores = checkpoint(album_scores(star), "album-scores")
    # the rank falls as the score rises, so the order needs the score alone
    order = [F.col("score").desc_nulls_last(), F.col("album_name").asc_nulls_first()]
    best = (scores.withColumn("album_category", album_category("num_songs")).where(F.col("album_category") != "Single")
            .join(star.dim_albums, "album_id").orderBy(*order).limit(k))
    best = checkpoint(best, "best-albums")
    # at most k scores: their ranks are counted over the distinct ones in one pass
    known = [r["score"] for r in best.select("score").distinct().collect()]
    better = scores.select("score").distinct().agg(*[
        F.count_if(F.col("score").isNotNull() if x is None else F.col("score") > F.lit(x)).alias(f"n{i}") for i, x in enumerate(known)]
        or [F.lit(0).alias("n")]).first()
    rank = F.lit(None).cast("long")
    for i, x in enumerate(known):
        rank = F.when(F.col("score").eqNullSafe(F.lit(x).cast("double")), F.lit(better[i] + 1).cast("long")).otherwise(rank)
    tracks = checkpoint(star.dim_tracks_of(best.select("album_id")).select("album_id", "track_id", "primary_genre"), "best-tracks")
    return (best.withColumn("overall_rank", rank).join(_texts(star, tracks), "album_id").orderBy(*order)
            .select("album_name", "artists", "album_category", "genres", "overall_rank",
                    F.col("num_songs").cast("bigint").alias("num_songs"), F.col("score").alias("avg_pop_score")))
