"""The six questions as Spark SQL text over views of the star tables.

For users who keep their questions as query text.  Ranks are taken over the
distinct values that are ranked and joined back, so no window sees the rows;
sums and counts are formed on ids, and names are attached last.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from cadenza import schema as S
from cadenza.operators.star import Star
from cadenza.sources.database import use_database


def _mean(total: str, count: str, n: int = 0, divisor: int = 1) -> str:
    """total / count / divisor of non-negative integers at n decimals, rounded once."""
    total, count = f"CAST({total} AS DECIMAL(26,0))", f"CAST({count} AS DECIMAL(18,0)) * {divisor}"
    return f"CAST(({total} * {2 * 10 ** n} + {count}) DIV nullif(2 * {count}, 0) AS DOUBLE) / {float(10 ** n)!r}D"


def _band(n: str) -> str:
    """The album bands, from their table."""
    whens = " ".join(f"WHEN {n} BETWEEN {lo} AND {hi} THEN '{name}'" for lo, hi, name in S.ALBUM_BANDS)
    return f"CASE {whens} ELSE '{S.ALBUM_OTHER}' END"


def _text(array: str) -> str:
    return f"nullif(array_join(array_sort({array}), '{S.CONCAT_SEPARATOR}'), CASE WHEN size({array}) = 0 THEN '' END)"


#: question: (tables it reads, text with {table} for each view)
SQL: dict[str, tuple[tuple[str, ...], str]] = {
    "q1_top_tracks": (("fact_track_popularity", "dim_tracks", "artist_track_mapping", "dim_artists"), f"""
WITH best AS (
  SELECT DISTINCT popularity FROM {{fact_track_popularity}} ORDER BY popularity DESC NULLS LAST LIMIT 10),
place AS (
  SELECT popularity, row_number() OVER (ORDER BY popularity DESC NULLS LAST) AS track_rank FROM best),
hit AS (
  SELECT /*+ BROADCAST(place) */ track_id, place.popularity, track_rank
  FROM {{fact_track_popularity}} fact JOIN place ON fact.popularity <=> place.popularity),
credit AS (
  SELECT track_id, collect_list(artist_name) AS names
  FROM hit JOIN {{artist_track_mapping}} USING (track_id) JOIN {{dim_artists}} USING (artist_id) GROUP BY track_id),
title AS (
  SELECT track_id, track_name, primary_genre, count(*) AS times
  FROM {{dim_tracks}} GROUP BY track_id, track_name, primary_genre),
answer AS (
  SELECT title.*, hit.popularity, hit.track_rank, flatten(array_repeat(names, CAST(times AS INT))) AS all_names
  FROM hit JOIN credit USING (track_id) JOIN title USING (track_id))
SELECT track_name, primary_genre, {_text('all_names')} AS artist_names, popularity, CAST(track_rank AS BIGINT) AS track_rank
FROM answer ORDER BY track_rank"""),
    "q2_duration_popularity_named": (("dim_tracks", "fact_track_popularity"), f"""
WITH length AS (
  SELECT track_id, track_name, sum(duration_ms) AS ms, count(duration_ms) AS n
  FROM {{dim_tracks}} GROUP BY track_id, track_name)
SELECT track_id, track_name, {_mean('ms', 'n', 2, 60000)} AS mins, CAST(popularity AS DOUBLE) AS avg_popularity
FROM length JOIN {{fact_track_popularity}} USING (track_id) ORDER BY avg_popularity DESC"""),
    "q3_top_artists": (("fact_track_popularity", "artist_track_mapping", "dim_artists"), f"""
WITH tally AS (
  SELECT artist_id, count(*) AS num_songs, sum(popularity) AS total, count(popularity) AS n
  FROM {{artist_track_mapping}} JOIN {{fact_track_popularity}} USING (track_id) GROUP BY artist_id HAVING count(*) > 5),
scored AS (SELECT artist_id, num_songs, {_mean('total', 'n')} AS score FROM tally),
best AS (
  SELECT DISTINCT score, num_songs FROM scored ORDER BY score DESC NULLS LAST, num_songs DESC LIMIT 10),
place AS (
  SELECT *, row_number() OVER (ORDER BY score DESC NULLS LAST, num_songs DESC) AS artist_rank FROM best)
SELECT /*+ BROADCAST(place) */ artist_name, scored.num_songs, scored.score AS avg_popularity_score,
       CAST(artist_rank AS BIGINT) AS artist_rank
FROM scored JOIN place ON scored.score <=> place.score AND scored.num_songs = place.num_songs
JOIN {{dim_artists}} USING (artist_id)"""),
    "q4_album_categories": (("dim_tracks", "fact_track_popularity", "dim_albums"), f"""
WITH tally AS (
  SELECT album_id, count(*) AS songs, sum(popularity) AS total, count(popularity) AS n
  FROM {{fact_track_popularity}} JOIN {{dim_tracks}} USING (track_id) GROUP BY album_id),
banded AS (
  SELECT album_id, {_band('songs')} AS album_category, {_mean('total', 'n')} AS score FROM tally),
per_band AS (
  SELECT album_category, count(album_name) AS num_albums, sum(CAST(score AS BIGINT)) AS total, count(score) AS n
  FROM banded JOIN {{dim_albums}} USING (album_id) GROUP BY album_category)
SELECT album_category, num_albums, {_mean('total', 'n')} AS avg_pop_score FROM per_band ORDER BY avg_pop_score DESC"""),
    "q5_key_popularity": (("dim_tracks", "fact_track_popularity"), f"""
WITH spread AS (
  SELECT key_signature, popularity, count(*) AS n
  FROM {{fact_track_popularity}} JOIN {{dim_tracks}} USING (track_id) GROUP BY key_signature, popularity)
SELECT key_signature, {_mean('sum(popularity * n)', 'sum(n) FILTER (WHERE popularity IS NOT NULL)', 1)} AS avg_popularity
FROM spread GROUP BY key_signature ORDER BY avg_popularity DESC"""),
    "q6_top_albums": (("dim_tracks", "fact_track_popularity", "artist_track_mapping", "dim_artists", "dim_albums"), f"""
WITH cast_size AS (SELECT track_id, count(*) AS artists FROM {{artist_track_mapping}} GROUP BY track_id),
tally AS (
  SELECT album_id, count(DISTINCT track_id) AS num_songs, sum(popularity * artists) AS total,
         sum(artists) FILTER (WHERE popularity IS NOT NULL) AS n
  FROM {{dim_tracks}} JOIN {{fact_track_popularity}} USING (track_id) JOIN cast_size USING (track_id) GROUP BY album_id),
scored AS (SELECT album_id, num_songs, {_mean('total', 'n')} AS score, {_band('num_songs')} AS album_category FROM tally),
place AS (
  SELECT score, row_number() OVER (ORDER BY score DESC NULLS LAST) AS overall_rank FROM (SELECT DISTINCT score FROM scored)),
best AS (
  SELECT album_id, album_name, album_category, num_songs, scored.score, overall_rank
  FROM scored JOIN place ON scored.score <=> place.score JOIN {{dim_albums}} USING (album_id)
  WHERE album_category <> 'Single'
  ORDER BY scored.score DESC NULLS LAST, overall_rank, album_name NULLS FIRST LIMIT 10),
member AS (
  SELECT /*+ BROADCAST(best) */ DISTINCT album_id, track_id, primary_genre FROM best JOIN {{dim_tracks}} USING (album_id)),
genre AS (SELECT album_id, collect_set(primary_genre) AS genres FROM member GROUP BY album_id),
artist AS (
  SELECT album_id, collect_set(artist_name) AS names
  FROM member JOIN {{artist_track_mapping}} USING (track_id) JOIN {{dim_artists}} USING (artist_id) GROUP BY album_id)
SELECT album_name, {_text('names')} AS artists, album_category, {_text('genres')} AS genres,
       CAST(overall_rank AS BIGINT) AS overall_rank, num_songs, score AS avg_pop_score
FROM best JOIN genre USING (album_id) JOIN artist USING (album_id)
ORDER BY score DESC NULLS LAST, overall_rank, album_name NULLS FIRST"""),
}


def run(spark: SparkSession, star: Star, name: str) -> DataFrame:
    """Run one question's text over views of its tables.  The views have names
    of their own, so no view of the caller is replaced."""
    tables, text = SQL[name]
    prefix = f"cadenza_{uuid.uuid4().hex}_"
    star.register(prefix, tables)
    try:
        return spark.sql(text.format(**{t: prefix + t for t in tables}))
    finally:
        for t in tables:
            spark.catalog.dropTempView(prefix + t)


def run_in_database(spark: SparkSession, database: str, name: str) -> DataFrame:
    """Run one question's text on the plain table names of a database of the catalog."""
    tables, text = SQL[name]
    with use_database(spark, database):
        return spark.sql(text.format(**{t: t for t in tables}))
