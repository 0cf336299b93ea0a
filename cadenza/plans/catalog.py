"""Registry of named queries: Spark plan + DuckDB oracle text.

Each Spark callable takes ``(spark, sf_dir)``, reads the driver tables under
``sf_dir`` and returns a lazy DataFrame.  Float columns that come out of an
average of doubles are presented at ``FLOAT_DECIMALS`` decimals on both sides,
since summation order changes their last bits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza import schema as S
from cadenza.operators.star import Star, build_star
from cadenza.plans import oracle as O
from cadenza.plans import questions as Q
from cadenza.sources.fixture import raw_tracks

FLOAT_DECIMALS = 9

QueryFn = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, QueryFn] = {}
_ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        _REGISTRY[name] = fn
        if sql is not None:
            _ORACLE[name] = sql
        return fn
    return deco


def queries() -> dict[str, QueryFn]:
    return dict(_REGISTRY)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)


def star_for(spark: SparkSession, sf_dir: str, match_time_signature: bool = False, stages: bool = True,
             voted: bool = True) -> Star:
    """``voted=False``: no genre is asked for, so the cleaned rows need no written copy."""
    return build_star(raw_tracks(spark, sf_dir), match_time_signature=match_time_signature, checkpoint_stages=stages,
                      keep_clean=voted)


def _round_doubles(df: DataFrame, cols) -> DataFrame:
    return df.select(*[F.round(F.col(c), FLOAT_DECIMALS).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def _sql_round(cols, all_cols) -> str:
    return ", ".join(f"round({c}, {FLOAT_DECIMALS}) AS {c}" if c in cols else c for c in all_cols)


# --- star tables ----------------------------------------------------------------

def _star_table(name: str, float_cols=()):
    def fn(spark: SparkSession, sf_dir: str) -> DataFrame:
        # a table that reads the cleaned rows once needs no written copy of them
        star = star_for(spark, sf_dir, stages=name not in ("dim_genre", "fact_track_popularity"), voted=name == "dim_tracks")
        df = getattr(star, name)
        return _round_doubles(df, float_cols) if float_cols else df
    return fn


_TABLE_COLS = {
    "dim_artists": ["artist_id", "artist_name"],
    "dim_albums": ["album_id", "album_name"],
    "dim_tracks": S.DIM_TRACK_COLS,
    "dim_genre": S.GENRE_FEATURE_COLS,
    "artist_track_mapping": ["artist_id", "track_id"],
    "fact_track_popularity": ["track_id", "popularity"],
}
for _name, _cols in _TABLE_COLS.items():
    _floats = S.SIMILARITY_COLS if _name == "dim_genre" else ()
    register(_name, O.with_chain(f"SELECT {_sql_round(_floats, _cols)} FROM {_name}"))(
        _star_table(_name, _floats))


# --- business questions ------------------------------------------------------------

def _question(fn, voted: bool = True):
    return lambda spark, sf_dir: fn(star_for(spark, sf_dir, voted=voted))


register("q1_top_tracks", O.with_chain(O.Q1))(_question(Q.q1_top_tracks))
register("q2_duration_popularity", O.with_chain(O.Q2))(_question(Q.q2_duration_popularity, voted=False))
register("q2_duration_popularity_named", O.with_chain(O.Q2_NAMED))(_question(Q.q2_duration_popularity_named, voted=False))
register("q3_top_artists", O.with_chain(O.Q3))(_question(Q.q3_top_artists, voted=False))
register("q4_album_categories", O.with_chain(O.Q4))(_question(Q.q4_album_categories, voted=False))
register("q5_key_popularity", O.with_chain(O.Q5))(_question(Q.q5_key_popularity, voted=False))
register("q5_key_avg_raw", O.with_chain(O.Q5_RAW))(_question(Q.q5_key_avg_raw, voted=False))
register("q5_key_counts", O.with_chain(O.Q5_COUNTS))(_question(Q.q5_key_counts, voted=False))
register("q6_top_albums", O.with_chain(O.Q6))(_question(Q.q6_top_albums))
from cadenza.plans import catalog_ops  # noqa: E402,F401  (registers the operator keys)
