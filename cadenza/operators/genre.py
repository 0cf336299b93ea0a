"""Genre profiles and each track's primary genre.

The primary genre of a track row is the genre from the track's own genre
list whose profile vector is closest (cosine) to the row's features, among
the genres that were recorded with the row's time signature.  A track listed
under a single row keeps that row's genre without any check.  Ties go to the
genre that appears first in the list.

All of it is joins and column arithmetic: the per-genre profile is a small
aggregate (genres x time signatures) that AQE broadcasts once its size is
known; the candidate genres per track come from one aggregation keyed by
(track, genre), so no list is ever collected per track.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza import schema as S
from cadenza.functions.columns import dot, l2_normalize, l2_norm
from cadenza.operators.ids import dense_ids

_G = "track_genre"
_TS = "time_signature"


def genre_profile(clean: DataFrame) -> DataFrame:
    """Mean energy, speechiness, acousticness and tempo per (genre, time
    signature), over the **distinct** 6-tuples; null keys are dropped."""
    distinct = clean.select(*S.GENRE_FEATURE_COLS).distinct()
    return (distinct.where(F.col(_G).isNotNull() & F.col(_TS).isNotNull())
            .groupBy(_G, _TS)
            .agg(*[F.avg(c).alias(c) for c in S.SIMILARITY_COLS]))


def normalized_profile(profile: DataFrame) -> DataFrame:
    """Profile with unit-length feature vectors (zero vectors unchanged)."""
    unit = l2_normalize(S.SIMILARITY_COLS)
    return profile.select(_G, _TS, *[u.alias(c) for u, c in zip(unit, S.SIMILARITY_COLS)])


def genre_time_signatures(profile: DataFrame) -> DataFrame:
    """Genre -> sorted list of its recorded time signatures."""
    return profile.groupBy(_G).agg(F.sort_array(F.collect_list(_TS)).alias("time_signatures"))


def genre_candidates(clean: DataFrame) -> DataFrame:
    """One row per (track, listed genre): first list position and multiplicity.

    The genre list keeps duplicates and every cleaned row of the track, so a
    track's list length is the sum of the multiplicities.
    """
    return (clean.where(F.col("track_id").isNotNull())
            .groupBy("track_id", _G)
            .agg(F.min(S.ROW_NO).alias("pos"), F.count(F.lit(1)).alias("mult")))


def genre_lists(candidates: DataFrame) -> DataFrame:
    """Per track: list length and first genre (file order, genre breaks ties)."""
    return candidates.groupBy("track_id").agg(
        F.sum("mult").alias("list_len"),
        F.min_by(_G, F.struct("pos", _G)).alias("first_genre"))


def _reference_vectors(nprof: DataFrame, match_time_signature: bool) -> DataFrame:
    """The vector each genre is compared with.

    By default the genre's first profile row, i.e. its lowest time signature
    (the list lookup by genre name returns the first match); with
    ``match_time_signature`` the row of the track's own signature.
    """
    vec_cols = [F.col(c).alias(f"g_{c}") for c in S.SIMILARITY_COLS]
    if match_time_signature:
        return nprof.select(_G, _TS, *vec_cols)
    first = nprof.groupBy(_G).agg(F.min(_TS).alias(_TS))
    return nprof.join(first, [_G, _TS]).select(_G, *vec_cols)


KEY_COLS = ["track_id", _TS, *S.SIMILARITY_COLS]


def candidates_with_lists(cands: DataFrame) -> DataFrame:
    """Candidates with their track's list length and their place in its list
    (1 is the first; a name breaks ties).

    The windows are partitioned by track, and a partition holds one row per
    distinct listed genre of that track, so it stays small however many
    rows the track has.
    """
    of_track = Window.partitionBy("track_id")
    return cands.select("track_id", _G, "pos", F.sum("mult").over(of_track).alias("list_len"),
                        F.row_number().over(of_track.orderBy("pos", _G)).alias("place"))


def genre_numbers(clean: DataFrame) -> DataFrame:
    """``(genre_no, track_genre)``: a number for every genre."""
    return dense_ids(clean.select(_G).where(F.col(_G).isNotNull()), _G, "genre_no", null_id=None)


def vote_rows(tracks: DataFrame, cinfo: DataFrame) -> DataFrame:
    """Each track row with each genre of its track's list (a row without a
    track id keeps one row with no candidate)."""
    return tracks.join(cinfo, "track_id", "left")


def mark_eligible(rows: DataFrame, nprof: DataFrame) -> DataFrame:
    """``eligible``: the genre was recorded with the row's time signature."""
    keys = nprof.select(_G, _TS, F.lit(True).alias("eligible"))
    return rows.join(keys, [_G, _TS], "left")


def add_similarity(rows: DataFrame, nprof: DataFrame, match_time_signature: bool = False) -> DataFrame:
    """Cosine similarity of the row with each eligible genre's vector,
    rounded to ``SIMILARITY_DECIMALS``; null for ineligible genres."""
    vectors = _reference_vectors(nprof, match_time_signature)
    on = [_G, _TS] if match_time_signature else [_G]
    unit = l2_normalize(S.SIMILARITY_COLS, l2_norm(*S.SIMILARITY_COLS))
    t_cols = [f"t_{c}" for c in S.SIMILARITY_COLS]
    withunit = rows.select("*", *[u.alias(t) for u, t in zip(unit, t_cols)])
    scored = withunit.join(vectors, on, "left")
    sim = F.round(dot(t_cols, [f"g_{c}" for c in S.SIMILARITY_COLS]), S.SIMILARITY_DECIMALS)
    return scored.withColumn("sim", F.when(F.col("eligible"), sim)) \
                 .drop(*t_cols, *[f"g_{c}" for c in S.SIMILARITY_COLS])


#: fixed-width fields of a vote: similarity at SIMILARITY_DECIMALS, place from the end, genre number
_PLACES, _NUMBERS = 10 ** 9, 10 ** 12


def _packed() -> Column:
    """One number per candidate whose order is that of the vote: similarity,
    then earlier place; the genre's number is its last field.  A sole listed
    genre stands whatever its similarity."""
    scale = 10 ** S.SIMILARITY_DECIMALS
    sim = F.round(F.coalesce("sim", F.lit(0.0)) * F.lit(float(scale))) + F.lit(float(scale))
    first = sim.cast("decimal(14,0)") * F.lit(str(_PLACES * _NUMBERS)).cast("decimal(22,0)")
    then = (F.lit(_PLACES) - F.col("place")).cast("decimal(10,0)") * F.lit(_NUMBERS).cast("decimal(13,0)")
    packed = first + then + F.col("genre_no").cast("decimal(12,0)")
    return F.when((F.col("list_len") == 1) | F.col("sim").isNotNull(), packed)


def vote(scored: DataFrame, row_cols: list[str], numbers: DataFrame) -> DataFrame:
    """One row per track row: the listed genre with the highest similarity
    (ties: earlier list position, then smaller name), or the only listed
    genre when the list has one entry.

    The maximum of a packed number needs a hash aggregate alone; its last
    field names the genre by ``numbers``."""
    best = scored.groupBy(*row_cols).agg(F.max("list_len").alias("list_len"), F.max(_packed()).alias("best"))
    best = best.withColumn("best_no", F.pmod("best", F.lit(_NUMBERS).cast("decimal(13,0)")).cast("long")).drop("best")
    return (best.join(numbers.withColumnRenamed(_G, "voted_genre"), F.col("best_no") == F.col("genre_no"), "left")
            .select(*row_cols, F.col("voted_genre").alias("primary_genre"), "list_len", "voted_genre"))


def scored_rows(rows: DataFrame, clean: DataFrame, profile: DataFrame, match_time_signature: bool = False,
                numbers: DataFrame | None = None) -> DataFrame:
    """Rows (at least ``KEY_COLS``) x listed genres with eligibility and
    similarity, and with ``genre_no`` where ``numbers`` are given."""
    cinfo = candidates_with_lists(genre_candidates(clean))
    if numbers is not None:
        cinfo = cinfo.join(numbers, _G, "left")
    nprof = normalized_profile(profile)
    return add_similarity(mark_eligible(vote_rows(rows, cinfo), nprof), nprof, match_time_signature)


def vote_keys(tracks: DataFrame) -> DataFrame:
    """The distinct (track, time signature, features) the vote depends on.

    A track usually has one such key however many rows it has (other
    albums, popularity variants), so the candidate pairs stay at about one
    per listed genre even for a track that holds a large share of the rows.
    """
    return tracks.select(*KEY_COLS).distinct()


def assign_primary_genre(tracks: DataFrame, clean: DataFrame, profile: DataFrame,
                         match_time_signature: bool = False) -> DataFrame:
    """``tracks`` plus ``primary_genre`` (table function of the reference job).

    The vote runs once per distinct key and is joined back to the track rows
    with null-safe equality (a missing signature or id is a key too).
    """
    numbers = genre_numbers(clean)
    votes = vote(scored_rows(vote_keys(tracks), clean, profile, match_time_signature, numbers), KEY_COLS, numbers)
    # the votes come from the same rows: rename their keys so the join is unambiguous
    votes = votes.select(*[F.col(c).alias(f"_v_{c}") for c in KEY_COLS], "primary_genre")
    cond = None
    for c in KEY_COLS:
        e = F.col(c).eqNullSafe(F.col(f"_v_{c}"))
        cond = e if cond is None else cond & e
    return tracks.join(votes, cond, "left").drop(*[f"_v_{c}" for c in KEY_COLS])
