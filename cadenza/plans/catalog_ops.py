"""Single-operator queries (cleaning, genre vote stages, scalar functions,
profiling, statistics, sources and sinks), each with its DuckDB text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza import schema as S
from cadenza.functions.columns import album_category, key_scale, key_signature, l2_norm, l2_normalize
from cadenza.operators import clean as C
from cadenza.operators import genre as G
from cadenza.operators import profile as P
from cadenza.operators import stats as ST
from cadenza.operators.ids import top_k_dense
from cadenza.operators.string_agg import string_agg
from cadenza.plans import oracle as O
from cadenza.plans import questions as Q
from cadenza.plans.catalog import FLOAT_DECIMALS, _round_doubles, _sql_round, register, star_for
from cadenza.sources.csv import read_tracks_csv, write_tracks_csv
from cadenza.sources.fixture import raw_tracks
from cadenza.session import checkpoint
from cadenza.sources.published import new_version, read_published
from cadenza.sources.sinks import audit_frame, contents, shared_output_dir

W = O.with_chain
F4 = S.SIMILARITY_COLS
KEYS = G.KEY_COLS
_R = FLOAT_DECIMALS


def _named(spark, d):
    return C.filter_not_null(raw_tracks(spark, d), "track_name")


def _dedup(spark, d):
    return C.dedup_rows(_named(spark, d), S.DATA_COLS, deal_by=S.DEAL_COLS)


def _clean(spark, d):
    """The cleaned rows for a key that reads them once: no stage is written."""
    return C.clean_tracks(raw_tracks(spark, d))


def _profile(spark, d):
    return G.genre_profile(_clean(spark, d))


def _genre_parts(spark, d, match=False, numbered=False):
    star = star_for(spark, d, match)
    clean, profile = star.clean, star.profile
    tracks = C.track_rows(clean)
    cands = G.genre_candidates(clean)
    lists = G.genre_lists(cands)
    keys = G.vote_keys(tracks)
    numbers = G.genre_numbers(clean) if numbered else None
    scored = G.scored_rows(keys, clean, profile, match, numbers)
    return dict(star=star, tracks=tracks, cands=cands, lists=lists, keys=keys, scored=scored, numbers=numbers)


def _voting(scored):
    """Rows of tracks listed more than once with an eligible genre."""
    return scored.where((F.col("list_len") > 1) & F.col("eligible"))


# --- cleaning --------------------------------------------------------------------

register("filter_not_null", W("SELECT * FROM named_rows"))(_named)
register("dedup_rows", W("SELECT * FROM dedup"))(_dedup)
register("filter_ne_nullsafe", W(f"SELECT * FROM dedup WHERE time_signature IS DISTINCT FROM {S.DROP_TIME_SIGNATURE}"))(
    lambda spark, d: C.filter_ne_nullsafe(_dedup(spark, d), "time_signature", S.DROP_TIME_SIGNATURE))
_raw_cols = ", ".join("CASE WHEN time_signature = 1 THEN 4 ELSE time_signature END AS time_signature"
                      if c == "time_signature" else c for c in ["row_no", *S.DATA_COLS])
register("replace_values", W(f"SELECT {_raw_cols} FROM raw"))(
    lambda spark, d: C.replace_values(raw_tracks(spark, d), "time_signature", S.REPLACE_TIME_SIGNATURE))
register("clean_tracks", W("SELECT * FROM clean"))(lambda spark, d: _clean(spark, d))
register("drop_genre", W("SELECT * EXCLUDE (track_genre) FROM clean"))(
    lambda spark, d: _clean(spark, d).drop("track_genre"))
register("track_rows", W("SELECT * FROM tracks"))(lambda spark, d: C.track_rows(_clean(spark, d)))
register("project_columns", W("SELECT artists, track_id FROM tracks"))(
    lambda spark, d: C.track_rows(_clean(spark, d)).select("artists", "track_id"))
register("distinct_subset", W(f"SELECT DISTINCT {', '.join(S.GENRE_FEATURE_COLS)} FROM clean"))(
    lambda spark, d: _clean(spark, d).select(*S.GENRE_FEATURE_COLS).distinct())

# --- genre profile and vote ----------------------------------------------------------

register("l2_normalize", W(f"SELECT {_sql_round(F4, ['track_genre', 'time_signature', *F4])} FROM nprof"))(
    lambda spark, d: _round_doubles(G.normalized_profile(_profile(spark, d)), F4))
register("l2_norm", W(f"SELECT track_genre, time_signature, round({O._norm()}, {_R}) AS norm FROM profile"))(
    lambda spark, d: _profile(spark, d).select(
        "track_genre", "time_signature", F.round(l2_norm(*F4), _R).alias("norm")))
_kcols = ", ".join(KEYS)
_trk_unit = ", ".join(f"round({O._unit(c, O._norm())}, {_R}) AS unit_{c}" for c in F4)
register("l2_norm_tracks", W(f"SELECT {_kcols}, round({O._norm()}, {_R}) AS norm FROM (SELECT DISTINCT {_kcols} FROM tracks)"))(
    lambda spark, d: G.vote_keys(C.track_rows(_clean(spark, d))).select(*KEYS, F.round(l2_norm(*F4), _R).alias("norm")))
register("l2_normalize_tracks", W(f"SELECT {_kcols}, {_trk_unit} FROM (SELECT DISTINCT {_kcols} FROM tracks)"))(
    lambda spark, d: G.vote_keys(C.track_rows(_clean(spark, d))).select(
        *KEYS, *[F.round(u, _R).alias(f"unit_{c}") for u, c in zip(l2_normalize(F4, l2_norm(*F4)), F4)]))
_denorm = ", ".join(f"round(n.{c} * {O._norm('p.')}, {_R}) AS {c}" for c in F4)
register("l2_denormalize", W(f"SELECT n.track_genre, n.time_signature, {_denorm} FROM nprof n "
                             f"JOIN profile p USING (track_genre, time_signature)"))(
    lambda spark, d: _l2_denormalize(spark, d))


def _l2_denormalize(spark, d):
    prof = star_for(spark, d).profile
    norms = prof.select("track_genre", "time_signature", l2_norm(*F4).alias("_norm"))
    n = G.normalized_profile(prof).join(norms, ["track_genre", "time_signature"])
    return n.select("track_genre", "time_signature", *[F.round(F.col(c) * F.col("_norm"), _R).alias(c) for c in F4])


register("genre_profile", W(f"SELECT {_sql_round(F4, S.GENRE_FEATURE_COLS)} FROM profile"))(
    lambda spark, d: _round_doubles(G.genre_profile(_clean(spark, d)), F4))

# Profile rows of a few genres at one time signature (the notebook's check
# of one multi-genre track against its candidate genres).
ISIN_SIGNATURE = 4
ISIN_GENRES = ["AF-1", "NO-2", "RF-3", "AO-4"]
_isin_sql = ", ".join(f"'{g}'" for g in ISIN_GENRES)
register("filter_isin", W(f"SELECT {_sql_round(F4, S.GENRE_FEATURE_COLS)} FROM nprof "
                          f"WHERE time_signature = {ISIN_SIGNATURE} AND track_genre IN ({_isin_sql})"))(
    lambda spark, d: _round_doubles(G.normalized_profile(_profile(spark, d)).where(
        (F.col("time_signature") == ISIN_SIGNATURE) & F.col("track_genre").isin(*ISIN_GENRES)), F4))

register("genre_time_signatures", W(
    "SELECT track_genre, list(time_signature ORDER BY time_signature) AS time_signatures FROM profile GROUP BY track_genre"))(
    lambda spark, d: G.genre_time_signatures(_profile(spark, d)))
register("genre_list", W("SELECT * FROM cands"))(lambda spark, d: _genre_parts(spark, d)["cands"])
register("array_len_first", W("SELECT * FROM lists"))(lambda spark, d: _genre_parts(spark, d)["lists"])
register("join_left_genres", W("SELECT t.*, l.list_len, l.first_genre FROM tracks t LEFT JOIN lists l USING (track_id)"))(
    lambda spark, d: _parts_join_left(spark, d))


def _parts_join_left(spark, d):
    p = _genre_parts(spark, d)
    return p["tracks"].join(p["lists"], "track_id", "left")


_kc = ", ".join(f"k.{c}" for c in KEYS)
register("valid_genre_candidates", W(
    f"SELECT {_kc}, c.track_genre, c.pos FROM keys k "
    "JOIN cands c ON c.track_id = k.track_id AND c.track_genre IS NOT NULL "
    "JOIN (SELECT track_genre, time_signature FROM nprof) e ON e.track_genre = c.track_genre "
    "AND e.time_signature = k.time_signature"))(
    lambda spark, d: _voting(_genre_parts(spark, d)["scored"]).select(*KEYS, "track_genre", "pos"))
register("cosine_similarity", W(f"SELECT {', '.join(KEYS)}, track_genre, pos, round(sim, {_R}) AS sim FROM scored"))(
    lambda spark, d: _voting(_genre_parts(spark, d)["scored"]).select(
        *KEYS, "track_genre", "pos", F.round("sim", _R).alias("sim")))


def _argmax(spark, d):
    p = _genre_parts(spark, d, numbered=True)
    voted = G.vote(p["scored"], G.KEY_COLS, p["numbers"])
    return (voted.where((F.col("list_len") > 1) & F.col("voted_genre").isNotNull())
            .select(*KEYS, "voted_genre"))


register("argmax_per_group", W("SELECT * FROM best"))(_argmax)
register("primary_genre", W("SELECT * FROM tracks_g"))(lambda spark, d: star_for(spark, d).tracks)
register("primary_genre_matched", W("SELECT * FROM tracks_g", match_time_signature=True))(
    lambda spark, d: star_for(spark, d, True).tracks)

# --- scalar functions ------------------------------------------------------------------

register("split_artists", W("SELECT track_id, artists, string_split(artists, ';') AS artist_list FROM tracks"))(
    lambda spark, d: C.track_rows(_clean(spark, d)).select(
        "track_id", "artists", F.split("artists", S.ARTIST_SEPARATOR).alias("artist_list")))
register("explode_artists", W("SELECT artist_name, track_id FROM artist_names"))(
    lambda spark, d: _explode(spark, d))


def _explode(spark, d):
    from cadenza.operators.star import artist_names
    return artist_names(C.track_rows(_clean(spark, d)))


def _artists_per_track(spark, d):
    star = star_for(spark, d, voted=False)
    joined = star.artist_track_mapping.join(star.dim_artists, "artist_id")
    return string_agg(joined, ["track_id"], "artist_name", "artist_names")


register("string_agg_ordered", W(O._final(
    "SELECT map.track_id, string_agg(art.artist_name, ', ' ORDER BY art.artist_name) AS artist_names "
    "FROM artist_track_mapping map JOIN dim_artists art ON map.artist_id = art.artist_id GROUP BY map.track_id")))(
    _artists_per_track)

_scale_sql = "CASE key " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in S.KEY_NAMES.items()) + " END"
register("key_scale", W(f"SELECT DISTINCT key, {_scale_sql} AS scale FROM tracks"))(
    lambda spark, d: C.track_rows(_clean(spark, d)).select("key", key_scale("key").alias("scale")).distinct())
register("key_signature", W(f"SELECT track_id, key, mode, {O._key_signature_sql()} AS key_signature FROM tracks"))(
    lambda spark, d: C.track_rows(_clean(spark, d)).select(
        "track_id", "key", "mode", key_signature("key", "mode").alias("key_signature")))
register("album_category", W(O.Q4_CTES + O._final(
    "SELECT album_name, num_songs, CAST(score AS DOUBLE) AS avg_popularity_score, band AS album_category "
    "FROM album_bands JOIN dim_albums USING (album_id)")))(
    lambda spark, d: Q.album_popularity_by_name(star_for(spark, d, voted=False)).select(
        "album_name", "num_songs", F.col("avg_popularity_score").cast("double").alias("avg_popularity_score"),
        album_category("num_songs").alias("album_category")))

# --- ranking -------------------------------------------------------------------------------

register("dense_rank_topk", W(O._final(
    "SELECT track_id, popularity, track_rank FROM (SELECT track_id, popularity, "
    "DENSE_RANK() OVER (ORDER BY popularity DESC) AS track_rank FROM fact_track_popularity) WHERE track_rank <= 10")))(
    lambda spark, d: top_k_dense(star_for(spark, d, voted=False).fact_track_popularity, ["popularity"], 10, "track_rank"))
register("dense_rank_global", W(O.Q6_CTES + O._final(
    "SELECT album_name, artists, genres, band AS album_category, num_songs, "
    "CAST(score AS DOUBLE) AS avg_popularity_score, place AS album_rank FROM albums")))(
    lambda spark, d: Q.albums_ranked(star_for(spark, d)).select(
        "album_name", "artists", "genres", "album_category", "num_songs",
        F.col("avg_popularity_score").cast("double").alias("avg_popularity_score"), "album_rank"))

# --- profiling -------------------------------------------------------------------------------

register("profile_shape", W(f"SELECT count(*) AS n_rows, CAST({len(S.DATA_COLS)} AS BIGINT) AS n_cols FROM raw"))(
    lambda spark, d: P.shape(raw_tracks(spark, d)))


def _nulls_sql(src: str) -> str:
    parts = [f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM {src}"
             for c in S.DATA_COLS]
    return O._final(" UNION ALL ".join(parts))


register("profile_shape_dedup", W(f"SELECT count(*) AS n_rows, CAST({len(S.DATA_COLS)} AS BIGINT) AS n_cols FROM dedup"))(
    lambda spark, d: P.shape(_dedup(spark, d)))
_TYPE_NAMES = {f.name: f.dataType.simpleString() for f in S.RAW_SCHEMA.fields}
_DUCK_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "BOOLEAN": "boolean", "VARCHAR": "string"}


def _dtypes_sql() -> str:
    declared = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in _DUCK_TYPES.items())
    parts = []
    for c in S.DATA_COLS:
        text = f"CAST({c} AS VARCHAR)"
        fits = " ".join(f"WHEN bool_and(regexp_matches({text}, '{p}')) THEN '{name}'" for name, p in P._TEXT_TYPES.items())
        parts.append(f"SELECT '{c}' AS column_name, CASE any_value(typeof({c})) {declared} END AS data_type, "
                     f"CASE WHEN count({c}) = 0 THEN 'void' {fits} ELSE 'string' END AS inferred_type, count({c}) AS n_values "
                     f"FROM raw WHERE {c} IS NOT NULL")
    return O._final(" UNION ALL ".join(parts))


register("profile_dtypes", W(_dtypes_sql()))(lambda spark, d: P.dtypes(raw_tracks(spark, d)))


def _lookup_track(spark: SparkSession, d: str) -> DataFrame:
    """The rows of the smallest track id that has a genre, with features,
    genre list (one row per genre) and primary genre."""
    star = star_for(spark, d)
    first = star.clean.where(F.col("track_genre").isNotNull()).select(F.min("track_id")).scalar()
    voted = star.tracks.where(F.col("track_id") == first)
    listed = star.clean.where(F.col("track_id") == first).select("track_id", "track_genre").distinct()
    return voted.select("track_id", "track_name", "popularity", "primary_genre", *S.AUDIO_FEATURES).join(listed, "track_id")


register("lookup_track", W(O._final(
    "SELECT v.track_id, v.track_name, v.popularity, v.primary_genre, " + ", ".join(f"v.{c}" for c in S.AUDIO_FEATURES)
    + ", g.track_genre FROM tracks_g v JOIN (SELECT DISTINCT track_id, track_genre FROM clean) g USING (track_id) "
    "WHERE track_id = (SELECT min(track_id) FROM clean WHERE track_genre IS NOT NULL)")))(_lookup_track)

register("profile_nulls", W(_nulls_sql("raw")))(lambda spark, d: P.null_counts(raw_tracks(spark, d)))
register("profile_nulls_clean", W(_nulls_sql("named_rows")))(lambda spark, d: P.null_counts(_named(spark, d)))
register("value_counts_time_signature_raw", W(
    'SELECT time_signature, count(*) AS "count" FROM dedup WHERE time_signature IS NOT NULL '
    'GROUP BY time_signature ORDER BY "count" DESC'))(
    lambda spark, d: P.value_counts(_dedup(spark, d), "time_signature"))
register("value_counts_time_signature", W(
    'SELECT time_signature, count(*) AS "count" FROM clean WHERE time_signature IS NOT NULL '
    'GROUP BY time_signature ORDER BY "count" DESC'))(
    lambda spark, d: P.value_counts(_clean(spark, d), "time_signature"))
register("distinct_sorted_key", W("SELECT DISTINCT key FROM clean ORDER BY key"))(
    lambda spark, d: P.distinct_sorted(_clean(spark, d), "key"))
register("distinct_sorted_mode", W("SELECT DISTINCT mode FROM clean ORDER BY mode"))(
    lambda spark, d: P.distinct_sorted(_clean(spark, d), "mode"))
register("head_rows", W("SELECT * FROM clean ORDER BY row_no, track_genre, track_id LIMIT 10"))(
    lambda spark, d: P.head(_clean(spark, d), 10))
def _head_tracks(spark, d, n=5):
    """First track rows (genre dropped, deduplicated) in order of first
    appearance, with key signature, listed genres and primary genre.  Only the
    tracks of these ``n`` rows are voted on."""
    star = star_for(spark, d)
    clean = star.clean
    first = checkpoint(clean.groupBy(*S.TRACK_COLS).agg(F.min("row_no").alias("first_row"))
                       .orderBy("first_row", "track_id").limit(n), "head")
    of_head = clean.join(F.broadcast(first.select("track_id").distinct()), "track_id", "left_semi")  # n rows at most
    listed = (G.genre_candidates(of_head).where(F.col("track_genre").isNotNull()).groupBy("track_id")
              .agg(F.sort_array(F.collect_list(F.struct("pos", "track_genre"))).alias("g"))  # distinct genres of n tracks
              .select("track_id", F.array_join("g.track_genre", ", ").alias("genres")))
    voted = G.assign_primary_genre(first, of_head, star.profile)
    return C.with_key_signature(voted).join(listed, "track_id", "left").select(
        *S.TRACK_COLS, "first_row", "key_signature", "genres", "primary_genre")


_tc = ", ".join(S.TRACK_COLS)
_same_row = " AND ".join(f"h.{c} IS NOT DISTINCT FROM t.{c}" for c in S.TRACK_COLS)
register("head_tracks", W(O._final(
    f"SELECT t.*, h.first_row, h.key_signature, g.genres FROM (SELECT {_tc}, min(row_no) AS first_row, "
    f"{O._key_signature_sql()} AS key_signature FROM clean GROUP BY {_tc} ORDER BY first_row, track_id LIMIT 5) h "
    f"JOIN tracks_g t ON {_same_row} LEFT JOIN (SELECT track_id, string_agg(track_genre, ', ' ORDER BY pos, track_genre) AS genres "
    "FROM cands WHERE track_genre IS NOT NULL GROUP BY track_id) g ON g.track_id = t.track_id")))(_head_tracks)
register("describe_popularity", W(O._final(
    f"SELECT count(popularity) AS count, round(avg(popularity), {_R}) AS mean, "
    f"round(stddev_samp(popularity), {_R}) AS std, CAST(min(popularity) AS DOUBLE) AS min, "
    "quantile_cont(popularity, 0.25) AS q25, quantile_cont(popularity, 0.5) AS q50, "
    "quantile_cont(popularity, 0.75) AS q75, CAST(max(popularity) AS DOUBLE) AS max "
    "FROM fact_track_popularity")))(
    lambda spark, d: _round_doubles(P.describe(star_for(spark, d, voted=False).fact_track_popularity, "popularity"),
                                    ["mean", "std"]))

# --- statistics -----------------------------------------------------------------------------------


def _corr_sql() -> str:
    parts = []
    for a in S.AUDIO_FEATURES:
        for b in S.AUDIO_FEATURES:
            if a == b:
                parts.append(f"SELECT '{a}' AS feature_x, '{b}' AS feature_y, 1.0::DOUBLE AS r")
            else:
                parts.append(f"SELECT '{a}' AS feature_x, '{b}' AS feature_y, "
                             f"round(corr({a}, {b}), {_R}) AS r FROM dim_tracks")
    return O._final(" UNION ALL ".join(parts))


register("feature_correlation", W(_corr_sql()))(
    lambda spark, d: _round_doubles(ST.correlation_matrix(star_for(spark, d, voted=False).dim_tracks_unvoted, S.AUDIO_FEATURES), ["r"]))

_HIST = """
hv AS (SELECT CAST(popularity AS DOUBLE) AS x FROM fact_track_popularity),
hs AS (SELECT CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
              CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM hv),
hp AS (SELECT lo, hi, (hi - lo) / 30.0::DOUBLE AS step, 30.0::DOUBLE / (hi - lo) AS norm FROM hs),
h0 AS (SELECT x, lo, hi, step, LEAST(CAST(trunc((x - lo) * norm) AS BIGINT), 29) AS b FROM hv, hp),
h1 AS (SELECT x, lo, hi, step, CASE WHEN x < (CASE WHEN b = 30 THEN hi ELSE CAST(b AS DOUBLE) * step + lo END)
                                    THEN b - 1 ELSE b END AS b FROM h0),
h2 AS (SELECT CASE WHEN x >= (CASE WHEN b + 1 = 30 THEN hi ELSE CAST(b + 1 AS DOUBLE) * step + lo END) AND b <> 29
                   THEN b + 1 ELSE b END AS b FROM h1),
hc AS (SELECT b, count(*) AS n FROM h2 GROUP BY b),
"""
register("histogram_popularity", W(_HIST + O._final(
    "SELECT g.range AS bin, CASE WHEN g.range = 30 THEN hi ELSE CAST(g.range AS DOUBLE) * step + lo END AS bin_start, "
    "CASE WHEN g.range + 1 = 30 THEN hi ELSE CAST(g.range + 1 AS DOUBLE) * step + lo END AS bin_end, "
    "coalesce(hc.n, 0) AS count FROM range(30) g CROSS JOIN hp LEFT JOIN hc ON hc.b = g.range")))(
    lambda spark, d: ST.histogram(star_for(spark, d, voted=False).fact_track_popularity, "popularity", 30))

_KDE = f"""
kf AS (SELECT CAST(popularity AS DOUBLE) AS v, count(*) AS n FROM fact_track_popularity GROUP BY popularity),
ks AS (SELECT CAST(sum(n) AS DOUBLE) AS nt, min(v) AS mn, max(v) AS mx, sum(v * n) AS s1, sum(v * v * n) AS s2 FROM kf),
kb AS (SELECT nt, mn, mx, sqrt((s2 - s1 * s1 / nt) / (nt - 1)) * pow(nt, -0.2) AS h,
              (mx - mn) / 199.0::DOUBLE AS step FROM ks),
kg AS (SELECT g.range AS gi, CASE WHEN g.range = 199 THEN mx ELSE CAST(g.range AS DOUBLE) * step + mn END AS x,
              nt, h FROM range(200) g CROSS JOIN kb),
"""
register("kde_popularity", W(_KDE + O._final(
    f"SELECT gi AS grid_index, round(x, {_R}) AS x, "
    f"round(sum(n * exp(-0.5 * pow((x - v) / h, 2))) / (any_value(nt) * any_value(h) * sqrt(2 * pi())), {_R}) AS density "
    "FROM kg CROSS JOIN kf GROUP BY gi, x")))(
    lambda spark, d: _round_doubles(ST.kde(star_for(spark, d, voted=False).fact_track_popularity, "popularity", 200),
                                    ["x", "density"]))

_BOX = """
bf AS (SELECT CAST(popularity AS DOUBLE) AS v, count(*) AS n FROM fact_track_popularity GROUP BY popularity),
bq AS (SELECT quantile_cont(popularity, 0.25) AS q1, quantile_cont(popularity, 0.5) AS median,
              quantile_cont(popularity, 0.75) AS q3 FROM fact_track_popularity),
bw AS (SELECT sum(v * n) / sum(n) AS mean,
              coalesce(min(CASE WHEN v >= q1 - 1.5 * (q3 - q1) THEN v END), q1) AS whisker_low,
              coalesce(max(CASE WHEN v <= q3 + 1.5 * (q3 - q1) THEN v END), q3) AS whisker_high
       FROM bf CROSS JOIN bq GROUP BY q1, q3),
"""
register("boxplot_popularity", W(_BOX + O._final(
    f"SELECT round(mean, {_R}) AS mean, q1, median, q3, q3 - q1 AS iqr, whisker_low, whisker_high, "
    "(SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM bf WHERE v < whisker_low OR v > whisker_high) AS n_outliers "
    "FROM bw CROSS JOIN bq")))(
    lambda spark, d: _round_doubles(ST.boxplot_stats(star_for(spark, d, voted=False).fact_track_popularity, "popularity"),
                                    ["mean"]))
register("boxplot_outliers", W(_BOX + O._final(
    "SELECT f.track_id, f.popularity FROM fact_track_popularity f CROSS JOIN bw "
    "WHERE f.popularity < whisker_low OR f.popularity > whisker_high")))(
    lambda spark, d: ST.boxplot_outliers(star_for(spark, d, voted=False).fact_track_popularity, "popularity"))

# --- sources and sinks ---------------------------------------------------------------------------


def _scan_csv(spark: SparkSession, d: str) -> DataFrame:
    """Raw table written as CSV in the source layout, read back with the
    fixed schema and the pandas missing-value rules."""
    path = shared_output_dir(spark, "csv")
    write_tracks_csv(raw_tracks(spark, d), path)
    return read_tracks_csv(spark, path)


register("scan_csv", W("SELECT * FROM raw"))(_scan_csv)


def _scan_table(spark: SparkSession, d: str) -> DataFrame:
    star = star_for(spark, d, voted=False)
    return spark.sql("SELECT track_id, popularity FROM {fact}", fact=star.fact_track_popularity)


register("scan_table", W("SELECT track_id, popularity FROM fact_track_popularity"))(_scan_table)



def _counts_sql(names: list[str]) -> str:
    return O._final(" UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in names))


_DOUBLES = {f.name for f in S.RAW_SCHEMA.fields if f.dataType.simpleString() == "double"}
_TABLE_COLUMNS = {"dim_artists": ["artist_id", "artist_name"], "dim_albums": ["album_id", "album_name"], "dim_tracks": S.DIM_TRACK_COLS,
                  "dim_genre": S.GENRE_FEATURE_COLS, "artist_track_mapping": ["artist_id", "track_id"],
                  "fact_track_popularity": ["track_id", "popularity"]}


def _sink_tables(spark: SparkSession, d: str) -> DataFrame:
    """The six tables committed together over a former version, and read back
    through the manifest: their rows and a sum of their contents."""
    star = star_for(spark, d)
    base = shared_output_dir(spark, "published")
    for _ in range(2):
        with new_version(spark, base) as version:
            version.write(star.table_builders())
    return contents(read_published(spark, base, S.STAR_TABLES))


register("sink_tables", W(O._final(" UNION ALL ".join(
    f"SELECT '{n}' AS table_name, * FROM ({O.content(n, cols, _DOUBLES)})" for n, cols in _TABLE_COLUMNS.items()))))(_sink_tables)


def _load_audit(spark: SparkSession, d: str) -> DataFrame:
    from cadenza.plans.load import load_star
    _, audit, _ = load_star(spark, raw_tracks(spark, d))
    return audit_frame(spark, audit)


register("load_audit", W(_counts_sql(S.STAR_TABLES)))(_load_audit)


_ANSWERS = {
    "pop_scores": (O.Q1, ["track_name", "primary_genre", "artist_names", "popularity", "track_rank"]),
    "track_vs_pop": (O.Q2, ["track_id", "mins", "avg_popularity"]),
    "top_10_artists": (O.Q3, ["artist_name", "num_songs", "avg_popularity_score", "artist_rank"]),
    "album_cat_dist": (O.Q4, ["album_category", "num_albums", "avg_pop_score"]),
    "key_signature_dist": (O.Q5, ["key_signature", "avg_popularity"]),
    "top_10_albums": (O.Q6, ["album_name", "artists", "album_category", "genres", "overall_rank", "num_songs", "avg_pop_score"])}
_ANSWER_DOUBLES = {"mins", "avg_popularity", "avg_popularity_score", "avg_pop_score"}


def _sink_export(spark: SparkSession, d: str) -> DataFrame:
    """The six answers exported as CSV and read back: their rows and a sum of their contents."""
    from cadenza.plans.load import ANSWER_NAMES
    star = star_for(spark, d)
    base = shared_output_dir(spark, "export")
    frames = {name: fn(star) for name, fn in ANSWER_NAMES.items()}
    with new_version(spark, base) as version:
        version.write(frames, "csv", "answers")
    return contents(read_published(spark, base, schemas={name: df.schema for name, df in frames.items()}))


def _sink_export_sql() -> str:
    # the answers share CTE names; each runs as a subquery with its own WITH list
    parts = [f"SELECT '{name}' AS table_name, * FROM ({O.content(f'(WITH {q.strip()})', cols, _ANSWER_DOUBLES)})"
             for name, (q, cols) in _ANSWERS.items()]
    return "WITH " + O.chain() + "\n" + " UNION ALL ".join(parts)


register("sink_export", _sink_export_sql())(_sink_export)


# --- operators that otherwise only appear inside a larger query ------------------------

def _join_surrogate(spark: SparkSession, d: str) -> DataFrame:
    """Album names of the track dimension replaced by their ids (null-safe)."""
    from cadenza.operators.star import dim_albums, dim_tracks_named, lookup_id
    named = dim_tracks_named(star_for(spark, d).tracks).select("track_id", "album_name")
    return lookup_id(named, dim_albums(named), "album_name", "album_id")


register("join_surrogate_nullsafe", W(
    "SELECT n.track_id, n.album_name, a.album_id FROM named n "
    "JOIN dim_albums a ON n.album_name IS NOT DISTINCT FROM a.album_name"))(_join_surrogate)

register("string_agg_distinct", W(O.Q6_CTES + O._final(
    "SELECT album_id, album_name, artists, genres FROM albums")))(
    lambda spark, d: Q.album_popularity_by_id(star_for(spark, d)).select(
        "album_id", "album_name", "artists", "genres"))


# --- the questions as Spark SQL text over the registered views --------------------------

def _sql_question(name: str):
    from cadenza.plans import sql_questions
    voted = "dim_tracks" in sql_questions.SQL[name][0]  # a view of it holds the genre
    return lambda spark, d: sql_questions.run(spark, star_for(spark, d, voted=voted), name)


for _key, _oracle in (("q1_top_tracks", O.Q1), ("q2_duration_popularity_named", O.Q2_NAMED),
                      ("q3_top_artists", O.Q3), ("q4_album_categories", O.Q4),
                      ("q5_key_popularity", O.Q5), ("q6_top_albums", O.Q6)):
    register(f"sql_text_{_key.split('_')[0]}", W(_oracle))(_sql_question(_key))


# --- the questions on plain names of a database of the catalog ---------------------------

def _database_question(name: str):
    def run(spark: SparkSession, d: str) -> DataFrame:
        import uuid

        from cadenza.plans import sql_questions
        from cadenza.sources.database import create_database
        database = f"cadenza_{uuid.uuid4().hex}"
        create_database(star_for(spark, d), database)
        return sql_questions.run_in_database(spark, database, name)
    return run


for _key, _oracle in (("q1_top_tracks", O.Q1), ("q6_top_albums", O.Q6)):
    register(f"sql_database_{_key.split('_')[0]}", W(_oracle))(_database_question(_key))
