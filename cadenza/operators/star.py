"""Star schema: popularity fact, artist/album/track/genre dimensions, bridge."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza import schema as S
from cadenza.functions.columns import half_even_int
from cadenza.operators.clean import clean_tracks, track_rows, with_key_signature
from cadenza.operators.genre import assign_primary_genre, genre_profile
from cadenza.operators.ids import dense_ids


def fact_track_popularity(tracks: DataFrame) -> DataFrame:
    """Mean popularity per track over its distinct rows, half to even, as int."""
    return (tracks.where(F.col("track_id").isNotNull())
            .groupBy("track_id")
            .agg(half_even_int(F.avg("popularity")).alias("popularity")))


def artist_names(tracks: DataFrame) -> DataFrame:
    """(artist_name, track_id): the artist string split on ';', one row per
    name; a missing string gives one null name."""
    return tracks.select(F.explode_outer(F.split("artists", S.ARTIST_SEPARATOR)).alias("artist_name"),
                         "track_id")


def dim_artists(tracks: DataFrame) -> DataFrame:
    names = artist_names(tracks)
    return dense_ids(names, "artist_name", "artist_id").select(
        F.col("artist_id").cast("long").alias("artist_id"), "artist_name")


def lookup_id(df: DataFrame, dim: DataFrame, key: str, id_col: str) -> DataFrame:
    """Attach ``dim``'s id to ``df`` by null-safe equality on ``key`` (a
    missing name matches the dimension's null row).  The dimension's key is
    renamed first, so the join is unambiguous even when ``dim`` was derived
    from ``df`` itself."""
    d = dim.select(F.col(key).alias("_dim_key"), id_col)
    return df.join(d, F.col(key).eqNullSafe(F.col("_dim_key")), "inner").drop("_dim_key")


def artist_track_mapping(tracks: DataFrame, artists: DataFrame) -> DataFrame:
    """Distinct (artist_id, track_id) pairs, null names mapped to id 0."""
    return lookup_id(artist_names(tracks), artists, "artist_name", "artist_id") \
        .select("artist_id", "track_id").distinct()


def dim_albums(dim_tracks_named: DataFrame) -> DataFrame:
    return dense_ids(dim_tracks_named.select("album_name"), "album_name", "album_id").select(
        F.col("album_id").cast("long").alias("album_id"), "album_name")


def dim_tracks_named(tracks_with_genre: DataFrame) -> DataFrame:
    """Distinct track-dimension rows, still with the album name."""
    return with_key_signature(tracks_with_genre).select(*S.DIM_TRACK_COLS_NAMED).distinct()


def dim_tracks(named: DataFrame, albums: DataFrame) -> DataFrame:
    """Replace the album name by its id (a missing name matches the null album)."""
    return lookup_id(named, albums, "album_name", "album_id").select(*S.DIM_TRACK_COLS)


class Star:
    """The six output tables plus the frames they come from.

    Tables are built on first use, so a question that needs only the fact
    table never pays for the dense-id jobs of the artist and album ids.
    """

    def __init__(self, clean: DataFrame, tracks, profile, vote_on=None, rows=None, **tables: DataFrame):
        """``tracks`` is the voted track rows, ``rows`` those before the vote and
        ``profile`` the genre profile, or functions building them (run on first
        use, so cleaning-only questions skip the vote); ``vote_on`` votes on some
        track rows alone."""
        self.clean, self._profile, self._vote_on = clean, profile, vote_on
        self._rows = rows if rows is not None else lambda: track_rows(self.clean)
        self._tables = dict(tables)
        self._tracks = tracks
        self._locks: dict[str, threading.Lock] = {}
        self._guard = threading.Lock()

    @property
    def tracks(self) -> DataFrame:
        """Track rows with their primary genre."""
        return self._get("_tracks", lambda: self._tracks() if callable(self._tracks) else self._tracks)

    @property
    def profile(self) -> DataFrame:
        return self._get("_profile", lambda: self._profile() if callable(self._profile) else self._profile)

    def _get(self, name: str, build):
        # tables may be requested from several writer threads at once; each
        # is built once (the id dimensions run jobs while being defined)
        with self._guard:
            lock = self._locks.setdefault(name, threading.Lock())
        with lock:
            if name not in self._tables:
                self._tables[name] = build()
        return self._tables[name]

    @property
    def rows(self) -> DataFrame:
        """Track rows before the vote: all that the fact, the bridge, the
        artists and the albums need."""
        return self._get("_rows", lambda: self._rows() if callable(self._rows) else self._rows)

    @property
    def dim_tracks_named(self) -> DataFrame:
        return self._get("_named", lambda: dim_tracks_named(self.tracks))

    @property
    def dim_tracks_unvoted(self) -> DataFrame:
        """The track dimension without the genre.  The genre follows from the
        row's other columns, so the row set is that of ``dim_tracks``."""
        if "dim_tracks" in self._tables:
            return self._tables["dim_tracks"].drop("primary_genre")
        return self._get("_unvoted", lambda: lookup_id(
            with_key_signature(self.rows).select(*[c for c in S.DIM_TRACK_COLS_NAMED if c != "primary_genre"]).distinct(),
            self.dim_albums, "album_name", "album_id").select(*[c for c in S.DIM_TRACK_COLS if c != "primary_genre"]))

    def dim_tracks_of(self, albums: DataFrame) -> DataFrame:
        """``dim_tracks`` of the albums whose ``album_id`` is listed once each.
        Where the dimension is not there yet, only their tracks are voted on."""
        if not self.votes_on_some:
            return self.dim_tracks.join(albums, "album_id", "left_semi")
        rows = lookup_id(self.rows, self.dim_albums, "album_name", "album_id").join(albums, "album_id", "left_semi")
        voted = with_key_signature(self._vote_on(rows.drop("album_id")))
        return dim_tracks(voted.select(*S.DIM_TRACK_COLS_NAMED).distinct(), self.dim_albums)

    @property
    def votes_on_some(self) -> bool:
        """The track dimension is not there yet, and some tracks can be voted on alone."""
        return "dim_tracks" not in self._tables and self._vote_on is not None

    def genres_of(self, tracks: DataFrame) -> DataFrame:
        """``(track_id, track_name, primary_genre)`` of every ``dim_tracks`` row of
        the tracks whose ``track_id`` is listed once each, from a vote on these
        alone.  An album's name and its id are one to one, so the rows are counted
        without the id."""
        voted = self._vote_on(self.rows.join(tracks, "track_id", "left_semi"))
        return dim_tracks_named(voted).select("track_id", "track_name", "primary_genre")

    @property
    def dim_albums(self) -> DataFrame:
        return self._get("dim_albums", lambda: dim_albums(self.rows))

    @property
    def dim_artists(self) -> DataFrame:
        return self._get("dim_artists", lambda: dim_artists(self.rows))

    @property
    def dim_tracks(self) -> DataFrame:
        return self._get("dim_tracks", lambda: dim_tracks(self.dim_tracks_named, self.dim_albums))

    @property
    def dim_genre(self) -> DataFrame:
        return self._get("dim_genre", lambda: self.profile.select(*S.GENRE_FEATURE_COLS))

    @property
    def artist_track_mapping(self) -> DataFrame:
        return self._get("artist_track_mapping", lambda: artist_track_mapping(self.rows, self.dim_artists))

    @property
    def fact_track_popularity(self) -> DataFrame:
        return self._get("fact_track_popularity", lambda: fact_track_popularity(self.rows))

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in S.STAR_TABLES}

    def table_builders(self) -> dict:
        """Name -> zero-argument function returning the table (built lazily,
        so writers running in parallel also define the tables in parallel)."""
        return {name: (lambda n=name: getattr(self, n)) for name in S.STAR_TABLES}

    def register(self, prefix: str = "", names=S.STAR_TABLES) -> None:
        """Register tables as temp views under their names; only those in
        ``names`` are built."""
        for name in names:
            getattr(self, name).createOrReplaceTempView(prefix + name)


def build_star(raw: DataFrame, match_time_signature: bool = False, checkpoint_stages: bool = True,
               keep_clean: bool = True) -> Star:
    """Clean, pick primary genres and define all six tables.

    With ``checkpoint_stages`` the cleaned rows (now), the track rows before and
    with their primary genre and the genre profile (each on first use) are
    written once to the shared checkpoint folder.  Every table and the vote read
    those copies, so the scan, the full-row dedup, the distinct track rows and the
    vote run once, and a lost executor re-reads files instead of redoing shuffles.
    Of the written profile Spark knows the size before it plans the vote's joins.
    ``keep_clean=False`` is for what reads the track rows alone (no vote, no
    profile): those are written, the cleaned rows, a multiple of them, are not.
    """
    from cadenza.session import checkpoint

    def stage(df: DataFrame) -> DataFrame:
        return checkpoint(df) if checkpoint_stages else df

    clean = clean_tracks(raw)
    if keep_clean:
        clean = stage(clean)

    def voted_tracks() -> DataFrame:
        return stage(assign_primary_genre(star.rows, clean, star.profile, match_time_signature))

    def vote_on(rows: DataFrame) -> DataFrame:
        wanted = rows.select(F.col("track_id").alias("_wanted")).distinct()
        listed = clean.join(wanted, F.col("track_id") == F.col("_wanted"), "left_semi")
        return assign_primary_genre(rows, listed, star.profile, match_time_signature)

    star = Star(clean=clean, tracks=voted_tracks, rows=lambda: stage(track_rows(clean)),
                profile=lambda: stage(genre_profile(clean)), vote_on=vote_on)
    return star
