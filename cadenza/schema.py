"""Schemas, column lists and the fixed values the results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw input: one row per (track, genre).  ``row_no`` is the file position
# (the unnamed index column of the source CSV); it orders rows but is not
# part of row equality.
RAW_SCHEMA = T.StructType([
    T.StructField("row_no", T.LongType()),
    T.StructField("track_id", T.StringType()),
    T.StructField("artists", T.StringType()),
    T.StructField("album_name", T.StringType()),
    T.StructField("track_name", T.StringType()),
    T.StructField("popularity", T.IntegerType()),
    T.StructField("duration_ms", T.LongType()),
    T.StructField("explicit", T.BooleanType()),
    T.StructField("danceability", T.DoubleType()),
    T.StructField("energy", T.DoubleType()),
    T.StructField("key", T.IntegerType()),
    T.StructField("loudness", T.DoubleType()),
    T.StructField("mode", T.IntegerType()),
    T.StructField("speechiness", T.DoubleType()),
    T.StructField("acousticness", T.DoubleType()),
    T.StructField("instrumentalness", T.DoubleType()),
    T.StructField("liveness", T.DoubleType()),
    T.StructField("valence", T.DoubleType()),
    T.StructField("tempo", T.DoubleType()),
    T.StructField("time_signature", T.IntegerType()),
    T.StructField("track_genre", T.StringType()),
])

ROW_NO = "row_no"
DATA_COLS = [f.name for f in RAW_SCHEMA.fields if f.name != ROW_NO]
STRING_COLS = ["track_id", "artists", "album_name", "track_name", "track_genre"]
TRACK_COLS = [c for c in DATA_COLS if c != "track_genre"]
# Raw rows are dealt out by these.  No doubles (grouping rewrites them, and Spark would deal the rows
# out again) and not the time signature, which cleaning changes.
DEAL_COLS = ["track_id", "artists", "album_name", "track_name", "popularity", "duration_ms",
             "explicit", "key", "mode"]

# Features that define a genre and the ones compared by cosine similarity.
GENRE_FEATURE_COLS = ["track_genre", "time_signature", "energy", "speechiness",
                      "acousticness", "tempo"]
SIMILARITY_COLS = ["energy", "speechiness", "acousticness", "tempo"]

AUDIO_FEATURES = ["danceability", "energy", "loudness", "speechiness", "acousticness",
                  "instrumentalness", "liveness", "valence", "tempo"]

# Columns of dim_tracks before the album name is replaced by its id.
DIM_TRACK_COLS_NAMED = [
    "track_id", "track_name", "album_name", "primary_genre", "duration_ms", "explicit",
    "key_signature", "time_signature", "danceability", "energy", "key", "loudness", "mode",
    "speechiness", "acousticness", "instrumentalness", "liveness", "valence", "tempo",
]
DIM_TRACK_COLS = [("album_id" if c == "album_name" else c) for c in DIM_TRACK_COLS_NAMED]

STAR_TABLES = ["dim_artists", "dim_albums", "dim_tracks", "dim_genre",
               "artist_track_mapping", "fact_track_popularity"]

# ---------------------------------------------------------------------------
# These must equal the reference's for the results to match.
# ---------------------------------------------------------------------------

# Pitch class number -> note name; -1 (no key detected) has no entry.
KEY_NAMES = {0: "C", 1: "C#/Db", 2: "D", 3: "D#/Eb", 4: "E", 5: "F", 6: "F#/Gb",
             7: "G", 8: "G#/Ab", 9: "A", 10: "A#/Bb", 11: "B"}
MINOR_SUFFIX = " Minor"
MAJOR_SUFFIX = " Major"

# Album category by number of songs: (lowest, highest, name); anything
# beyond the last band is a compilation.
ALBUM_BANDS = [(1, 1, "Single"), (2, 7, "EP"), (8, 15, "Standard Album"),
               (16, 20, "Deluxe Album"), (21, 30, "Double Album")]
ALBUM_OTHER = "Compilations"

# Time-signature cleaning: 0 is undefined and dropped; 1 means common time.
DROP_TIME_SIGNATURE = 0
REPLACE_TIME_SIGNATURE = {1: 4}

# Text the pandas CSV reader treats as missing by default.
MISSING_MARKERS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                   "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
                   "n/a", "nan", "null"]

# Separator of several artists in one field, and of GROUP_CONCAT output.
ARTIST_SEPARATOR = ";"
CONCAT_SEPARATOR = ", "

# Similarities are compared at this many decimals so that float noise from
# summation order cannot reorder near-equal genres; ties go to list order.
SIMILARITY_DECIMALS = 12
