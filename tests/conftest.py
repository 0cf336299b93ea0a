import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    builder = (SparkSession.builder.master("local[4]").appName("cadenza-tests")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.driver.memory", "4g")
               .config("spark.sql.session.timeZone", "UTC"))
    spark = builder.getOrCreate()
    # tests set their own checkpoint folder only where the session has none
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cadenza-test-ckpt-"))
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


RAW_COLS = ["row_no", "track_id", "artists", "album_name", "track_name", "popularity", "duration_ms",
            "explicit", "danceability", "energy", "key", "loudness", "mode", "speechiness", "acousticness",
            "instrumentalness", "liveness", "valence", "tempo", "time_signature", "track_genre"]


def raw_row(row_no, track_id="t1", genre="pop", ts=4, popularity=50, artists="A", album="Alb",
            name="Song", energy=0.5, speech=0.1, acoustic=0.2, tempo=120.0, key=0, mode=1, duration=180000):
    return (row_no, track_id, artists, album, name, popularity, duration, False, 0.5, energy, key, -5.0,
            mode, speech, acoustic, 0.0, 0.1, 0.5, tempo, ts, genre)


@pytest.fixture
def make_raw(spark):
    from cadenza.schema import RAW_SCHEMA

    def make(rows):
        return spark.createDataFrame(rows, RAW_SCHEMA)
    return make
