"""The star as a database of the session catalog.

Tables have plain names and are found through the current database, as in the
reference's ``USE``.  The fact, the bridge and the track dimension are
bucketed and sorted by track, with equally many buckets, so joins on the track
need no exchange of any of them.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from cadenza.operators.star import Star
from cadenza.schema import STAR_TABLES
from cadenza.session import shared_dir

#: tables that meet on the track
BY_TRACK = ("dim_tracks", "artist_track_mapping", "fact_track_popularity")
BUCKETS = 16


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def create_database(star: Star, name: str, folder: str | None = None, buckets: int = BUCKETS) -> str:
    """Write the six tables of ``star`` as tables of database ``name``; returns
    their folder.  On a large cluster take as many ``buckets`` as a track join
    should have tasks.  Tables of the same names are replaced."""
    some = star.dim_genre
    spark = some.sparkSession
    folder = folder or shared_dir(spark, "database")
    location = folder.replace("'", "\\'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(name)} LOCATION '{location}'")
    for table in STAR_TABLES:
        write_table(getattr(star, table), name, table, folder, buckets if table in BY_TRACK else None)
    return folder


def write_table(df: DataFrame, database: str, table: str, folder: str, buckets: int | None = None) -> None:
    """One table, bucketed and sorted by track where ``buckets`` is given: a file a bucket."""
    if buckets:
        df = df.repartition(buckets, "track_id")
    writer = df.write.mode("overwrite").format("parquet").option("path", f"{folder}/{table}")
    if buckets:
        writer = writer.bucketBy(buckets, "track_id").sortBy("track_id")
    writer.saveAsTable(f"{_quoted(database)}.{_quoted(table)}")


@contextmanager
def use_database(spark: SparkSession, name: str):
    """Plain table names mean those of ``name`` inside the block."""
    before = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(name)
    try:
        yield
    finally:
        spark.catalog.setCurrentDatabase(before)


def star_of(spark: SparkSession, name: str) -> Star:
    """The star over the tables of a database (its questions read them alone)."""
    tables = {t: spark.table(f"{_quoted(name)}.{_quoted(t)}") for t in STAR_TABLES}
    return Star(clean=None, tracks=None, profile=None, **tables)
