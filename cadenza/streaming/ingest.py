"""Incremental ingestion of raw track files.

The reference job starts from a freshly downloaded CSV.  Here new CSV drops
in a landing folder are picked up by a Structured Streaming file source, line
by line; each micro-batch is put together and parsed by the rules of the batch
reader (columns by header name, quoted line breaks, missing-value markers, bad
records refused or reported), is appended to a parquet raw table
and, when asked, the star schema is rebuilt from the whole raw table, or the
tables of :mod:`cadenza.streaming.incremental` take in the new rows alone.
The stream's checkpoint lives in the shared folder, so a restarted job
resumes without reading a file twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cadenza.sources.csv import first_header, lines, number_lines, parse_records, records


def raw_line_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of the lines of CSV files dropped into ``landing_dir``."""
    reader = spark.readStream.option("lineSep", "\n")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return lines(reader.text(landing_dir))


def parse_batch(batch: DataFrame, pandas_missing: bool = True, on_bad: str = "fail") -> DataFrame | None:
    """The raw rows of a micro-batch of lines; files come whole, with one header."""
    found = records(number_lines(batch))
    header = first_header(found)
    return None if header is None else parse_records(found, header, pandas_missing, on_bad)


def ingest(spark: SparkSession, landing_dir: str, raw_table_dir: str,
           checkpoint_location: str, on_update: Callable[[DataFrame], None] | None = None,
           available_now: bool = True, on_bad: str = "fail", max_files_per_trigger: int | None = None,
           on_batch: Callable[[DataFrame, str], object] | None = None):
    """Append new drops to ``raw_table_dir``; call ``on_update(raw_table)``
    after each non-empty micro-batch (e.g. to rebuild and write the star), and
    ``on_batch(rows, name)`` with its rows alone (e.g. ``IncrementalStar.apply``).

    With ``available_now`` the query processes what has landed and stops
    (a scheduled batch run); otherwise it keeps running.
    """
    def take(batch: DataFrame, batch_id: int) -> None:
        rows = parse_batch(batch, on_bad=on_bad)
        if rows is None:
            return
        # a batch that is run again replaces its own folder
        written = f"{raw_table_dir}/batch={batch_id}"
        rows.write.mode("overwrite").parquet(written)
        if on_batch is not None:
            on_batch(spark.read.parquet(written), f"batch={batch_id}")
        if on_update is not None:
            on_update(spark.read.parquet(raw_table_dir).drop("batch"))

    writer = (raw_line_stream(spark, landing_dir, max_files_per_trigger).writeStream
              .foreachBatch(take)
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    query = writer.start()
    if available_now:
        query.awaitTermination()
    return query
