"""The full load job: raw -> clean -> primary genre -> star schema -> tables,
answers to the six questions -> export.  Returns the load audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cadenza.operators.star import Star, build_star
from cadenza.schema import STAR_TABLES
from cadenza.plans import questions as Q
from cadenza.session import stage_scope
from cadenza.sources.published import KEEP, new_version, read_published
from cadenza.sources.sinks import audit_frame, export_all, shared_output_dir, write_tables

# Output names of the answers (one sheet each in the reference's workbook).
ANSWER_NAMES = {
    "pop_scores": Q.q1_top_tracks,
    "track_vs_pop": Q.q2_duration_popularity,
    "top_10_artists": Q.q3_top_artists,
    "album_cat_dist": Q.q4_album_categories,
    "key_signature_dist": Q.q5_key_popularity,
    "top_10_albums": Q.q6_top_albums,
}


def load_star(spark: SparkSession, raw: DataFrame, out_dir: str | None = None,
              match_time_signature: bool = False) -> tuple[Star, dict[str, int], str]:
    """Build and write the six tables; the returned Star reads the written
    files, so later questions start from durable data, not from lineage."""
    out_dir = out_dir or shared_output_dir(spark, "star")
    star = build_star(raw, match_time_signature=match_time_signature)
    audit = write_tables(star.table_builders(), out_dir)
    tables = {name: spark.read.parquet(f"{out_dir}/{name}") for name in STAR_TABLES}
    written = Star(clean=star.clean, tracks=star.tracks, profile=star.profile, **tables)
    return written, audit, out_dir


def run_load(spark: SparkSession, raw: DataFrame, out_dir: str | None = None,
             export_format: str = "csv") -> DataFrame:
    """Whole job; returns the audit of every table and answer written.

    The intermediate stage tables (cleaned rows, voted tracks, id tables)
    are removed from the shared folder once everything is written.
    """
    with stage_scope(spark):
        star, audit, out_dir = load_star(spark, raw, out_dir)
        answers = {name: (lambda f=fn: f(star)) for name, fn in ANSWER_NAMES.items()}
        audit.update({f"answer:{k}": v
                      for k, v in export_all(answers, f"{out_dir}/answers", export_format).items()})
    return audit_frame(spark, audit)


def publish_load(spark: SparkSession, raw: DataFrame, base: str, export_format: str = "csv", keep: int = KEEP,
                 match_time_signature: bool = False) -> DataFrame:
    """The whole job as one commit under ``base``: readers see the six tables
    and the answers of this load together, or those of the former one.  A load
    that fails leaves nothing behind.  Returns the audit."""
    with stage_scope(spark), new_version(spark, base, keep) as version:
        star, audit, _ = load_star(spark, raw, version.folder, match_time_signature)
        version.add(audit)
        answers = version.write({name: (lambda f=fn: f(star)) for name, fn in ANSWER_NAMES.items()}, export_format, "answers")
    return audit_frame(spark, audit | {f"answer:{k}": n for k, n in answers.items()})


def published_star(spark: SparkSession, base: str, version: int | None = None) -> Star:
    """The star over the published tables (the newest version)."""
    return Star(clean=None, tracks=None, profile=None, **read_published(spark, base, STAR_TABLES, version))
