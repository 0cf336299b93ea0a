"""Joint commit of the star's tables, and the star as a database."""

import os
import re

import pytest

from cadenza.plans import questions as Q
from cadenza.plans import sql_questions
from cadenza.plans.load import publish_load, published_star
from cadenza.schema import STAR_TABLES
from cadenza.sources import published as P
from cadenza.sources.database import create_database, star_of, use_database
from cadenza.sources.fixture import raw_tracks
from cadenza.sources.sinks import contents

SF_DIR = "/root/testdata/sf0.001"


def _rows(df):
    return {r.table_name: (r.row_count, r.content_sum) for r in df.collect()}


def test_versions_are_seen_whole_or_not_at_all(spark, tmp_path):
    base = str(tmp_path / "star")
    assert P.manifest(spark, base) is None
    with pytest.raises(FileNotFoundError):
        P.read_published(spark, base)
    with P.new_version(spark, base) as v:
        v.write({"a": spark.range(3), "b": spark.range(30)})
    first = P.read_published(spark, base)
    # killed between two tables: the former version stays, nothing is left behind
    with pytest.raises(KeyboardInterrupt):
        with P.new_version(spark, base) as v:
            v.write({"a": spark.range(4)})
            raise KeyboardInterrupt
    with pytest.raises(Exception, match="boom"):
        with P.new_version(spark, base) as v:
            v.write({"a": spark.range(4), "b": spark.sql("SELECT raise_error('boom') AS id")})
    assert {k: df.count() for k, df in P.read_published(spark, base).items()} == {"a": 3, "b": 30}
    assert len(os.listdir(f"{base}/versions")) == 1 and not [n for n in os.listdir(f"{base}/manifests") if "draft" in n]
    with P.new_version(spark, base) as v:
        v.write({"a": spark.range(5), "b": spark.range(50)})
    # a reader that took the former manifest still reads it
    assert first["b"].count() == 30 and P.read_published(spark, base)["b"].count() == 50
    assert P.read_published(spark, base, ["a"], version=1)["a"].count() == 3
    with P.new_version(spark, base) as v:
        v.write({"a": spark.range(6), "b": spark.range(60)})
    assert P.versions(spark, base) == [2, 3] and len(os.listdir(f"{base}/versions")) == 2


def test_one_of_two_loads_at_once_gets_the_number(spark, tmp_path):
    base = str(tmp_path / "star")
    with pytest.raises(RuntimeError, match="another load"):
        with P.new_version(spark, base) as slow:
            slow.write({"a": spark.range(1)})
            with P.new_version(spark, base) as fast:
                fast.write({"a": spark.range(2)})
    assert P.read_published(spark, base)["a"].count() == 2 and len(os.listdir(f"{base}/versions")) == 1


def test_folders_of_killed_loads_are_deleted_later(spark, tmp_path):
    base = str(tmp_path / "star")
    with P.new_version(spark, base) as v:
        v.write({"a": spark.range(1)})
    left = P.Version(spark, base)
    left.write({"a": spark.range(9)})
    assert P.prune(spark, base) == []
    os.utime(f"{base}/{left.name}", (0, 0))
    assert P.prune(spark, base) == [left.name] and P.read_published(spark, base)["a"].count() == 1


def test_published_load_is_the_star(spark, tmp_path):
    from cadenza.operators.star import build_star
    base = str(tmp_path / "star")
    raw = raw_tracks(spark, SF_DIR)
    audit = {r.table_name: r.row_count for r in publish_load(spark, raw, base).collect()}
    star = published_star(spark, base)
    want = _rows(contents(build_star(raw).tables()))
    assert _rows(contents(star.tables())) == want and all(audit[t] == want[t][0] for t in STAR_TABLES)
    held = P.manifest(spark, base)["tables"]
    assert held["top_10_albums"]["rows"] == audit["answer:top_10_albums"] == 10 and held["top_10_albums"]["format"] == "csv"
    assert Q.q6_top_albums(star).count() == 10


def test_plain_names_and_joins_without_exchange(spark, tmp_path):
    from cadenza.operators.star import build_star
    star = build_star(raw_tracks(spark, SF_DIR))
    before = spark.catalog.currentDatabase()
    create_database(star, "tracks_db", str(tmp_path / "db"), buckets=4)
    with use_database(spark, "tracks_db"):
        assert spark.table("dim_tracks").count() == star.dim_tracks.count()
        assert {t.name for t in spark.catalog.listTables("tracks_db") if not t.isTemporary} == set(STAR_TABLES)
    assert spark.catalog.currentDatabase() == before
    held = star_of(spark, "tracks_db")
    assert sorted(map(tuple, Q.q3_top_artists(held).collect())) == sorted(
        map(tuple, sql_questions.run_in_database(spark, "tracks_db", "q3_top_artists").collect()))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        by_track = held.dim_tracks.join(held.fact_track_popularity, "track_id").join(held.artist_track_mapping, "track_id")
        plan = by_track._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 2 and "Exchange" not in plan
        # in the questions too no table is dealt out by track alone
        for question in (Q.q1_top_tracks, Q.q2_duration_popularity, Q.q5_key_popularity, Q.album_scores):
            plan = question(held)._jdf.queryExecution().executedPlan().toString()
            assert not re.search(r"hashpartitioning\(track_id#\d+, \d+\)", plan) and "SortMergeJoin" in plan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", True)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    create_database(star, "tracks_db", str(tmp_path / "db"), buckets=2)  # replaced
    assert spark.table("tracks_db.fact_track_popularity").count() == star.fact_track_popularity.count()
