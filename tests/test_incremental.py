"""Tables kept drop by drop against one batch load of everything."""

import os

import pytest
from pyspark.sql import functions as F

from cadenza import schema as S
from cadenza.operators.star import build_star
from cadenza.sources.csv import write_tracks_csv
from cadenza.sources.fixture import raw_tracks
from cadenza.streaming.incremental import IncrementalStar
from cadenza.streaming.ingest import ingest

SF_DIR = "/root/testdata/sf0.001"


def _same(a, b, doubles=()):
    def rows(df):
        df = df.select(*[F.round(c, 9).alias(c) if c in doubles else F.col(c) for c in sorted(df.columns)])
        return sorted(map(str, df.collect()))
    assert rows(a) == rows(b)


@pytest.fixture(scope="module")
def raw(spark):
    path = "/root/testdata/sf0.001"
    return raw_tracks(spark, path)


def _compare(spark, star, base):
    kept = IncrementalStar(spark, base)
    _same(kept.clean().select(*S.DATA_COLS), star.clean.select(*S.DATA_COLS))
    _same(kept.fact_track_popularity(), star.fact_track_popularity)
    _same(kept.genre_profile(), star.dim_genre, S.SIMILARITY_COLS)
    _same(kept.dim_artists(), star.dim_artists)
    _same(kept.dim_albums(), star.dim_albums)


def test_drops_equal_one_batch(spark, raw, tmp_path):
    base = str(tmp_path / "state")
    kept = IncrementalStar(spark, base, buckets=8, ranges=4)
    part = F.pmod(F.xxhash64("track_id"), F.lit(10))
    drops = [raw.where(part < 6), raw.where(part >= 5)]
    for k, drop in enumerate(drops):
        assert kept.apply(drop, f"drop{k}") and not kept.apply(drop, f"drop{k}")
    _compare(spark, build_star(raw), base)
    # a drop of known rows changes nothing; one new name writes one range, and reads few buckets
    before = {r.artist_id: r.artist_name for r in kept.dim_artists().collect()}
    assert kept.apply(drops[0].limit(50), "again") and {r.artist_id: r.artist_name for r in kept.dim_artists().collect()} == before
    assert kept.artists.written == [] and kept.albums.written == []
    one = raw.limit(1).withColumns({"artists": F.lit("AAA first of all"), "track_id": F.lit("only"), "track_name": F.lit("n"), "time_signature": F.lit(4)})
    assert kept.apply(one, "one") and kept.artists.written == [0]
    assert len(kept.rows.read_buckets) <= 1
    got = {r.artist_id: r.artist_name for r in kept.dim_artists().collect()}
    assert got[1] == "AAA first of all" and all(got[i + 1 if i else 0] == n for i, n in before.items())


def test_only_buckets_that_may_know_a_row_are_read(spark, raw, tmp_path):
    kept = IncrementalStar(spark, str(tmp_path / "s"), buckets=8, ranges=2)
    kept.apply(raw.where("row_no % 2 = 0"), "a")
    twin = raw.where("row_no % 2 = 0 AND track_name IS NOT NULL").limit(1)
    kept.apply(twin, "b")
    assert len(kept.rows.read_buckets) == 1
    files = kept.rows.seen().where(F.col("bucket").isin(kept.rows.read_buckets))
    every = kept.rows.seen().groupBy("bucket").count().count()
    assert every > 1 and files.select("bucket").distinct().count() == 1
    # the other buckets' folders are not read
    scan = next(x for x in files._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x)
    assert "PartitionFilters: [isnotnull(bucket" in scan


def test_a_failed_drop_leaves_the_state(spark, raw, tmp_path):
    base = str(tmp_path / "s")
    kept = IncrementalStar(spark, base, buckets=4, ranges=2)
    kept.apply(raw.where("row_no % 3 = 0"), "a")
    files = sorted(os.listdir(f"{base}/drops"))
    broken = raw.withColumn("popularity", F.raise_error(F.lit("boom")).cast("int"))
    with pytest.raises(Exception, match="boom"):
        kept.apply(broken, "b")
    assert sorted(os.listdir(f"{base}/drops")) == files and kept.state["drops"] == ["a"]
    assert kept.apply(raw, "b")
    _compare(spark, build_star(raw), base)


def test_stream_of_drops(spark, raw, tmp_path):
    landing, base = str(tmp_path / "landing"), str(tmp_path / "state")
    kept = IncrementalStar(spark, base, buckets=4, ranges=2)
    for k in range(2):
        write_tracks_csv(raw.where(F.pmod(F.col("row_no"), F.lit(3)) >= k), f"{landing}/drop{k}")
        ingest(spark, landing + "/*", str(tmp_path / "raw"), str(tmp_path / "ckpt"), on_batch=kept.apply)
    assert len(kept.state["drops"]) == 2
    _compare(spark, build_star(raw), base)
