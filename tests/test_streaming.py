from cadenza.sources.csv import write_tracks_csv
from cadenza.sources.fixture import raw_tracks
from cadenza.streaming.ingest import ingest


def test_ingest_appends_new_drops_once(spark, tmp_path):
    landing, table, ckpt = str(tmp_path / "landing"), str(tmp_path / "raw"), str(tmp_path / "ckpt")
    raw = raw_tracks(spark, "/root/testdata/sf0.001")
    write_tracks_csv(raw, landing + "/drop1")
    seen = []
    ingest(spark, landing + "/*", table, ckpt, on_update=lambda df: seen.append(df.count()))
    assert seen == [raw.count()]
    # a second run with nothing new reads nothing again
    ingest(spark, landing + "/*", table, ckpt, on_update=lambda df: seen.append(df.count()))
    assert seen == [raw.count()]
    assert spark.read.parquet(table).count() == raw.count()
