import os

from cadenza.plans.load import run_load
from cadenza.schema import STAR_TABLES
from cadenza.sources.fixture import raw_tracks


def test_run_load_writes_tables_answers_and_cleans_stages(spark, tmp_path):
    out = str(tmp_path / "out")
    ck = spark.sparkContext.getCheckpointDir().replace("file:", "")
    stages_on_disk = lambda: {d for d in os.listdir(ck) if d.startswith("cadenza-")}
    disk_before = stages_on_disk()
    audit = {r.table_name: r.row_count for r in run_load(spark, raw_tracks(spark, "/root/testdata/sf0.001"), out).collect()}
    for t in STAR_TABLES:
        assert audit[t] == spark.read.parquet(f"{out}/{t}").count()
    assert audit["answer:top_10_albums"] == 10
    assert os.path.isdir(f"{out}/answers/pop_scores")
    assert stages_on_disk() == disk_before          # stage tables were deleted


def test_command_line_load(spark, tmp_path, capsys):
    from cadenza.__main__ import main
    main(["load", "--tables", "/root/testdata/sf0.001", "--out", str(tmp_path / "cli")])
    printed = capsys.readouterr().out
    assert "dim_tracks: " in printed and "rows written" in printed
    assert spark.read.parquet(str(tmp_path / "cli" / "fact_track_popularity")).count() > 0


def test_scopes_of_two_threads_do_not_touch_each_other(spark):
    import threading
    from cadenza.session import checkpoint, stage_scope
    inside, done, kept = threading.Event(), threading.Event(), []

    def other():
        inside.wait(60)
        kept.append(checkpoint(spark.range(5), "other"))
        done.set()

    t = threading.Thread(target=other)
    t.start()
    with stage_scope(spark):
        checkpoint(spark.range(3), "mine")
        inside.set()
        done.wait(60)
    t.join()
    assert kept[0].count() == 5


def test_export_reads_back_with_doubled_quotes(spark, tmp_path):
    import csv
    import glob
    from cadenza.sources.sinks import export_all
    rows = [('He said "hi", ok', 1), ("two\nlines", 2)]
    export_all({"t": spark.createDataFrame(rows, "a string, n int").coalesce(1)}, str(tmp_path))
    with open(glob.glob(str(tmp_path / "t" / "part-*.csv"))[0], newline="") as f:
        assert list(csv.reader(f)) == [["a", "n"], *[[a, str(n)] for a, n in rows]]


def test_scan_maps_columns_by_name_and_reports_bad_records(spark, tmp_path):
    import pytest
    from cadenza.schema import RAW_SCHEMA
    from cadenza.sources.csv import read_tracks_csv
    names = [f.name for f in RAW_SCHEMA.fields]
    swapped = list(names)
    i, j = names.index("artists"), names.index("album_name")
    swapped[i], swapped[j] = swapped[j], swapped[i]
    base = {n: "1" for n in names} | {"artists": "A", "album_name": '"Al\nbum"', "explicit": "False", "popularity": "NA"}
    def write(name, header, rows):
        p = tmp_path / name
        p.write_text("\n".join(",".join(r) for r in [header, *rows]) + "\n")
        return str(p)
    good = write("good.csv", swapped, [[base[n] for n in swapped]])
    row = read_tracks_csv(spark, good).collect()
    assert [(r.artists, r.album_name, r.popularity) for r in row] == [("A", "Al\nbum", None)]
    broken = write("bad.csv", names, [[(base | {"tempo": "fast"})[n] for n in names]])
    with pytest.raises(Exception, match="malformed CSV record"):
        read_tracks_csv(spark, broken).count()
    assert [r._bad for r in read_tracks_csv(spark, broken, on_bad="report").collect()] == [True]
    with pytest.raises(ValueError, match="missing"):
        read_tracks_csv(spark, write("short.csv", names[:-1], [[base[n] for n in names[:-1]]]))


def test_long_keys_stay_distinct(spark):
    from pyspark.sql import functions as F
    from cadenza.sources.fixture import _pad
    df = spark.createDataFrame([(7,), (123456789,), (123456780,), (1234567890,)], "k long")
    assert [r.p for r in df.select(_pad(F.col("k"), 8).alias("p")).collect()] == [
        "00000007", "123456789", "123456780", "1234567890"]
