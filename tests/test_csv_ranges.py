"""CSV files read in byte ranges, against Spark's one-task multi-line reader."""

import csv
import io

import numpy as np
import pytest

from cadenza.schema import RAW_SCHEMA
from cadenza.sources import csv as C
from cadenza.streaming.ingest import ingest

NAMES = [f.name for f in RAW_SCHEMA.fields]


def _write(path, n, seed=0, sep="\r\n", header=None):
    rng = np.random.default_rng(seed)
    bits = ["a", "é", "漢", '"', ",", "\n", "\n\n", ";", " ", "x" * 40, '""', "'"]
    buf = io.StringIO(newline="")
    out = csv.writer(buf, lineterminator=sep)
    names = header or ["", *NAMES[1:]]
    out.writerow(names)
    for i in range(n):
        base = {x: "1" for x in NAMES} | {"row_no": str(i), "explicit": "False"}
        for c in ("artists", "album_name", "track_name", "track_genre"):
            base[c] = "v" + "".join(rng.choice(bits, int(rng.integers(0, 9)))) + "e"
        if i % 17 == 3:
            base["track_name"] = "line\n" * 60
        out.writerow([base["row_no" if c == "" else c] for c in names])
        if i % 11 == 5:
            buf.write(sep)
    path.write_bytes(buf.getvalue().encode())
    return str(path)


def _one_task(spark, path):
    names = next(csv.reader(open(path, newline="")))
    names[names.index("")] = "row_no"
    fields = ", ".join(f"`{c}` string" for c in names)
    df = spark.read.options(header=True, quote='"', escape='"', multiLine=True).schema(fields).csv(C._escaped(path))
    return sorted(tuple(r) for r in df.select("row_no", "artists", "album_name", "track_name", "track_genre").collect())


def _ranges(df):
    return sorted(tuple(str(v) if i == 0 else v for i, v in enumerate(r)) for r in
                  df.select("row_no", "artists", "album_name", "track_name", "track_genre").collect())


@pytest.fixture
def split_bytes(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda n: spark.conf.set("spark.sql.files.maxPartitionBytes", n)
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("size,sep", [(300, "\n"), (2_000, "\r\n"), (10_000_000, "\n")])
def test_ranges_read_what_one_task_reads(spark, tmp_path, split_bytes, size, sep):
    path = _write(tmp_path / "tracks.csv", 150, sep=sep)
    want = _one_task(spark, path)
    split_bytes(size)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    tasks = C.read_lines(spark, path).rdd.getNumPartitions()
    assert tasks >= (8 if size < 3_000 else 1)
    assert len(want) == 150 and _ranges(C.read_tracks_csv(spark, path)) == want


def test_several_files_and_other_column_order(spark, tmp_path, split_bytes):
    header = ["", *reversed(NAMES[1:])]
    paths = [_write(tmp_path / f"p [{k}].csv", 40, seed=k, header=header) for k in range(3)]
    want = sorted(r for p in paths for r in _one_task(spark, p))
    split_bytes(500)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    assert _ranges(C.read_tracks_csv(spark, str(tmp_path))) == want
    _write(tmp_path / "q.csv", 3)
    with pytest.raises(Exception, match="another header|malformed"):  # whichever task comes first
        C.read_tracks_csv(spark, str(tmp_path)).count()


def test_quotes_that_do_not_pair_up_are_refused(spark, tmp_path):
    path = _write(tmp_path / "t.csv", 5)
    with open(path, "a") as f:
        f.write('9,"never closed\n')
    with pytest.raises(Exception, match="quotes do not pair up"):
        C.read_tracks_csv(spark, path).count()


def test_lines_as_records(spark, tmp_path):
    path = _write(tmp_path / "t.csv", 0)
    with open(path, "a", newline="") as f:
        f.write("\r\n".join(",".join([str(i), "t", "a", "b", "n", "NA", *["1"] * 15]) for i in range(5)) + "\r\n")
    for multi in (True, False):
        df = C.read_tracks_csv(spark, path, multi_line=multi, on_bad="report")
        assert [(r.track_genre, r.popularity) for r in df.collect()] == [("1", None)] * 5


def test_stream_reads_by_the_same_rules(spark, tmp_path, split_bytes):
    landing = tmp_path / "landing"
    landing.mkdir()
    split_bytes(700)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    want, seen = [], []
    for k, header in enumerate([["", *NAMES[1:]], ["", *reversed(NAMES[1:])]]):
        path = _write(landing / f"drop{k}.csv", 30, seed=k, header=header)
        want += _one_task(spark, path)
        ingest(spark, str(landing), str(tmp_path / "raw"), str(tmp_path / "ckpt"), on_update=lambda df: seen.append(df.count()))
    assert seen == [30, 60]
    assert _ranges(spark.read.parquet(str(tmp_path / "raw"))) == sorted(want)


def test_only_ranges_with_parts_of_records_are_numbered(spark, tmp_path, split_bytes, monkeypatch):
    real, numbered = C._placed, []
    monkeypatch.setattr(C, "_placed", lambda found: numbered.append(found.count()) or real(found))

    def write(name, long_at):
        buf = io.StringIO(newline="")
        out = csv.writer(buf)
        out.writerow(["", *NAMES[1:]])
        for i in range(200):
            row = {x: "1" for x in NAMES} | {"row_no": str(i), "explicit": "False", "track_name": 'a, "b"'}
            if i in long_at:
                row["track_name"] = "two\nlines" if i % 2 else "long\n" * 150
            out.writerow([row[c] for c in NAMES])
        (tmp_path / name).write_bytes(buf.getvalue().encode())
        return str(tmp_path / name)
    split_bytes(600)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    for name, long_at in (("plain.csv", ()), ("some.csv", (51, 120))):
        path = write(name, long_at)
        got = C.read_tracks_csv(spark, path).select("row_no", "track_name").collect()
        names = {i: "two\nlines" if i % 2 else "long\n" * 150 for i in long_at}
        assert sorted(map(tuple, got)) == [(i, names.get(i, 'a, "b"')) for i in range(200)]
    assert numbered[0] == 0 and 150 < numbered[1] < 250  # 200 lines of one record each, 152 of the two longer ones
