from conftest import raw_row

from cadenza.operators.clean import (clean_tracks, dedup_rows, filter_ne_nullsafe, replace_values,
                                     track_rows)
from cadenza.schema import DATA_COLS


def test_null_name_rows_are_dropped(make_raw):
    df = make_raw([raw_row(1), raw_row(2, name=None, genre="rock")])
    out = clean_tracks(df).collect()
    assert [r.row_no for r in out] == [1]


def test_dedup_keeps_first_position_and_ignores_index(make_raw):
    df = make_raw([raw_row(5), raw_row(3), raw_row(9, genre="rock")])
    out = sorted((r.row_no, r.track_genre) for r in dedup_rows(df, DATA_COLS).collect())
    assert out == [(3, "pop"), (9, "rock")]


def test_not_equal_keeps_missing_signature(make_raw):
    df = make_raw([raw_row(1, ts=0), raw_row(2, ts=None, genre="a"), raw_row(3, ts=3, genre="b")])
    out = sorted(r.row_no for r in filter_ne_nullsafe(df, "time_signature", 0).collect())
    assert out == [2, 3]


def test_replace_runs_after_dedup(make_raw):
    # rows differing only in 1 vs 4 are both kept by dedup, then become equal
    df = make_raw([raw_row(1, ts=1), raw_row(2, ts=4)])
    clean = clean_tracks(df).collect()
    assert sorted((r.row_no, r.time_signature) for r in clean) == [(1, 4), (2, 4)]
    # the track rows (genre dropped) collapse to one afterwards
    assert track_rows(clean_tracks(df)).count() == 1


def test_replace_values_only_touches_exact_matches(make_raw):
    df = make_raw([raw_row(1, ts=1), raw_row(2, ts=5), raw_row(3, ts=None)])
    out = sorted((r.row_no, r.time_signature) for r in
                 replace_values(df, "time_signature", {1: 4}).collect())
    assert out == [(1, 4), (2, 5), (3, None)]


def test_missing_markers_in_csv(spark, tmp_path):
    from cadenza.sources.csv import read_tracks_csv
    header = ",track_id,artists,album_name,track_name,popularity,duration_ms,explicit,danceability," \
             "energy,key,loudness,mode,speechiness,acousticness,instrumentalness,liveness,valence,tempo," \
             "time_signature,track_genre\n"
    body = ('0,t1,A,"Alb, ""Deluxe""",None,10,1000,False,0.1,0.2,1,-5.0,1,0.1,0.1,0.0,0.1,0.5,100.0,4,pop\n'
            '1,t2,B,X,"two\nlines",20,2000,True,0.1,0.2,1,-5.0,0,0.1,0.1,0.0,0.1,0.5,100.0,4,rock\n'
            '2,t3,NA,Y,Z,30,3000,False,0.1,0.2,-1,-5.0,1,0.1,0.1,0.0,0.1,0.5,100.0,3,jazz\n')
    p = tmp_path / "tracks.csv"
    p.write_text(header + body)
    rows = sorted(read_tracks_csv(spark, str(p), multi_line=True).collect(), key=lambda r: r.row_no)
    assert len(rows) == 3
    assert rows[0].album_name == 'Alb, "Deluxe"'
    assert rows[0].track_name is None          # 'None' is missing, as in pandas
    assert rows[1].track_name == "two\nlines"
    assert rows[2].artists is None             # 'NA' is missing
    assert rows[1].explicit is True and rows[2].key == -1


def test_rows_are_dealt_out_once(spark, make_raw):
    from cadenza.operators.clean import track_rows
    from cadenza.schema import DEAL_COLS, TRACK_COLS
    rows = [raw_row(3), raw_row(1), raw_row(2, genre="rock"), raw_row(4, genre=None), raw_row(5, ts=1), raw_row(6, ts=0),
            raw_row(7, track_id=None, artists=None, album=None), raw_row(8, track_id=None, artists=None, album=None)]
    raw = make_raw(rows)
    tracks = track_rows(clean_tracks(raw))
    # the rows meet by track columns: neither the full-row groups nor the distinct track rows are dealt out again
    assert tracks._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    cleaned = clean_tracks(raw)
    assert cleaned._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    got = sorted(((r.row_no, r.track_id, r.track_genre, r.time_signature) for r in cleaned.collect()))
    assert got == [(1, "t1", "pop", 4), (2, "t1", "rock", 4), (4, "t1", None, 4), (5, "t1", "pop", 4), (7, None, "pop", 4)]
    assert tracks.count() == 2 and set(DEAL_COLS) < set(TRACK_COLS)
    whole = dedup_rows(raw, DATA_COLS)  # by default the whole row deals
    assert sorted(r.row_no for r in whole.collect()) == sorted(r.row_no for r in dedup_rows(raw, DATA_COLS, deal_by=DEAL_COLS).collect())
