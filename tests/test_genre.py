from conftest import raw_row

from cadenza.operators.star import build_star


def _primary(make_raw, rows, match=False):
    star = build_star(make_raw(rows), match_time_signature=match, checkpoint_stages=False)
    return {(r.track_id, r.time_signature): r.primary_genre for r in star.tracks.collect()}


def vec(e, s, a, t):
    return dict(energy=float(e), speech=float(s), acoustic=float(a), tempo=float(t))


def test_single_row_track_keeps_its_genre_without_checks(make_raw):
    out = _primary(make_raw, [raw_row(1, "solo", "jazz", ts=None)])
    assert out == {("solo", None): "jazz"}


def test_tie_goes_to_first_listed_genre(make_raw):
    rows = [raw_row(1, "t", "zzz", **vec(0.1, 0.2, 0.3, 0.4)),
            raw_row(2, "t", "aaa", **vec(0.1, 0.2, 0.3, 0.4))]
    assert _primary(make_raw, rows) == {("t", 4): "zzz"}


def test_literal_reading_uses_lowest_signature_vector(make_raw):
    rows = [
        raw_row(1, "X", "g", ts=3, **vec(1, 0, 0, 0)),
        raw_row(2, "Z", "h", ts=4, **vec(1, 0, 0, 1)),
        raw_row(10, "T", "h", ts=4, **vec(0, 0, 0, 1)),
        raw_row(11, "T", "g", ts=4, **vec(0, 0, 0, 1)),
    ]
    assert _primary(make_raw, rows)[("T", 4)] == "h"
    assert _primary(make_raw, rows, match=True)[("T", 4)] == "g"


def test_only_genres_recorded_with_the_rows_signature_compete(make_raw):
    rows = [raw_row(1, "V", "p", ts=3, **vec(0, 0, 0, 1)),
            raw_row(2, "V", "q", ts=5, **vec(0, 0, 0, 1))]
    assert _primary(make_raw, rows) == {("V", 3): "p", ("V", 5): "q"}


def test_missing_signature_with_several_genres_gives_null(make_raw):
    rows = [raw_row(1, "N", "p", ts=None), raw_row(2, "N", "q", ts=None)]
    assert _primary(make_raw, rows) == {("N", None): None}


def test_zero_vector_falls_back_to_list_order(make_raw):
    rows = [raw_row(1, "O", "b", **vec(0, 0, 0, 0)), raw_row(2, "O", "a", **vec(0, 0, 0, 0)),
            raw_row(3, "P", "a", **vec(1, 1, 1, 1))]
    assert _primary(make_raw, rows)[("O", 4)] == "b"


def test_popularity_mean_half_to_even_over_distinct_rows(make_raw):
    rows = [raw_row(1, "t", "a", popularity=2), raw_row(2, "t", "b", popularity=3),
            raw_row(3, "t", "c", popularity=3),  # same non-genre row as row 2: counted once
            raw_row(4, "u", "a", popularity=4), raw_row(5, "u", "b", popularity=5)]
    star = build_star(make_raw(rows), checkpoint_stages=False)
    got = {r.track_id: r.popularity for r in star.fact_track_popularity.collect()}
    assert got == {"t": 2, "u": 4}   # 2.5 -> 2, 4.5 -> 4


def test_album_join_matches_missing_names(make_raw):
    rows = [raw_row(1, "t", "a", album=None), raw_row(2, "u", "a", album="B"), raw_row(3, "v", "a", album="A")]
    star = build_star(make_raw(rows), checkpoint_stages=False)
    albums = sorted((r.album_id, r.album_name) for r in star.dim_albums.collect())
    assert albums == [(0, None), (1, "A"), (2, "B")]
    assert sorted((r.track_id, r.album_id) for r in star.dim_tracks.collect()) == [("t", 0), ("u", 2), ("v", 1)]


def test_hot_track_votes_once_per_key(make_raw):
    """A track holding most rows (other albums, popularity variants) is voted
    once per (signature, features) key; pairs stay at one per listed genre."""
    from cadenza.operators import genre as G
    from cadenza.operators.clean import clean_tracks, track_rows
    rows = [raw_row(i, "hot", f"g{i % 5}", album=f"A{i}", popularity=i % 100) for i in range(200)]
    rows += [raw_row(1000 + i, f"c{i}", "g0") for i in range(10)]
    clean = clean_tracks(make_raw(rows))
    tracks = track_rows(clean)
    profile = G.genre_profile(clean)
    keys = G.vote_keys(tracks)
    assert tracks.where("track_id = 'hot'").count() == 200
    assert keys.where("track_id = 'hot'").count() == 1
    scored = G.scored_rows(keys, clean, profile)
    assert scored.where("track_id = 'hot'").count() == 5          # one per listed genre
    voted = G.assign_primary_genre(tracks, clean, profile)
    hot = {r.primary_genre for r in voted.where("track_id = 'hot'").collect()}
    assert hot == {"g0"}      # equal vectors: the first listed genre wins, for all 200 rows


def test_vote_is_a_hash_aggregate(spark, make_raw):
    from cadenza.operators import genre as G
    from cadenza.operators.clean import clean_tracks, track_rows
    from cadenza.session import checkpoint
    raw = make_raw([raw_row(i, track_id=f"t{i % 3}", genre=g, energy=0.1 * (i % 3)) for i, g in enumerate(["a", "b", "c", "b", "a", None, "z"])])
    clean = checkpoint(clean_tracks(raw))
    voted = G.assign_primary_genre(checkpoint(track_rows(clean)), clean, checkpoint(G.genre_profile(clean)))
    plan = voted._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    assert voted.count() == clean.select("track_id").distinct().count()


def test_track_rows_and_profile_are_written_once(spark, make_raw, monkeypatch):
    from cadenza import session
    rows = [raw_row(1), raw_row(2, genre="rock"), raw_row(3, track_id="t2", ts=3), raw_row(4, track_id="t3", ts=3, genre="rock")]
    real, labels = session.checkpoint, []
    monkeypatch.setattr(session, "checkpoint", lambda df, label="stage": labels.append(df.columns) or real(df, label))
    star = build_star(make_raw(rows))
    assert len(labels) == 1 and "track_genre" in labels[0]  # the cleaned rows
    assert star.fact_track_popularity.count() == 3 and star.artist_track_mapping.count() == 3
    assert star.dim_tracks.count() == 3 and star.dim_genre.count() == 4
    assert len(labels) == 4  # and the track rows, the profile and the voted rows, once each
    assert star.rows.inputFiles() and star.profile.inputFiles()
    labels.clear()
    bare = build_star(make_raw(rows), keep_clean=False)
    assert not labels and bare.fact_track_popularity.count() == 3 and bare.dim_albums.count() == 1
    assert ["track_genre" in x for x in labels] == [False]
    assert sorted(map(tuple, bare.dim_tracks_unvoted.collect())) == sorted(map(tuple, star.dim_tracks_unvoted.collect()))


def test_top_tracks_alone_are_voted_on(make_raw, monkeypatch):
    """Question 1 votes on its tracks alone; every row of a track counts, and a track without an id is none of them."""
    from cadenza.operators import star as ST
    from cadenza.plans import questions as Q
    from cadenza.schema import STAR_TABLES
    rows = [raw_row(10 * i + j, f"t{i}", g, popularity=i, energy=0.1 * i, artists=f"B;A{i}") for i in range(1, 7) for j, g in enumerate(["x", "y"])]
    rows += [raw_row(100, "t6", "x", popularity=6, album="Other", energy=0.6, artists="B;A6"),
             raw_row(101, "t5", "x", popularity=5, album=None, energy=0.5, artists="B;A5"), raw_row(102, None, "x", popularity=9)]
    real, voted = ST.assign_primary_genre, []
    monkeypatch.setattr(ST, "assign_primary_genre", lambda t, *a: voted.append({r[0] for r in t.select("track_id").collect()}) or real(t, *a))
    got = sorted(map(tuple, Q.q1_top_tracks(build_star(make_raw(rows)), k=2).collect()))
    assert voted == [{"t5", "t6"}]
    whole = build_star(make_raw(rows))
    tables = ST.Star(clean=None, tracks=None, profile=None, **{t: getattr(whole, t) for t in STAR_TABLES})
    assert got == sorted(map(tuple, Q.q1_top_tracks(tables, k=2).collect()))
    assert [(r[0], r[2], r[3]) for r in got] == [("Song", "A5, A5, B, B", 5), ("Song", "A6, A6, B, B", 6)]
