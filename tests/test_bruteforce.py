"""build_star against a plain-Python statement of the same rules on small
random raw tables (hypothesis).  Feature values are multiples of 1/4 so
that sums are exact and both sides compute bit-identical similarities."""

import math
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cadenza.operators.star import build_star
from cadenza.schema import DATA_COLS, KEY_NAMES, RAW_SCHEMA, TRACK_COLS

SIM = ["energy", "speechiness", "acousticness", "tempo"]


def _key(v):
    return (v is None, v if v is not None else 0)


def brute(rows):
    """rows: list of dicts with RAW_SCHEMA fields. Returns the star pieces."""
    named = [r for r in rows if r["track_name"] is not None]
    named.sort(key=lambda r: (r["row_no"], _key(r["track_genre"])))
    seen, clean = set(), []
    for r in named:                                   # dedup keeping the first
        k = tuple(r[c] for c in DATA_COLS)
        if k not in seen:
            seen.add(k)
            clean.append(dict(r))
    clean = [r for r in clean if r["time_signature"] != 0]
    for r in clean:
        if r["time_signature"] == 1:
            r["time_signature"] = 4
    # profile over distinct 6-tuples, null keys dropped
    six = {(r["track_genre"], r["time_signature"], *[r[c] for c in SIM]) for r in clean}
    acc = defaultdict(list)
    for g, ts, *f in six:
        if g is not None and ts is not None:
            acc[(g, ts)].append(f)
    profile = {k: [sum(x[i] for x in v) / len(v) for i in range(4)] for k, v in acc.items()}

    def unit(v):
        n = math.sqrt(v[0] * v[0] + v[1] * v[1] + v[2] * v[2] + v[3] * v[3])
        return list(v) if n == 0 else [x / n for x in v]

    first_vec = {}
    for (g, ts) in sorted(profile, key=lambda k: (k[0], k[1])):
        first_vec.setdefault(g, unit(profile[(g, ts)]))
    lists = defaultdict(list)                          # genre list in file order
    for r in clean:
        if r["track_id"] is not None:
            lists[r["track_id"]].append((r["row_no"], r["track_genre"]))
    tracks = {tuple(r[c] for c in TRACK_COLS) for r in clean}
    out = {}
    for t in tracks:
        row = dict(zip(TRACK_COLS, t))
        lst = lists.get(row["track_id"])
        if lst is None:
            prim = None
        elif len(lst) == 1:
            prim = lst[0][1]
        else:
            tv = unit([row[c] for c in SIM])
            best = None
            for pos, g in lst:
                if g is None or (g, row["time_signature"]) not in profile:
                    continue
                gv = first_vec[g]
                sim = round(tv[0] * gv[0] + tv[1] * gv[1] + tv[2] * gv[2] + tv[3] * gv[3], 12)
                if best is None or sim > best[0]:
                    best = (sim, g)
            prim = best[1] if best else None
        out[t] = prim
    # fact: mean over distinct track rows, half to even
    pops = defaultdict(list)
    for t in tracks:
        row = dict(zip(TRACK_COLS, t))
        if row["track_id"] is not None:
            pops[row["track_id"]].append(row["popularity"])
    fact = {k: int(round(sum(v) / len(v))) for k, v in pops.items()}   # Python round: half to even
    names = []
    for t in tracks:
        row = dict(zip(TRACK_COLS, t))
        names += [None] if row["artists"] is None else row["artists"].split(";")
    artists = {n: i + 1 for i, n in enumerate(sorted({n for n in names if n is not None}))}
    if None in names:
        artists[None] = 0
    return out, fact, artists


def _sig(key, mode):
    note = KEY_NAMES.get(key)
    return None if note is None else note + (" Minor" if mode == 0 else " Major")


quarter = st.sampled_from([0.0, 0.25, 0.5, 1.0])
row_st = st.fixed_dictionaries({
    "track_id": st.sampled_from(["t1", "t2", "t3"]),
    "artists": st.sampled_from([None, "A", "B;A", "C"]),
    "album_name": st.sampled_from([None, "X", "Y"]),
    "track_name": st.sampled_from([None, "s", "s", "s"]),
    "popularity": st.integers(0, 5),
    "energy": quarter, "speechiness": quarter, "acousticness": quarter,
    "tempo": st.sampled_from([0.5, 1.0, 2.0]),
    "key": st.sampled_from([-1, 0, 5]),
    "mode": st.sampled_from([0, 1]),
    "time_signature": st.sampled_from([None, 0, 1, 3, 4, 4]),
    "track_genre": st.sampled_from(["g1", "g2", "g3", None]),
})


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row_st, min_size=1, max_size=14), st.randoms(use_true_random=False))
def test_star_matches_brute_force(spark, draws, rnd):
    rows = []
    for i, d in enumerate(draws):
        r = dict(d, row_no=rnd.randint(0, 40) * 10 + i, duration_ms=200000, explicit=False,
                 danceability=0.5, loudness=-5.0, instrumentalness=0.0, liveness=0.1, valence=0.5)
        rows.append(r)
        if rnd.random() < 0.3:                         # exact duplicate at a later position
            rows.append(dict(r, row_no=r["row_no"] + 1000))
    df = spark.createDataFrame([tuple(r[f.name] for f in RAW_SCHEMA.fields) for r in rows], RAW_SCHEMA)
    star = build_star(df, checkpoint_stages=False)
    want_prim, want_fact, want_artists = brute(rows)

    got_prim = {tuple(r[c] for c in TRACK_COLS): r.primary_genre for r in star.tracks.collect()}
    assert got_prim == want_prim
    assert {r.track_id: r.popularity for r in star.fact_track_popularity.collect()} == want_fact
    assert {r.artist_name: r.artist_id for r in star.dim_artists.collect()} == want_artists
    for r in star.dim_tracks.collect():
        assert r.key_signature == _sig(r.key, r.mode)
