import numpy as np
import pytest
import xxhash

from cadenza.llm import embedding_dedup, simhash_vptree


def classes(n, linked):
    low = list(range(n))
    while True:
        new = [min([low[i], *(low[j] for j in range(n) if linked(i, j))]) for i in range(n)]
        if new == low:
            return low
        low = new


def plain_fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ")
             .replace("\n", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints_of_edge_texts():
    for t in ("", " \t\n", "one", "ÄB Cd", "a b c", "the same words " * 40, None, "x y z w"):
        got = simhash_vptree.simhash(None if t is None else t.encode())
        assert got & (2 ** 64 - 1) == plain_fingerprint(t)


@pytest.mark.parametrize("leaf_rows", [16_384, 40])
def test_classes_match_brute_force(spark, make_docs, monkeypatch, leaf_rows):
    rng = np.random.default_rng(1)
    fps = [int(x) for x in rng.integers(0, 2 ** 63, 150)]
    for k in range(250):  # chains and balls of near fingerprints
        fps.append(fps[int(rng.integers(0, len(fps)))] ^ sum({1 << int(b) for b in rng.integers(0, 63, rng.integers(0, 4))}))
    rows = spark.createDataFrame([(f - 2 ** 64 if f >= 2 ** 63 else f, i) for i, f in enumerate(fps)], "fp long, least long")
    # the same search that near_duplicates runs, on given fingerprints
    from cadenza.llm.common import connected_components
    distinct = rows.groupBy("fp").agg({"least": "min"}).withColumnRenamed("min(least)", "least")
    comp = {r.node: r.component for r in connected_components(
        simhash_vptree.links(distinct, 2, leaf_rows=leaf_rows)).collect()}
    want = classes(len(fps), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 2)
    for i in range(len(fps)):
        for j in range(i):
            assert (comp.get(fps[i], fps[i]) == comp.get(fps[j], fps[j])) == (want[i] == want[j])


def test_near_duplicates_edges(spark, make_docs):
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    docs = make_docs([(5, "a b c d e"), (3, "a b c d e"), (3, "a b c d e"), (9, None), (8, ""), (None, "a b c d e"),
                      (7, long), (6, long + " tail"), (11, "unrelated words are here now")], extra="fp id component_id")
    got = {(r.doc_id, r.fingerprint): r.component_id for r in simhash_vptree.near_duplicates(docs).collect()}
    assert simhash_vptree.near_duplicates(docs).count() == 9
    by_id = {k[0]: v for k, v in got.items()}
    assert (by_id[5], by_id[3], by_id[None], by_id[9], by_id[8], by_id[6], by_id[7], by_id[11]) == (3, 3, 3, 8, 8, 6, 6, 11)
    assert simhash_vptree.near_duplicates(make_docs([]).where("false")).count() == 0


@pytest.mark.parametrize("cell_rows", [8_192, 24])
def test_embedding_links_match_brute_force(spark, cell_rows):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((120, 16))
    near = x[rng.integers(0, 120, 300)] + rng.standard_normal((300, 16)) * rng.choice([0.05, 0.1, 0.3], (300, 1))
    v = np.vstack([x, near, near[:40], near[:20] * 3]).astype(np.float32)
    rows = [(i, [float(a) for a in r], int(i % 2)) for i, r in enumerate(v)]
    n = len(rows)
    odd = [(n, None, 0), (n + 1, [0.0] * 16, 0), (n + 2, [float("nan")] + [1.0] * 15, 0), (n + 3, rows[0][1], None),
           (n + 4, [None] + [1.0] * 15, 0), (n + 5, [float("inf")] * 16, 1), (None, rows[0][1], 0)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(df, cell_rows=cell_rows).collect()}
    w = v.astype(np.float64)
    norm = np.linalg.norm(w, axis=1)
    close = (w @ w.T >= 0.93 * norm[:, None] * norm[None]) & (np.arange(n)[:, None] % 2 == np.arange(n)[None] % 2)
    np.fill_diagonal(close, False)
    want = classes(n, lambda i, j: close[i, j])
    assert close.sum() > 300
    assert [got[i].n_links for i in range(n)] == close.sum(axis=1).tolist()
    assert [got[i].component_id for i in range(n)] == want
    assert all(got[i].kept == (want[i] == i) for i in range(n))
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i in range(n, n + 6))
    assert (got[None].n_links, got[None].component_id, got[None].kept) == (0, None, False)
    assert embedding_dedup.near_duplicates(df.where("false")).count() == 0


def test_embeddings_with_shared_ids(spark):
    """Ids that other labels and vectors share join nothing; tiny and huge vectors link like any others."""
    rng = np.random.default_rng(9)
    base = rng.standard_normal((12, 8))
    rows = []
    for k in range(160):
        v = (base[k % 12] + rng.standard_normal(8) * 0.12) * (1.0, 1e-200, 1e200)[k % 3]
        rows.append((int(rng.integers(0, 60)), [float(a) for a in v], k % 2))
    rows += rows[:25]
    rows += [(1, [1.0] * 8, 0), (2, [1.0] * 7 + [1.01], 0), (1, [-1.0] * 8, 1), (3, [-1.0] * 7 + [-1.01], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr(
        "*", "1 AS node", "2 AS key", "3 AS least", "4 AS copies")
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(df, cell_rows=16).collect())
    unit = np.array([np.array(v) / max(map(abs, v)) for _, v, _ in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    close = (unit @ unit.T >= 0.93) & (label[:, None] == label[None])
    np.fill_diagonal(close, False)
    group = classes(len(rows), lambda i, j: close[i, j])
    least = [min(rows[j][0] for j in range(len(rows)) if group[j] == group[i]) for i in range(len(rows))]
    assert got == sorted((r[0], int(n), m, r[0] == m) for r, n, m in zip(rows, close.sum(axis=1), least))


def test_a_label_of_one_sampled_row_is_chunked(spark):
    """Without a tree a label's cell takes chunks from its sampled size."""
    x = np.random.default_rng(3).standard_normal((200, 8))
    df = spark.createDataFrame([(i, [float(a) for a in r], 0) for i, r in enumerate(x)], "vec_id long, embedding array<double>, label int")
    want = {r.vec_id: r.n_links for r in embedding_dedup.near_duplicates(df, cosine=0.7).collect()}
    got = {r.vec_id: r.n_links for r in embedding_dedup.near_duplicates(df, cosine=0.7, sample_rows=1, cell_rows=40).collect()}
    assert got == want and sum(want.values()) > 0
