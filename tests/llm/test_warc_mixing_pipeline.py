import base64
import gzip
import hashlib
import io

import duckdb
import numpy as np
import pytest

from cadenza.llm import mixing, warc
from cadenza.llm.sql import MIXING


@pytest.mark.parametrize("split", [64 << 20, 700, 97])
def test_warc_round_trip_at_any_split(spark, tmp_path, split):
    rng = np.random.default_rng(6)
    big = "".join(chr(c) for c in rng.integers(32, 0x2FF, 30_000))
    rows = [(1, "u1", "<p>same</p>"), (2, "u2", "<p>same</p>"), (3, None, None), (4, "u\r\n4", ""), (5, "u5", big),
            (6, "u6", big + "x"), (9, "u9", "<p>same</p>"), (9, "u9", "<p>same</p>"), (None, "n", "<p>same</p>"),
            (7, "gz", "text with \x1f\x8b\x08 inside")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    out = str(tmp_path / "w")
    files = warc.write_warc(df, out)
    assert files.agg({"records": "sum"}).first()[0] == len(rows)
    got = warc.read_warc(spark, out, split_bytes=split, with_payload=True).collect()
    assert len(got) == len(rows)
    key = lambda r: (r[0] or "", r[1])
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        last = max(x[0] for x in rows if (x[2] or "") == (html or "") and x[0] is not None)
        kind = "response" if i == last else "revisit"
        want.append((None if i is None else str(i), kind, None if kind == "response" else str(last), len(data),
                     base64.b32encode(hashlib.sha1(data).digest()).decode(), data if kind == "response" else None))
    got = [(r.record_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest,
            None if r.payload is None else bytes(r.payload)) for r in got]
    assert sorted(got, key=lambda r: (r[0] or "", r[1])) == sorted(want, key=lambda r: (r[0] or "", r[1]))


def test_warc_members_are_plain_gzip_and_empty_tables_work(spark, tmp_path):
    data = warc.encode_record(5, "response", None, "u", b"hello")
    text = gzip.decompress(data)
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: response") and text.endswith(b"hello\r\n\r\n")
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.write_warc(df, str(tmp_path / "e")).count() == 0
    assert warc.read_warc(spark, str(tmp_path / "e")).count() == 0
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, "abcdef"), (4, "abcdef")], "page_id long, html string")
    warc.write_warc(rows, str(tmp_path / "m"), min_revisit_bytes=3)
    assert {r.record_id: r.record_type for r in warc.read_warc(spark, str(tmp_path / "m")).collect()} == {
        "1": "response", "2": "response", "3": "revisit", "4": "response"}


def test_long_pages_that_compress_well_and_long_urls_are_read():
    pages = [(1, "u", b"The same sentence again. " * 210_000), (2, "http://x/" + "abc" * 700_000, b"short"), (3, None, b"a" * 3_000_000)]
    parts = [warc.encode_record(i, "response", None, u, p) for i, u, p in pages]
    data = b"".join(parts)
    got = list(warc.records_in(io.BytesIO(data), 0, len(data), True))
    assert [(int(r[0]), r[3], r[6]) for r in got] == pages
    got = [r[0] for at in range(0, len(data), 999) for r in warc.records_in(io.BytesIO(data), at, at + 999, False)]
    assert got == ["1", "2", "3"]
    with pytest.raises(ValueError, match="header block"):
        list(warc.records_in(io.BytesIO(parts[1][:2_000]), 0, 2_000, True))


def test_mix_matches_sql_and_targets(spark, make_docs):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(400):
        src = [None, "a", "b", "tiny", "z", "empty"][int(rng.choice(6, p=[.1, .5, .2, .05, .1, .05]))]
        n = 0 if src == "empty" else int(rng.integers(0, 40 if src != "b" else 4000))
        rows.append((i, None if n == 0 and i % 2 else " ".join(["w"] * n), "en", src))
    rows += [(5, "w w w", "en", "a"), (None, "w w", "en", "a")]
    docs = make_docs(rows, extra="size target start")
    got = mixing.mix(docs).toPandas()
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "source").toPandas().astype({"doc_id": "Int64"}))
    want = con.sql(MIXING).df()
    cols = ["doc_id", "source", "size", "source_size", "target", "taken"]
    order = lambda d: sorted((float(r[0]), str(r[1]), *map(float, r[2:])) for r in d[cols].fillna(-1).values.tolist())
    assert order(got) == order(want)
    assert (got["taken"] <= 3 * got["size"]).all() and got["taken"].sum() == got["size"].sum()
    per = got.groupby(got["source"].fillna("-")).agg(taken=("taken", "sum"), target=("target", "first"))
    assert ((per.taken - per.target).abs() <= np.maximum(3, per.target / 100)).all()
    assert mixing.mix(docs.where("false")).count() == 0


def test_pipeline_matches_a_plain_version(spark, tmp_path):
    import corpus_pipeline as cp
    from cadenza.llm import decontaminate, simhash_vptree, toxicity
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    extra = docs.limit(3).unionByName(docs.limit(2).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "text", "lang", "source", "n_chars"))
    docs = docs.unionByName(extra).unionByName(spark.createDataFrame([(7001, None, None, None, None)], docs.schema))
    stages = dict(cp.STAGES)
    # toxicity: by the score of each text
    lexicon, weights = toxicity.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    auto = toxicity.build(lexicon)
    left = [r for r in docs.collect() if toxicity.score(r.text, auto, weights) < 0.5]
    one = stages["toxicity"](spark, docs, sf)
    one.write.parquet(str(tmp_path / "1"))
    one = spark.read.parquet(str(tmp_path / "1"))
    assert sorted(map(str, one.collect())) == sorted(map(str, left)) and one.columns == cp.COLUMNS
    # near duplicates: greedy classes by brute force
    rows = sorted({(r.doc_id is None, r.doc_id or 0, hashlib.md5((r.text or "").encode()).hexdigest()): r for r in left}.items())
    fp = [simhash_vptree.simhash((r.text or "").encode()) & (2 ** 64 - 1) for _, r in rows]
    low = list(range(len(rows)))
    for _ in range(len(rows)):
        new = [min(low[j] for j in range(len(rows)) if (fp[i] ^ fp[j]).bit_count() <= 2) for i in range(len(rows))]
        if new == low:
            break
        low = new
    two = stages["simhash_near_dedup"](spark, one, sf)
    want = [(str(rows[i][1].doc_id), rows[i][1].text) for i in range(len(rows)) if low[i] == i]
    assert sorted((str(r.doc_id), r.text or "") for r in two.collect()) == sorted((a, b or "") for a, b in want)
    # contaminated documents go, the others stay as they are
    found = {(r.doc_id, r.n_words): r.contaminated for r in decontaminate.report(
        two, spark.read.parquet(f"{sf}/benchmark.parquet")).collect()}
    three = stages["benchmark_decontamination"](spark, two, sf)
    assert three.count() == sum(not c for c in found.values())
    four = stages["pii"](spark, three, sf)
    assert four.columns == cp.COLUMNS and four.count() == three.count()
    assert not [r for r in four.collect() if r.text and "@mail" in r.text]
    five = stages["source_mixing"](spark, four, sf)
    assert five.count() == three.count() and five.agg({"taken": "sum"}).first()[0] == five.agg({"size": "sum"}).first()[0]


def test_whole_pipeline_with_other_columns_and_nothing(spark, tmp_path):
    import os

    import corpus_pipeline as cp
    from pyspark.sql import functions as F
    words = lambda i, n=40: " ".join(f"w{i}x{k}" for k in range(n))
    passage = " ".join(f"bench{k}" for k in range(20))
    rows = [(i, words(i), "en", f"s{i % 3}", 1) for i in range(60)]
    rows += [(100 + i, words(i % 2) + f" vilorak vilorak{i % 3} you vilorak", "en", "s0", 1) for i in range(30)]
    rows += [(200, rows[5][1], "en", "s1", 1), (201, rows[5][1], "de", "s2", 1), (202, passage, "en", "s1", 1), (203, None, None, None, None),
             (None, "nobody's own words here", "en", "s1", 2), (204, words(9) + " mail jane.roe@mail.org", "en", "s1", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumns(
        {c: F.lit("x") for c in ("score", "component_id", "contaminated", "n_entities", "size", "h")})
    labels = spark.createDataFrame([(i, 1, int(i >= 100)) for i in [*range(60), *range(100, 130)]], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, passage), (2, None)], "item_id long, text string")
    folder = str(tmp_path / "in")
    for name, df in (("documents", docs), ("labels", labels), ("benchmark", bench)):
        df.write.parquet(f"{folder}/{name}.parquet")
    ck = spark.sparkContext.getCheckpointDir().replace("file:", "")
    left = lambda: {d for d in os.listdir(ck) if d.startswith("cadenza-")}
    before = left()
    got = cp.run(spark, folder)
    # every stage's own files are gone, the result's alone are left
    assert [d.split("-")[2] for d in left() - before] == ["source_mixing"]
    kept = {r.doc_id for r in got.collect()}
    assert not kept & set(range(100, 130)) and not kept & {200, 201, 202} and {None, 203} <= kept
    assert set(range(60)) - kept <= {9} and len(kept & {9, 204}) >= 1
    for name, df in (("documents", docs), ("labels", labels), ("benchmark", bench)):
        df.where("false").write.parquet(f"{tmp_path}/none/{name}.parquet")
    assert cp.run(spark, str(tmp_path / "none")).count() == 0
