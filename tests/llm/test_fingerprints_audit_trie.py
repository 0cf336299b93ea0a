import base64
import hashlib
import itertools
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cadenza.llm import conversation_trie, filter_audit, fingerprints
from cadenza.session import small_batches

BLANK = r"[^\x20\x09-\x0D]"


# --- fingerprints -----------------------------------------------------------

def plain_hashes(text, width=5, piece=32):
    words = re.findall(BLANK + f"{{1,{piece}}}", (text or "").lower())

    def chain(ws):
        h = 42
        for w in ws:
            h = xxhash.xxh64_intdigest(w.encode(), h)
        return h - 2 ** 64 if h >= 2 ** 63 else h
    return {chain(words[i:i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def plain_likeness(a, b, k):
    u = sorted(set(sorted(a)[:k]) | set(sorted(b)[:k]))[:k]
    return sum(h in a and h in b for h in u) / len(u) if u else 1.0


def plain_text(hashes, k):
    return base64.b64encode(b"".join((h % 2 ** 64).to_bytes(8, "big") for h in sorted(hashes)[:k])).decode()


def texts(rng, n):
    words = [f"w{i}é" for i in range(60)]
    return [" ".join(rng.choice(words, int(rng.integers(1, 200)))) for _ in range(n)]


def test_fingerprints_match_brute_force(spark, make_docs):
    rng = np.random.default_rng(5)
    rows = list(enumerate(texts(rng, 40)))
    rows += [(50, None), (51, ""), (52, " \t\n"), (53, "one"), (54, "a b  c"), (55, "x" * 5_000), (56, "漢字" * 3_000), (57, rows[3][1]),
             (58, " ".join(f"q{i}" for i in range(30_000)))]
    docs = make_docs(rows + [(-7, "less than all"), (57, rows[3][1])], extra="h n b sketch copies n_chars_ to_id")
    got = fingerprints.digest(fingerprints.compare_edits(docs, k=16))
    assert got.columns[:3] == ["doc_id", "n_chars", "edited_sha256"]
    got = [r for r in got.collect()]
    assert len(got) == len(rows) + 2 and sum(r.doc_id == 57 for r in got) == 2
    in_order = sorted([*rows, (-7, "less than all")])
    by_id = {r.doc_id: r for r in got}
    for (i, t), (_, nxt) in zip(in_order, in_order[1:] + in_order[:1]):
        t, nxt, r = t or "", nxt or "", by_id[i]
        m = len(t) // 4
        edited = t[:len(t) - m] + nxt[:m]
        a, e, b = plain_hashes(t), plain_hashes(edited), plain_hashes(nxt)
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (plain_text(a, 16), plain_text(e, 16))
        assert r.near_edited == pytest.approx(plain_likeness(a, e, 16)) and r.near_next == pytest.approx(plain_likeness(a, b, 16))
    assert by_id[3].fingerprint == by_id[57].fingerprint


def test_estimates_and_merges(spark):
    words = lambda a, b: " ".join(f"t{i}" for i in range(a, b))
    rows = [("p", words(0, 3_004)), ("p", words(1_000, 4_004)), ("q", words(0, 24)), ("q", None), (None, words(5, 40)), ("e", "")]
    df = fingerprints.fingerprint_documents(spark.createDataFrame(rows, "part string, text string"))
    a, b = (F.lit(r.sketch) for r in df.where("part = 'p'").collect())
    got = spark.range(1).select(fingerprints.resemblance(a, b).alias("r"), fingerprints.containment(a, b).alias("c"),
                                fingerprints.distinct_shingles(a).alias("n"), fingerprints.merge(a, b).alias("m"),
                                fingerprints.from_text(fingerprints.to_text(a)).alias("back"), a.alias("a")).first()
    # 3,000 shingles each, 2,000 of them shared
    assert abs(got.r - 0.5) < 0.15 and abs(got.c - 2 / 3) < 0.2 and abs(got.n - 3_000) < 900 and got.back == got.a
    merged = {r.part: r.sketch for r in fingerprints.merge_groups(df, ["part"]).collect()}
    assert merged["p"] == got.m == sorted(plain_hashes(words(0, 3_004)) | plain_hashes(words(1_000, 4_004)))[:128]
    assert merged["q"] == sorted(plain_hashes(words(0, 24))) and merged["e"] == [] and len(merged[None]) == 31


def test_fingerprints_of_few_documents(spark, make_docs):
    one = fingerprints.compare_edits(make_docs([(4, "abcdefgh")])).first()
    assert (one.near_next, one.edited_sha256) == (1.0, hashlib.sha256(b"abcdefab").hexdigest())
    assert fingerprints.compare_edits(make_docs([(4, "x")]).where("false")).count() == 0
    nulls = fingerprints.compare_edits(make_docs([(None, "eight le"), (None, None), (2, "zz")])).collect()
    assert sorted(str(r.doc_id) for r in nulls) == ["2", "None", "None"]


# --- filter audit -----------------------------------------------------------

def plain_audit(docs, labels):
    good = {i for i, q, t in labels if q == 1}
    toxic = {i for i, q, t in labels if t == 1}
    fails, parts = [], defaultdict(list)
    for i, t, lang in docs:
        t = t or ""
        w = re.findall(BLANK + "+", t)
        f = {"A"} if len(w) < 200 else set()
        f |= {"B"} if 100 * len(set(w)) < 50 * len(w) else set()
        f |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 3 * len(t) else set()
        f |= {"D"} if re.search(r"[#$%&*|]", t) else set()
        f |= {"E"} if i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in docs) else set()
        parts[lang or ""].append((i, f))
    out = {}
    for part, rows in parts.items():
        removed_by = Counter()
        for order in itertools.permutations("ABCDE"):
            left = list(rows)
            for step, letter in enumerate(order, 1):
                gone = [r for r in left if letter in r[1]]
                left = [r for r in left if letter not in r[1]]
                removed_by[letter] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(letter in f for _, f in rows) - len(gone), sum(f == {letter} for _, f in rows),
                    sum(i in good and i is not None for i, _ in gone), sum(i in toxic and i is not None for i, _ in gone)]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(removed_by[order[step - 1]])
    return out


@pytest.mark.parametrize("shard_words", [4_000_000, 300])
def test_audit_matches_brute_force(spark, shard_words):
    rng = np.random.default_rng(6)
    vocab = [f"v{i}" for i in range(400)] + ["Loud", "WORD", "é ß", "a\x1cb", " "]
    docs = []
    for i in range(60):
        size = int(rng.choice([5, 150, 199, 200, 201, 300]))
        t = " ".join(rng.choice(vocab[:int(rng.choice([60, 405]))], size))
        docs.append((i, t + str(rng.choice(["", " #", " |x", "\n"])), str(rng.choice(["en", "de"]))))
    docs += [(100 + i, docs[i % 7][1], "en") for i in range(20)] + [(200, None, None), (201, "", None), (None, docs[0][1], "en"),
             (None, "A", ""), (200, None, None), (300, "Z", "fr"), (301, "x " * 40_000, "de")]
    labels = [(i, int(rng.integers(0, 2)), int(rng.integers(0, 2))) for i in range(0, 130, 2)] + [(4, 1, None), (4, None, 1), (None, 1, 1), (999, 1, 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").withColumns(
        {c: F.lit("x") for c in ("mask", "same", "shard", "words", "docs", "good")}).repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("part", F.lit(1))
    got = filter_audit.audit(df, marks, shard_words=shard_words)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    got = {(r.part, r.filter_order, r.step): list(r[3:]) for r in got.collect()}
    assert got == plain_audit(docs, labels)
    assert filter_audit.audit(df.where("false"), marks).count() == 0


@pytest.mark.parametrize("held", [1, 3, 100_000])
def test_words_numbered_in_pieces_are_one_vocabulary(spark, make_docs, monkeypatch, held):
    """Words that return in a later piece of a shard keep their number and stand once in the dictionary."""
    monkeypatch.setattr(filter_audit, "HELD_WORDS", held)
    texts = {0: "a b a c", 1: "c a d", 2: "", 3: "d é a é", 4: "b"}
    docs = make_docs(list(texts.items())).coalesce(1)
    matrix, words = filter_audit.document_term_matrix(docs.select("doc_id", "text"), ["doc_id"])
    rows = words.collect()
    word = {r["id"]: r["word"] for r in rows}
    assert sorted(word.values()) == ["a", "b", "c", "d", "é"] and sorted(word) == list(range(5)) and len(rows) == 5
    got = {}
    for s in matrix.collect():
        for i, d in enumerate(s["docs"]):
            span = range(s["indptr"][i], s["indptr"][i + 1])
            got[d["doc_id"]] = {word[s["indices"][j]]: s["counts"][j] for j in span}
    assert got == {i: dict(Counter(t.split())) for i, t in texts.items()}


def test_no_row_holds_a_whole_shard(spark, make_docs, monkeypatch):
    """Blocks of a shard hold at most ``BLOCK`` entries of several documents, words stand in a row per hash bucket."""
    monkeypatch.setattr(filter_audit, "BLOCK", 7)
    texts = {i: " ".join(f"w{(i * 7 + k) % 31}" for k in range(i % 6)) for i in range(40)} | {50: " ".join(f"w{k}" for k in range(20)), 51: ""}
    docs = make_docs(list(texts.items())).coalesce(1).select("doc_id", "text")
    shards = filter_audit._shards(docs, ["doc_id"], 10_000, 4, {}).collect()
    assert len({s["shard"] for s in shards}) == 1
    words = [s for s in shards if s["bucket"] is not None]
    assert sorted(s["bucket"] for s in words) == [0, 1, 2, 3] and all(zlib.crc32(w.encode()) % 4 == s["bucket"] for s in words for w in s["vocab"])
    matrix, words = filter_audit.document_term_matrix(docs, ["doc_id"])
    blocks, word = matrix.collect(), {r["id"]: r["word"] for r in words.collect()}
    assert len(blocks) > 10 and all(b["indptr"][0] == 0 and (len(b["indices"]) <= 7 or len(b["docs"]) == 1) for b in blocks)
    got = {d["doc_id"]: {word[n]: c for n, c in zip(b["indices"][lo:hi], b["counts"][lo:hi])}
           for b in blocks for d, lo, hi in zip(b["docs"], b["indptr"], b["indptr"][1:])}
    assert got == {i: dict(Counter(t.split())) for i, t in texts.items()}
    assert {r["doc_id"]: (r["words"], r["distinct"]) for r in filter_audit.row_sums(matrix).collect()} == {
        i: (len(t.split()), len(set(t.split()))) for i, t in texts.items()}


def test_words_of_a_bucket_are_a_range_of_a_shards_numbers(spark, make_docs):
    """No number is written beside a word; a row of several documents stays below half a region of a small heap."""
    texts = {i: " ".join(f"w{(i * 997 + k) % 9001}" for k in range(i % 3000)) for i in range(0, 9000, 300)} | {9001: "", 9002: "é é a"}
    shards = filter_audit._shards(make_docs(list(texts.items())).coalesce(1).select("doc_id", "text"), ["doc_id"], 10**6, 4, {}).collect()
    words = sorted((s for s in shards if s["bucket"] is not None), key=lambda s: s["bucket"])
    assert [s["start"] for s in words] == list(itertools.accumulate((len(s["vocab"]) for s in words[:-1]), initial=0))
    word = [w for s in words for w in s["vocab"]]
    assert len(set(word)) == len(word) and len(shards) > len(words) + 1
    got = {}
    for s in (s for s in shards if s["bucket"] is None):
        assert 12 * len(s["indices"]) < 2**19 and s["start"] is None
        for d, lo, hi in zip(s["docs"], s["indptr"], s["indptr"][1:]):
            got[d["doc_id"]] = {word[n]: c for n, c in zip(s["indices"][lo:hi], s["counts"][lo:hi])}
    assert got == {i: dict(Counter(t.split())) for i, t in texts.items()}


def test_audit_sends_batches_of_bounded_size(spark, monkeypatch):
    """Texts, words and blocks go to the workers in batches of ``BATCH_BYTES``; a longer text goes alone; the session's settings stay."""
    keys = ["spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.parquet.columnarReaderBatchSize"]
    before, seen, write = [spark.conf.get(k, None) for k in keys], {}, filter_audit.checkpoint

    def spy(df, label, *more):
        seen[label] = [spark.conf.get(k, None) for k in keys]
        return write(df, label, *more)

    monkeypatch.setattr(filter_audit, "checkpoint", spy)
    monkeypatch.setattr(filter_audit, "BATCH_BYTES", 2000)
    docs = [(i, f"t{i % 11} " * (1 + i % 7) + "x " * 50, "en") for i in range(60)] + [(90, "long " * 3000, "de"), (91, None, None)]
    got = filter_audit.audit(spark.createDataFrame(docs, "doc_id long, text string, lang string").coalesce(1),
                             spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int"))
    assert {(r.part, r.filter_order, r.step): list(r[3:]) for r in got.collect()} == plain_audit(docs, [(1, 1, 0), (2, 0, 1)])
    assert seen == dict.fromkeys(["term-shards", "word-codes", "row-sums"], ["2000", "512"])
    assert [spark.conf.get(k, None) for k in keys] == before
    with small_batches(spark, 10**6):
        with pytest.raises(ZeroDivisionError), small_batches(spark, 5):
            assert spark.conf.get(keys[0]) == str(10**6)  # the session's own bound holds
            1 / 0
        assert spark.conf.get(keys[0]) == str(10**6)
    assert [spark.conf.get(k, None) for k in keys] == before


def test_matrix_is_global(spark, make_docs):
    docs = make_docs([(1, "b a b"), (2, ""), (3, "c a"), (4, None), (5, "b")]).repartition(3)
    matrix, words = filter_audit.document_term_matrix(docs.select("doc_id", "text"), ["doc_id"], shard_words=2)
    name = {r.id: r.word for r in words.collect()}
    assert sorted(name) == [0, 1, 2] and sorted(name.values()) == ["a", "b", "c"]
    rows = {}
    for s in matrix.collect():
        for d, lo, hi in zip(s.docs, s.indptr, s.indptr[1:]):
            rows[d.doc_id] = {name[i]: n for i, n in zip(s.indices[lo:hi], s.counts[lo:hi])}
    assert rows == {1: {"b": 2, "a": 1}, 2: {}, 3: {"c": 1, "a": 1}, 4: {}, 5: {"b": 1}}


# --- conversation trie ------------------------------------------------------

def plain_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v, key=lambda x: x[:2])] for c, v in own.items()}
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        made[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c in sorted(made):
        for d in range(len(made[c]) + 1):
            members[tuple(made[c][:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        words = len(re.findall(BLANK + "+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * words
    return sorted((m[0], len(p), members[p[:-1]][0] if p else None, len(m), children[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(str(c) for c in m if len(made[c]) == len(p)).encode()).hexdigest()) for p, m in members.items())


def sort_key(r):
    return tuple(-1 if v is None else v for v in r)


@pytest.mark.parametrize("shard,block", [(512, 256), (4, 2), (7, 1), (40, 4)])
def test_trie_matches_brute_force(spark, shard, block):
    rng = np.random.default_rng(8)
    rows = []
    for c in [*range(0, 70), 100, 101, 119, 1_000_000]:
        for t in range(int(rng.integers(1, 6))):
            rows.append((c, t, ["user", "assistant"][t % 2], str(rng.choice(["hi there", "yes", "no  no\tno", "", "é è"]))))
    rows += [(40, None, "system", "first"), (41, 0, None, None), (None, 1, "user", "nobody's"), (30, 9, "user", "x " * 5_000)]
    rows += [(200, t, "user", f"long {t % 3}") for t in range(40)] + [(201, t, "user", f"long {t % 3}") for t in range(41)]
    rows = list({(c, t): (c, t, r, x) for c, t, r, x in rows}.values())
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns(
        {c: F.lit("x") for c in ("pos", "shard", "bits", "words", "depth", "base")})
    got = conversation_trie.prefix_trie(df, shard=shard, block=block)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert {t for _, t in got.dtypes[:-1]} == {"bigint"}
    want = plain_trie(rows)
    assert sorted((tuple(r) for r in got.collect()), key=sort_key) == sorted(want, key=sort_key)


def test_trie_of_copies_ties_and_nothing(spark):
    kind = "conv_id long, turn long, role string, text string"
    rows = [(c, t, "user", f"same {t}") for c in range(0, 400) for t in range(3)]
    got = conversation_trie.prefix_trie(spark.createDataFrame(rows, kind), shard=32)
    assert sorted((tuple(r) for r in got.collect()), key=sort_key) == sorted(plain_trie(rows), key=sort_key)
    assert got.count() == 4
    tied = spark.createDataFrame([(5, 1, "user", "b"), (5, 1, "user", "a"), (5, 1, "user", "a")], kind)
    assert conversation_trie.prefix_trie(tied).count() >= 1
    assert conversation_trie.prefix_trie(spark.createDataFrame(rows[:1], kind).where("false")).count() == 0
