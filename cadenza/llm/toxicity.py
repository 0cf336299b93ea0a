"""Toxicity by a weighted lexicon matched with Aho-Corasick.

Texts are folded first: lower case, look-alike letters of other scripts to
Latin ones, underscores to spaces, digits and signs inside words (before the
word's last letter) to the letters they stand for, in one linear pass.  One
Aho-Corasick automaton holds the lexicon's stems and the exception phrases; a
stem counts where it begins a word and lies in no exception phrase.  The score
is a logistic function of the weights found, also per length of the text.

The lexicon is learnt from labels: stems (whole words and word beginnings) that
toxic texts hold far more often than others, weighted by log-odds, added to a
fixed list of common insults.  Of the stems that a hundredth of the toxic texts
hold, the ``LEXICON`` with the highest lift are kept.  Counting covers a bounded
hash sample of labelled rows (``TRAIN_ROWS``); the logistic weights are fitted on
the same rows by Newton steps.  Held-out rows (``crc32(id) mod 5 = 0``) are never used.

Defined results: a null or empty text has no finding and gets the score of its
features (none); an id with several labels counts once per label; with no
labels of both kinds the fixed list and fixed weights are used; repeated rows
each give a row; ids may be of any type that labels and documents share.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import hash_sample, id_crc
from cadenza.session import checkpoint

TRAIN_ROWS = 12_000
LEXICON = 5_000
MIN_LIFT = 2.5
#: fixed word list and phrases that excuse a stem inside them
INSULTS = ("idiot", "moron", "stupid", "scum", "pathetic", "worthless", "disgusting", "loser", "trash", "clown")
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "class clown", "clown fish", "clownfish", "sore loser bracket",
              "stupidly simple", "worthless check")
FIXED = (-4.0, 1.0, 0.5, 1.0)
#: look-alikes of Latin letters, by letter
_LOOKS = {"a": "аα", "c": "сϲ", "e": "еёε", "i": "іїιı", "j": "ј", "k": "кκ", "o": "оο", "p": "рρ", "s": "ѕ", "t": "τ",
          "u": "υ", "v": "ν", "x": "хχ", "y": "у", "d": "ԁ", "q": "ԛ", "w": "ԝ"}
_LATIN = {c: k for k, v in _LOOKS.items() for c in v}
_LATIN |= {chr(0xFF41 + i): chr(97 + i) for i in range(26)}
_FOLD = str.maketrans(_LATIN | {"_": " "})
_SIGNS = str.maketrans("013457@$!|", "oieastasii")
#: a word with a digit or sign; it is tried at its start alone, so a run is read once
_MIXED = re.compile(r"(?<![\w@$!|])[^\W\d]*+[\d@$!|][\w@$!|]*+")


def _unmask(word: re.Match) -> str:
    core = word[0].rstrip("0123456789@$!|")
    return core.translate(_SIGNS) + word[0][len(core):]


def fold(text: str | None) -> str:
    """Lower case, look-alikes to Latin, digits and signs before the last letter of their word to letters."""
    return _MIXED.sub(_unmask, (text or "").lower().translate(_FOLD))


def stems(folded: str) -> set[str]:
    out = set()
    for w in set(re.findall(r"[^\W\d_]+", folded)):
        out.add(w)
        out.update(w[:n] for n in range(3, min(len(w), 9)))
    return out


def build(lexicon: dict[str, float], exceptions=EXCEPTIONS):
    auto = ahocorasick.Automaton()
    for s, w in lexicon.items():
        auto.add_word(s, (len(s), w))
    for p in exceptions:
        auto.add_word(p, (len(p), lexicon.get(p, 0.0) if p in lexicon else None))
    if len(auto):
        auto.make_automaton()
    return auto


def features(text: str | None, auto) -> tuple[float, float, float]:
    """Sum of the weights found (each stem once), their sum over all places per
    100 characters, and whether there are any."""
    t = fold(text)
    hits, excused = [], []
    for end, (n, w) in (auto.iter(t) if len(auto) else ()):
        start = end + 1 - n
        if start and (t[start - 1].isalnum()):
            continue
        (excused if w is None else hits).append((start, end, w))
    if excused:
        excused.sort()
        starts, reach, far = [a for a, *_ in excused], [], -1
        for _, b, _ in excused:
            far = max(far, b)
            reach.append(far)
        # of the phrases that begin by then, the farthest end
        hits = [h for h in hits if not (k := bisect_right(starts, h[0])) or reach[k - 1] < h[1]]
    if not hits:
        return 0.0, 0.0, 0.0
    once = {t[a:b + 1]: w for a, b, w in hits}
    return (min(sum(once.values()), 40.0) / 4, min(sum(w for *_, w in hits) * 100 / max(len(t), 50), 10.0), 1.0)


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", train_rows: int = TRAIN_ROWS) -> tuple[dict[str, float], tuple]:
    """Lexicon and logistic weights, from rows that are not held out."""
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("y IS NOT NULL")
    marks = hash_sample(marks.where(id_crc("id") % 5 != 0).distinct(), train_rows, "id")  # bounded by train_rows
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(marks), "id")
    rows = checkpoint(hash_sample(checkpoint(rows.distinct(), "toxicity-rows"), train_rows, "id", "text"), "toxicity-train").select("text", "y")

    def count(wanted=None):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            toxic, clean = Counter(), Counter()
            for pdf in batches:
                for text, y in zip(pdf["text"], pdf["y"]):
                    found = stems(fold(text))
                    (toxic if y else clean).update(found if wanted is None else found & wanted)
            keys = list(toxic.keys() | clean.keys())
            if keys:
                yield pd.DataFrame({"stem": keys, "toxic": [toxic[k] for k in keys], "clean": [clean[k] for k in keys]})
        return run

    def total(df, wanted=None):
        return (df.mapInPandas(count(wanted), "stem string, toxic long, clean long").groupBy("stem")
                .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))

    n1, n0 = rows.agg(F.sum(F.when(F.col("y") == 1, 1).otherwise(0)), F.sum(F.when(F.col("y") != 1, 1).otherwise(0))).first()
    if not n1 or not n0:
        return {w: 4.0 for w in INSULTS}, FIXED
    # a hundredth of the texts each: a hundred times the stems of a text at most
    frequent = total(rows.where("y = 1")).where(F.col("toxic") >= max(3, math.ceil(0.01 * n1))).select("stem").toPandas()
    counts = total(rows, set(frequent["stem"])).toPandas()
    lift = {s: math.log((a + 0.5) / (n1 + 1)) - math.log((b + 0.5) / (n0 + 1))
            for s, a, b in zip(counts["stem"], counts["toxic"], counts["clean"])}
    strong = {s: w for s, w in sorted(lift.items(), key=lambda x: (-x[1], x[0]))[:LEXICON] if w >= MIN_LIFT}
    # the shortest strong beginning stands for the words that begin with it
    lexicon = {s: round(w, 6) for s, w in strong.items() if not any(s[:n] in strong for n in range(3, len(s)))}
    mean = sum(lexicon.values()) / len(lexicon) if lexicon else 4.0
    for w in INSULTS:
        if not any(w[:n] in lexicon for n in range(3, len(w) + 1)) and lift.get(w, mean) > 0:
            lexicon[w] = round(max(lift.get(w, mean), 1.0), 6)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        auto = build(lexicon)
        for pdf in batches:
            x = [features(t, auto) for t in pdf["text"]]
            yield pd.DataFrame(x, columns=["a", "b", "c"]).assign(y=pdf["y"].to_numpy())

    got = rows.mapInPandas(measure, "a double, b double, c double, y int").toPandas().sort_values(["a", "b", "c", "y"])
    return lexicon, _logistic(got[["a", "b", "c"]].to_numpy(), got["y"].to_numpy())


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> tuple:
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = _sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w += np.clip(step, -5, 5)
    return tuple(float(v) for v in w)


def score(text: str | None, auto, weights) -> float:
    return float(_sigmoid(weights[0] + float(np.dot(weights[1:], features(text, auto)))))


def score_column(lexicon: dict[str, float], weights: tuple, exceptions=EXCEPTIONS):
    """A function of a text column to its score."""
    @F.pandas_udf("double")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        auto = build(lexicon, exceptions)
        for texts in batches:
            yield pd.Series([score(t, auto, weights) for t in texts], dtype="float64")

    return udf


def predict(docs: DataFrame, lexicon, weights, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, held_out, score, predicted`` for every row."""
    # a udf's column would keep each batch of rows beside the texts sent until it is scored; here only ids come back
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = build(lexicon)
        for batch in batches:
            # texts become Python strings one at a time
            made = pa.array([score(t.as_py(), auto, weights) for t in batch.column("text")], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), made], ["id", "score"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = rows.mapInArrow(scored, f"id {dict(rows.dtypes)['id']}, score double")
    return rows.select(F.col("id").alias(id_col), F.coalesce(id_crc("id") % 5 == 0, F.lit(False)).alias("held_out"), "score",
                       (F.col("score") >= 0.5).cast("int").alias("predicted"))
