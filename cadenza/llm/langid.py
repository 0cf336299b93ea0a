"""Language identification by averaged hashed subword embeddings.

A text's subwords are the byte n-grams of 2 to 4 of its lower-cased letters and
spaces, hashed into ``BUCKETS`` rows.  Their embeddings are averaged and go
through a linear softmax; both layers are trained by stochastic gradient descent
in numpy.  For prediction the two linear layers are multiplied into one table,
so a text costs one look-up per subword, over the whole text.

Rejection is calibrated on every tenth training document, whole and in pieces,
of which the descent sees nothing: the temperature that fits their likelihood best, and the score below
which a share of ``REJECT`` of them falls.

Training takes at most ``TRAIN_DOCS`` documents for each language and
``TRAIN_TOTAL`` in all (at least ``LEAST_DOCS`` a language), by a hash, whose
``crc32(id) mod 4`` is not 2: each whole, and two short pieces of the longer
ones.  Texts are turned into bags of buckets where they are; a bag has at most
``BUCKETS`` entries, however long its text.  More than ``MAX_LANGS`` languages
are refused, since every one needs its share of the training rows.

Defined results: a null text or one without letters is ``und`` with score 0;
with no trainable row every text is ``und``; repeated rows each give a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.llm.common import id_crc

BUCKETS = 1 << 16
DIMS = 16
TRAIN_DOCS = 600
TRAIN_TOTAL = 6_000
LEAST_DOCS = 20
MAX_LANGS = 500
EPOCHS = 12
REJECT = 0.01
PIECE = 1 << 16
_LETTER = regex.compile(r"\p{L}")
#: letters and bytes of other scripts stay; everything else is a space
_KEEP = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


@dataclass(frozen=True)
class Model:
    langs: tuple[str, ...]
    table: bytes  # BUCKETS x languages, float32
    bias: bytes
    temperature: float
    reject_below: float


def normal(text: str) -> bytes:
    raw = text.lower().encode("utf-8", "surrogatepass").translate(_KEEP)
    return b" " + b" ".join(raw.split()) + b" "


def subwords(data: bytes, last: bool = True) -> np.ndarray:
    """Bucket of every byte 2-, 3- and 4-gram; of a piece that another one
    follows, those that begin before its last three bytes."""
    b = np.frombuffer(data, np.uint8).astype(np.uint32)
    two = b[:-1] << np.uint32(8) | b[1:]
    three = (two[:-1] << np.uint32(8) | b[2:]) + np.uint32(1 << 24)
    grams = [two, three, two[:-2] << np.uint32(16) | two[2:]]
    if not last:
        grams = [g[:len(b) - 3] for g in grams]
    mixed = np.concatenate(grams) * np.uint32(2654435761)
    return (mixed >> np.uint32(16)).astype(np.int32)


def windows(data: bytes) -> Iterator[np.ndarray]:
    """Every subword of a normalised text once, in pieces that overlap by the
    longest n-gram less one byte."""
    for lo in range(0, max(1, len(data) - 3), PIECE):
        last = lo + PIECE + 3 >= len(data)
        yield subwords(data[lo:] if last else data[lo:lo + PIECE + 3], last)


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct buckets of a text and their shares."""
    counts = np.zeros(BUCKETS, np.int64)
    for ids in windows(normal(text)):
        counts += np.bincount(ids, minlength=BUCKETS)
    ids = np.flatnonzero(counts)
    return ids.astype(np.int32), (counts[ids] / counts[ids].sum()).astype(np.float32)


def pieces(text: str) -> list[str]:
    """A whole text and, if it is long, short pieces of it, so that short texts
    are known too; those without letters are left out."""
    return [p for p in ([text, text[:60], text[len(text) // 2:][:150]] if len(text) > 200 else [text]) if _LETTER.search(p)]


def _softmax(z):
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def descend(bags, y: np.ndarray, n_langs: int, epochs: int = EPOCHS, rate: float = 4.0, seed: int = 11):
    """Embeddings, output layer and bias after stochastic gradient descent."""
    rng = np.random.default_rng(seed)
    emb = (rng.standard_normal((BUCKETS, DIMS)) / DIMS).astype(np.float32)
    out, bias = np.zeros((DIMS, n_langs), np.float32), np.zeros(n_langs, np.float32)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for k in rng.permutation(len(bags)):
            ids, w = bags[k]
            mean = w @ emb[ids]
            err = _softmax(mean @ out + bias)
            err[y[k]] -= 1
            back = out @ err
            out -= step * 0.5 * np.outer(mean, err)
            bias -= step * 0.01 * err
            emb[ids] -= step * (w * len(ids) ** 0.5)[:, None] * back
    return emb, out, bias


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        train_docs: int = TRAIN_DOCS, train_total: int = TRAIN_TOTAL, max_langs: int = MAX_LANGS) -> Model:
    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
            .where(F.col("lang").isNotNull() & (F.coalesce(id_crc("id") % 4, F.lit(0)) != 2) & F.col("text").rlike(r"\p{L}")))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().limit(max_langs + 1).collect()}
    if len(counts) > max_langs:
        raise ValueError(f"more than {max_langs} languages: raise max_langs (and train_total)")
    if not counts:
        return Model((), b"", b"", 1.0, 0.0)
    train_docs = min(train_docs, max(LEAST_DOCS, train_total // len(counts)))
    # a hash share of each language that gives about train_docs rows; a window over their ids then keeps the bound exact
    share = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(max(1, n // (2 * train_docs))))])
    rows = rows.withColumn("mark", F.xxhash64("text"))
    draw = F.xxhash64(F.lit(19), "id", "mark")
    rows = rows.where(F.pmod(draw, share[F.col("lang")]) == 0).withColumn("draw", draw)
    first = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    rows = rows.withColumn("n", first).where(F.col("n") <= train_docs).select("text", "lang", "draw")

    def bags(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [(lang, draw, k, *(x.tobytes() for x in bag(p))) for text, lang, draw in zip(pdf["text"], pdf["lang"], pdf["draw"])
                   for k, p in enumerate(pieces(text))]
            yield pd.DataFrame(out, columns=["lang", "draw", "k", "ids", "shares"])

    got = rows.mapInPandas(bags, "lang string, draw long, k int, ids binary, shares binary").toPandas()
    got = got.sort_values(["draw", "lang", "k"], kind="stable")
    return train([(np.frombuffer(i, np.int32), np.frombuffer(w, np.float32)) for i, w in zip(got["ids"], got["shares"])], got["lang"],
                 got.groupby(["draw", "lang"], sort=False).ngroup().to_numpy())


def train(bags: list, langs, docs=None) -> Model:
    """The model from bags of buckets, their languages and the numbers of the
    documents that they come from (each its own, if not given), in a fixed order."""
    names = tuple(sorted(set(langs)))
    labels = np.array([names.index(x) for x in langs])
    seen = (np.arange(len(bags)) if docs is None else np.asarray(docs)) % 10 != 9
    emb, out, bias = descend([b for b, s in zip(bags, seen) if s], labels[seen], len(names))
    table = emb @ out
    z = np.array([w @ table[ids] + bias for (ids, w), s in zip(bags, seen) if not s]).reshape(-1, len(names))
    held = labels[~seen]
    temperature, low = 1.0, 0.0
    if len(held):
        loss = {t: -np.log(_softmax(z / t)[np.arange(len(held)), held] + 1e-9).mean() for t in np.geomspace(0.25, 8, 21)}
        temperature = float(min(loss, key=loss.get))
        low = float(np.quantile(_softmax(z / temperature).max(axis=1), REJECT))
    return Model(names, table.astype(np.float32).tobytes(), bias.tobytes(), temperature, low)


@lru_cache(maxsize=2)
def _arrays(model: Model):
    n = len(model.langs)
    return np.frombuffer(model.table, np.float32).reshape(BUCKETS, n), np.frombuffer(model.bias, np.float32)


def predict_text(text: str | None, model: Model) -> tuple[str, float]:
    if not text or not model.langs or not _LETTER.search(text):
        return "und", 0.0
    table, bias = _arrays(model)
    total, n = np.zeros(len(bias)), 0
    for ids in windows(normal(text)):
        total += table[ids].sum(axis=0, dtype=np.float64)
        n += len(ids)
    p = _softmax((total / n + bias) / model.temperature)
    k = int(p.argmax())
    return model.langs[k], float(p[k])


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, held_out, lang_pred, score, rejected`` for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("struct<lang_pred:string,score:double>")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([predict_text(t, shared.value) for t in texts], columns=["lang_pred", "score"])

    return (docs.select(F.col(id_col), F.coalesce(id_crc(id_col) % 4 == 2, F.lit(False)).alias("held_out"),
                        udf(F.col(text_col)).alias("p"))
            .select(id_col, "held_out", "p.lang_pred", "p.score",
                    (F.col("p.score") < model.reject_below).alias("rejected")))
