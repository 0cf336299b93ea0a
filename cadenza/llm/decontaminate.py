"""Benchmark decontamination with a generalised suffix automaton.

The normalised words of the test items go into one suffix automaton over word
ids.  A document's words stream through it; at each word the automaton knows
the longest suffix that occurs in some item, and where that reaches a window's
length, the window's words are hit and the items behind the state are named.
Words that no item has reset the automaton, so only runs of known words are
streamed.

Items are dealt into blocks of about ``block_words`` words, one automaton a
block; documents pass through the blocks in turn, and spans and items of all
blocks are put together.  An item of over ``block_words`` words is a block of
its own, or the last of one.  The blocks are written to the shared checkpoint
folder and read by the tasks: the driver sees one count of words a file, and no
item.  An automaton keeps its states in flat arrays; only states with
several transitions, or windows of several items, have a table of their own.

Normalisation: A-Z to a-z, words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.

Defined results: a null text has no words and is not contaminated; an item
without words has no window; items that share an id are one item; a null item
id is written as an empty string; repeated documents each give a row.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
from pyarrow import fs
from pyarrow import parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import spare
from cadenza.session import checkpoint

WINDOW = 13
COVERAGE = 0.05
BLOCK_WORDS = 1_000_000
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
              for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


class Automaton:
    """Generalised suffix automaton of word sequences, and which items own the
    windows that its states stand for."""

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], window: int):
        self.window, self.vocab = window, {}
        #: the first transition of a state (word, target); the further ones stand in ``more``
        self.word, self.to, self.link, self.len = array("i", [-1]), array("i", [-1]), array("i", [-1]), array("i", [0])
        self.more: dict[int, dict[int, int]] = {}
        self.least, self.keys, seqs = window, [], []
        for key, words in items:
            if words:
                seq = array("i", [self.vocab.setdefault(w, len(self.vocab)) for w in words])
                self.keys.append(key)
                seqs.append(seq)
                self.least = min(self.least, len(seq))
                last = 0
                for c in seq:
                    last = self._extend(last, c)
        n = len(self.len)
        #: a window that ends in a state: its length and item; the further ones stand in ``others``
        self.size, self.item = array("i", [0]) * n, array("i", [-1]) * n
        self.others: dict[int, set[tuple[int, int]]] = {}
        for item, seq in enumerate(seqs):
            size = min(window, len(seq))
            for _, state, _ in self.steps(seq, size):
                while self.len[self.link[state]] >= size:
                    state = self.link[state]
                if not self.size[state]:
                    self.size[state], self.item[state] = size, item
                elif (self.size[state], self.item[state]) != (size, item):
                    self.others.setdefault(state, set()).add((size, item))
        #: nearest state on the way to the root, itself included, that ends a window
        self.near = array("i", [-1]) * n
        for s in np.argsort(np.frombuffer(self.len, np.int32), kind="stable")[1:].tolist():
            self.near[s] = s if self.size[s] else self.near[self.link[s]]

    def _next(self, s: int, c: int) -> int:
        """Where ``c`` leads from state ``s``; -1 if nowhere."""
        if self.word[s] == c:
            return self.to[s]
        more = self.more.get(s)
        return -1 if more is None else more.get(c, -1)

    def _lead(self, s: int, c: int, target: int) -> None:
        if self.word[s] == c or self.to[s] < 0:
            self.word[s], self.to[s] = c, target
        else:
            self.more.setdefault(s, {})[c] = target

    def _extend(self, last: int, c: int) -> int:
        q = self._next(last, c)
        if q >= 0:
            return q if self.len[q] == self.len[last] + 1 else self._clone(last, c, q)
        cur = self._state(self.len[last] + 1, 0)
        p = last
        while p >= 0 and self._next(p, c) < 0:
            self._lead(p, c, cur)
            p = self.link[p]
        if p >= 0:
            q = self._next(p, c)
            self.link[cur] = q if self.len[q] == self.len[p] + 1 else self._clone(p, c, q)
        return cur

    def _state(self, length: int, link: int) -> int:
        self.word.append(-1)
        self.to.append(-1)
        self.len.append(length)
        self.link.append(link)
        return len(self.len) - 1

    def _clone(self, p: int, c: int, q: int) -> int:
        twin = self._state(self.len[p] + 1, self.link[q])
        self.word[twin], self.to[twin] = self.word[q], self.to[q]
        if q in self.more:
            self.more[twin] = dict(self.more[q])
        self.link[q] = twin
        while p >= 0 and self._next(p, c) == q:
            self._lead(p, c, twin)
            p = self.link[p]
        return twin

    def windows(self, s: int):
        """``(length, item)`` of the windows that end in state ``s``."""
        yield self.size[s], self.item[s]
        yield from self.others.get(s, ())

    def steps(self, seq, least: int):
        """``(position, state, matched length)`` where at least ``least`` words match."""
        state = matched = 0
        for i, c in enumerate(seq):
            while (to := self._next(state, c)) < 0 and state:
                state = self.link[state]
                matched = self.len[state]
            if to >= 0:
                state, matched = to, matched + 1
            if matched >= least:
                yield i, state, matched

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Maximal word spans covered by windows, and the items they are from."""
        get = self.vocab.get
        ids = [get(w, -1) for w in words]
        known = np.flatnonzero(np.diff(np.concatenate(([0], np.fromiter((x >= 0 for x in ids), np.int8, len(ids)), [0]))))
        spans, items = [], set()
        for lo, hi in zip(known[::2].tolist(), known[1::2].tolist()):
            if hi - lo < self.least:
                continue
            for i, state, matched in self.steps(ids[lo:hi], self.least):
                longest, s = 0, self.near[state]
                while s > 0:
                    for size, item in self.windows(s):
                        if size <= matched:
                            longest = max(longest, size)
                            items.add(self.keys[item])
                    s = self.near[self.link[s]]
                if longest:
                    start, end = lo + i + 1 - longest, lo + i + 1
                    while spans and spans[-1][1] >= start:
                        start = min(start, spans.pop()[0])
                    spans.append((start, end))
        return spans, items


def _merge(a: list, b: list) -> list:
    out: list = []
    for s, e in sorted((int(s), int(e)) for s, e in [*a, *b]):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_words: int) -> list[list[str]]:
    """The distinct items written in files of about a quarter of a block, and the files of each block."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = items.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("k"), text.cast("binary").alias("t"),
                        F.size(F.split(text, r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")).cast("long").alias("n"))
    total = rows.agg(F.sum("n")).first()[0] or 0
    written = checkpoint(rows.distinct().repartition(max(1, -(-4 * total // block_words)), "k", "t"), "benchmark")
    sizes = written.select(F.input_file_name().alias("file"), "n").groupBy("file").agg(F.sum("n").alias("n")).orderBy("file")
    blocks, held = [], 0
    for r in sizes.toLocalIterator():  # a name and a number a file
        if not blocks or held + r["n"] > block_words:
            blocks.append([])
            held = 0
        blocks[-1].append(r["file"])
        held += r["n"]
    return blocks


def _items(files: list[str]) -> Iterator[tuple[str, list[bytes]]]:
    for uri in files:
        store, path = fs.FileSystem.from_uri(uri)
        for batch in pq.ParquetFile(store.open_input_file(path)).iter_batches(columns=["k", "t"]):
            for k, t in zip(batch["k"].to_pylist(), batch["t"].to_pylist()):
                yield k, words_of(t)


_BUILT: dict[tuple, Automaton] = {}


def _built(token, items, window: int) -> Automaton:
    """The automaton of the block that ``token`` names, kept in the worker."""
    if token not in _BUILT:
        _BUILT.clear()
        _BUILT[token] = Automaton(items, window)
    return _BUILT[token]


FOUND = "n_words long, spans array<array<int>>, items array<string>"


def find_spans(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
               item_text_col: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS,
               out_col: str = "found") -> DataFrame:
    """``docs`` with ``out_col``: a struct of ``n_words``, ``spans`` (covered word
    ranges) and ``items``.  Only texts and findings pass through Python."""
    none = F.struct(F.lit(0).cast("long").alias("n_words"), F.array().cast("array<array<int>>").alias("spans"),
                    F.array().cast("array<string>").alias("items"))
    out, cols = docs.withColumn(out_col, none), [F.col(f"`{c}`") for c in docs.columns]
    for i, files in enumerate(item_blocks(items, item_id_col, item_text_col, block_words) or [[]]):
        if i:
            out = checkpoint(out, "decontaminate")  # one automaton at a time in a worker
        out = out.select(*cols, _pass(out, text_col, out_col, files, window))
    return out


def _pass(df: DataFrame, text_col: str, out_col: str, files: list[str], window: int):
    @F.pandas_udf(FOUND)
    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        auto = _built((window, *files), _items(files), window)
        for texts, before, named in batches:
            rows = []
            for t, s, i in zip(texts, before, named):
                words = words_of(t)
                found, keys = auto.hits(words)
                rows.append((len(words), [list(x) for x in (_merge(s, found) if len(s) else found)], sorted({*i, *keys})))
            yield pd.DataFrame(rows, columns=["n_words", "spans", "items"])

    # run once a row, wherever its result is read
    return run.asNondeterministic()(F.col(f"`{text_col}`").cast("binary"), F.col(f"{out_col}.spans"),
                                    F.col(f"{out_col}.items")).alias(out_col)


def _hit(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda a, s: a + s[1] - s[0])


def _reached(hit: Column, n_words: Column, coverage: float) -> Column:
    return (hit > 0) & (hit >= F.lit(Decimal(str(coverage))) * n_words)


def report(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           coverage: float = COVERAGE, **options) -> DataFrame:
    """Per document: ``id_col, n_words, n_hit, n_items, items_sha256, contaminated``
    (hit words are at least ``coverage`` of all) and ``spans``."""
    found = find_spans(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), items, **options)
    return (found.select(F.col("id").alias(id_col), "found.n_words", _hit(F.col("found.spans")).alias("n_hit"),
                         F.size("found.items").cast("long").alias("n_items"),
                         F.sha2(F.array_join("found.items", ",").cast("binary"), 256).alias("items_sha256"), "found.spans")
            .withColumn("contaminated", _reached(F.col("n_hit"), F.col("n_words"), coverage)))


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", max_span: int = WINDOW,
                  coverage: float = COVERAGE, cut_spans: bool = False, **options) -> DataFrame:
    """``docs`` without contamination.

    Documents whose hit words reach ``coverage`` of all go.  With ``cut_spans``
    the others lose each span of ``max_span`` words or more, separators within
    the span included; else they stay as they are.  Other columns stay as they
    are, whatever their names.
    """
    at = spare(docs, "found")
    found = find_spans(docs, items, text_col, out_col=at, **options)
    kept = found.where(~_reached(_hit(F.col(f"{at}.spans")), F.col(f"{at}.n_words"), coverage))
    if cut_spans:
        @F.pandas_udf("string")
        def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
            return pd.Series([cut_words(t, s, max_span) if t and len(s) else t for t, s in zip(texts, spans)], dtype=object)

        kept = kept.withColumn(text_col, cut(F.col(f"`{text_col}`"), F.col(f"{at}.spans")))
    return kept.drop(at)


def cut_words(text: str, spans, max_span: int) -> str:
    """``text`` without the word spans of at least ``max_span`` words."""
    raw = text.encode("utf-8", "surrogatepass")
    folded = b" " + raw.translate(_FOLD) + b" "
    blank = np.frombuffer(folded, np.uint8) == 32
    edges = np.diff(blank.astype(np.int8))
    starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    out, at = [], 0
    for s, e in spans:
        if e - s >= max_span:
            out.append(raw[at:starts[s]])
            at = ends[e - 1]
    return b"".join([*out, raw[at:]]).decode("utf-8", "surrogatepass")
