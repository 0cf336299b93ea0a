"""Secret scan: fixed patterns, and character Markov models.

Fixed patterns find credentials that are assigned to a telling name, access
keys and long hexadecimal runs.  Two first-order character models, one of
random strings and one of ordinary identifiers, then judge every other token of
16 characters or more, words too: where the mean log-likelihood ratio per
transition passes ``THRESHOLD``, the token is reported as kind ``random``.
Tokens that touch a span of a fixed pattern are left to it.

The models are trained from labelled samples: seeded random strings over the
usual key alphabets, lower-case letters alone and in groups among them, together
with the values that the fixed patterns found in a bounded hash sample of the corpus (``SAMPLE`` documents), against the other
identifiers of that sample, public names of the standard library and long
numbers (dates, counters, repeated digits).

Defined results: a null text is empty; offsets count code points, ends
exclusive; repeated rows each give a row.
"""

from __future__ import annotations

import itertools
import re
import string
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import hash_sample

SAMPLE = 2_000
THRESHOLD = 0.6
KINDS = ("assign", "access", "hex", "random")
ALPHABET = string.ascii_letters + string.digits + "+/_=-."
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_TELLING = ("password", "passwd", "secret", "token", "apikey", "api_key")
_TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}")
#: ordinary long identifiers of code and markup (fixed values)
IDENTIFIERS = ("getElementById", "application_configuration", "content-security-policy", "std-vector-iterator",
               "MAX_CONNECTION_TIMEOUT_SECONDS", "org/apache/commons/lang/StringUtils", "user_account_settings",
               "test_returns_empty_list_when_input_is_none", "addEventListener", "ThreadPoolExecutorFactory",
               "node_modules/typescript/lib", "background-color-transparent", "internationalization")
_ORDINARY = re.compile(r"[A-Za-z0-9+/_=-]{3,}")
_INDEX = np.full(128, len(ALPHABET), np.int64)
_INDEX[[ord(c) for c in ALPHABET]] = range(len(ALPHABET))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of the fixed patterns by start, then kind."""
    found = []
    low = text.lower()
    if any(w in low for w in _TELLING):
        found += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    # whole runs: a shorter run holds no longer one, so the length can stand in the pattern
    found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def _codes(token: str) -> np.ndarray:
    return _INDEX[np.frombuffer(token.encode("ascii"), np.uint8)]


def transitions(tokens) -> np.ndarray:
    """How often each character follows each other one."""
    n = len(ALPHABET) + 1
    counts = np.zeros((n, n))
    for t in tokens:
        c = _codes(t)
        np.add.at(counts, (c[:-1], c[1:]), 1.0)
    return counts


def ratio_table(random_counts: np.ndarray, ordinary_counts: np.ndarray, prior: float = 0.2) -> np.ndarray:
    """Log-likelihood ratio of each character transition, random over ordinary."""
    def logp(counts):
        return np.log((counts + prior) / (counts + prior).sum(axis=1, keepdims=True))

    return logp(random_counts) - logp(ordinary_counts)


def random_tokens(n: int = 4_000, seed: int = 13) -> list[str]:
    rng = np.random.default_rng(seed)
    sets = [string.ascii_letters + string.digits, string.hexdigits[:16], string.ascii_uppercase + string.digits,
            string.ascii_letters + string.digits + "+/", string.ascii_letters + string.digits + "_-"]
    out = ["".join(rng.choice(list(sets[i % len(sets)]), rng.integers(16, 48))) for i in range(n)]
    low = ["".join(rng.choice(list(string.ascii_lowercase), rng.integers(16, 48))) for _ in range(n // 5)]
    # keys are also written in groups
    groups = [re.sub(rf"(.{{{size}}})(?=.)", rf"\1{sign}", t)
              for t, size, sign in zip(low, itertools.cycle((4, 5, 6, 8)), itertools.cycle("--_/-"))]
    return out + low + groups[:n // 8]


def numbers(n: int = 1_500, seed: int = 29) -> list[str]:
    """Ordinary long numbers: dates and times run together or with dashes,
    padded counters, one digit or a short group again and again, running digits."""
    rng, out = np.random.default_rng(seed), []
    for i in range(n):
        y, mo, d, h, mi, s, k = (int(x) for x in rng.integers((1970, 1, 1, 0, 0, 0, 0), (2040, 13, 29, 24, 60, 60, 100_000)))
        date, time, digit = f"{y}{mo:02}{d:02}", f"{h:02}{mi:02}{s:02}", str(k % 10)
        out.append((date + time + "0" * (k % 9 + 2), f"{y}-{mo:02}-{d:02}-{h:02}-{mi:02}-{s:02}", f"{k:020}", digit * (16 + k % 24),
                    f"{k % 1000:03}" * (6 + k % 4), ("0123456789" * 4)[k % 10:][:16 + k % 9], f"{date}_{time}_{k:06}",
                    f"{k % 97}-{k % 13}-{k % 5}/{date}/{k:05}", f"{k:05}000000000000")[i % 9])
    return out


def identifiers() -> list[str]:
    """Ordinary identifiers: the public names of some standard modules, alone
    and joined in the usual styles, the fixed ones, and long numbers."""
    import argparse
    import builtins
    import concurrent.futures
    import http.client
    import logging.handlers
    import os
    import unittest.mock
    import xml.dom.minidom

    names = sorted({n for m in (argparse, builtins, concurrent.futures, http.client, logging.handlers, os, unittest.mock,
                                xml.dom.minidom, re, string) for n in dir(m) if not n.startswith("_") and n.isascii()})
    pairs = list(zip(names, names[1:] + names[:1], names[7:] + names[:7]))
    joined = ["_".join(p) for p in pairs] + ["-".join(p).lower() for p in pairs] + ["/".join(p) for p in pairs]
    joined += ["".join(w.title().replace("_", "") for w in p) for p in pairs]
    return [*names, *joined, *IDENTIFIERS, *numbers()]


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE) -> np.ndarray:
    """The ratio table from a bounded sample of documents, each read whole.
    The driver gets counts of transitions, whose number the alphabet bounds."""
    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for text in pdf["text"].fillna(""):
                spans = base_spans(text)
                inside = np.zeros(len(text) + 1, bool)
                for s, e, _ in spans:
                    inside[s:e] = True
                # of an assigned value the part after the name and the sign
                rows = {(1, (_ASSIGN.match(text, s)[2] if k == "assign" else text[s:e])) for s, e, k in spans}
                rows |= {(0, m[0]) for m in _ORDINARY.finditer(text) if not inside[m.start()]}
                if rows:
                    yield pd.DataFrame(sorted(rows), columns=["label", "token"])

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((2, len(ALPHABET) + 1, len(ALPHABET) + 1))
        for pdf in batches:
            for label in (0, 1):
                total[label] += transitions(pdf["token"][pdf["label"] == label])
        label, a, b = np.nonzero(total)
        yield pd.DataFrame({"label": label, "a": a, "b": b, "n": total[label, a, b].astype(np.int64)})

    rows = hash_sample(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), sample_docs, "id")
    got = (rows.select("text").mapInPandas(pick, "label int, token string").distinct()
           .mapInPandas(count, "label int, a int, b int, n long").groupBy("label", "a", "b").agg(F.sum("n").alias("n")).collect())
    seen = np.zeros((2, len(ALPHABET) + 1, len(ALPHABET) + 1))
    for r in got:
        seen[r["label"], r["a"], r["b"]] = r["n"]
    return ratio_table(transitions(random_tokens()) + seen[1], transitions(identifiers()) + seen[0])


def markov_spans(text: str, ratio: np.ndarray, taken: list, threshold: float) -> list[tuple[int, int, str]]:
    out, k = [], 0
    for m in _TOKEN.finditer(text):
        s, e = m.span()
        while k < len(taken) and taken[k][1] <= s:
            k += 1
        if any(b < e and s < f for b, f, _ in taken[k:k + 4]):
            continue
        token = m[0].strip("=-_/+")
        if len(token) < 16:
            continue
        c = _codes(token)
        if ratio[c[:-1], c[1:]].mean() > threshold:
            at = s + m[0].index(token)
            out.append((at, at + len(token), "random"))
    return out


@lru_cache(maxsize=4)
def _table(raw: bytes) -> np.ndarray:
    n = len(ALPHABET) + 1
    return np.frombuffer(raw).reshape(n, n)


def scan(docs: DataFrame, ratio: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
         threshold: float = THRESHOLD) -> DataFrame:
    """``id_col`` and ``found``: an array of ``(kind, start, end)`` by start, then kind."""
    raw = ratio.tobytes()

    @F.pandas_udf("array<struct<kind:string,start:int,end:int>>")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = _table(raw)
        for texts in batches:
            out = []
            for t in texts:
                t = t or ""
                base = base_spans(t)
                # spans of several kinds may nest: ends in order of starts are made rising for the sweep
                reach, tops = 0, []
                for s, e, k in base:
                    reach = max(reach, e)
                    tops.append((s, reach, k))
                all_spans = sorted(base + markov_spans(t, table, tops, threshold), key=lambda s: (s[0], KINDS.index(s[2])))
                out.append([{"kind": k, "start": s, "end": e} for s, e, k in all_spans])
            yield pd.Series(out)

    return docs.select(F.col(id_col), udf(F.col(text_col)).alias("found"))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The counts and the joined spans of ``scan``."""
    base = F.filter("found", lambda x: x["kind"] != "random")
    text = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("found", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(F.col(id_col), *[count(k) for k in KINDS[:3]],
                        F.sha2(text(base).cast("binary"), 256).alias("base_sha256"), text("found").alias("spans"), count(KINDS[3]))
