"""Filter interaction audit over a sparse document-term matrix.

Tasks read whole texts and build shards: up to ``SHARD_WORDS`` words of
documents, each distinct word numbered inside the shard (bucket by hash bucket,
so that a bucket's numbers are a range), its counts in compressed sparse rows.
A shard is written in rows of bounded size: blocks of
``BLOCK`` matrix entries, and its vocabulary by hash bucket.  The shards'
vocabularies, not their words, are then dealt out by bucket; every distinct word gets a global
number (its rank in the hash bucket plus the words of the buckets before), and
each shard takes the global numbers in place of its own.  A word of every
document stands once per shard there, so no word is a hot key.  Sums and
lengths of the matrix rows are the words and distinct words that conditions A
and B need.  The other conditions are attached to the rows, and documents are
counted by part and by the set of conditions they fail; all filter orders
follow from these at most 32 counts a part.

Defined results: a null text is empty, a null language the part ``""``; a
document is good or toxic if any of its labels says so; rows that repeat are
documents of their own; a null id is smaller than none and has no smaller one
(such a row never fails E); an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from itertools import chain, pairwise, permutations
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.session import checkpoint, small_batches

SHARD_WORDS = 3_000_000
#: words that are held as Python objects before they are numbered
HELD_WORDS = 100_000
#: matrix entries of a table row, if they are of several documents; at 12 bytes each, a row is under 512 kB,
#: from which on heaps of up to 2 GB keep an object in regions of its own
BLOCK = 32_000
#: blocks that a task gives to Spark at once
SENT_BLOCKS = 8
#: bytes of texts, words or blocks that go to a Python worker at once, and of a row group of shards
BATCH_BYTES = 8 << 20
LETTERS = "ABCDE"
#: numbers that are taken of a text's UTF-8 bytes while it is read: code points, A to Z, the signs of condition D
_LATER = bytes(range(0x80, 0xC0))
SHAPE: dict[str, Callable[[bytes], int]] = {
    "chars": lambda t: len(t.translate(None, _LATER)),
    "upper": lambda t: len(t) - len(t.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")),
    "signs": lambda t: len(t) - len(t.translate(None, b"#$%&*|")),
}


def _shards(docs: DataFrame, keep: list[str], shard_words: int, buckets: int, shape: dict) -> DataFrame:
    """``(shard, bucket, vocab, start, docs, indptr, indices, counts)``.  Rows without
    ``bucket`` are blocks of a shard's documents: ``docs`` has the columns ``keep``
    and ``shape`` of each; the others hold the words ``vocab`` of one hash bucket,
    which have the numbers from ``start`` on in the shard."""
    kinds = dict(docs.dtypes)
    struct = ", ".join([*(f"`{c}`: {kinds[c]}" for c in keep), *(f"`{c}`: bigint" for c in shape)])
    ints = pa.list_(pa.int32())
    fixed = {"bucket": pa.int32(), "vocab": pa.list_(pa.string()), "start": pa.int32(), "indptr": ints, "indices": ints, "counts": ints}

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        found, known, ends, counts, kept, words = [], [], [0], [], [], 0

        def of(values, bounds=None):
            return pa.ListArray.from_arrays(pa.array([0, len(values)] if bounds is None else bounds, pa.int32()), values)

        def rows(n, kinds, **columns):
            own = [pa.array([(task << 32) + made] * n, pa.int64())]
            return pa.RecordBatch.from_arrays([*own, *(columns.get(c, pa.nulls(n, t)) for c, t in kinds.items())], ["shard", *kinds])

        def coded_words(some):
            return pa.array(some, pa.binary()).dictionary_encode()

        def shard():
            coded = pa.concat_arrays([*known, coded_words(found)])
            known.clear()
            code = coded.dictionary
            each = chain.from_iterable(code.slice(i, HELD_WORDS).to_pylist() for i in range(0, len(code), HELD_WORDS))
            bucket = (np.fromiter(map(crc32, each), np.int64, len(code)) % buckets).astype(np.int32)
            dealt = np.argsort(bucket, kind="stable").astype(np.int32)
            bounds = np.searchsorted(bucket[dealt], np.arange(buckets + 1))
            place = np.empty(len(code), np.int32)
            place[dealt] = np.arange(len(code), dtype=np.int32)
            rest = pa.Table.from_batches(kept).combine_chunks().to_batches()[0]
            rest = pa.StructArray.from_arrays(rest.columns, names=rest.schema.names)
            kinds = fixed | {"docs": pa.list_(rest.type)}
            some = np.flatnonzero(np.diff(bounds))
            if len(some):
                bounds = bounds[[*some, -1]]
                yield rows(len(some), kinds, bucket=pa.array(some, pa.int32()), start=pa.array(bounds[:-1], pa.int32()),
                           vocab=of(code.take(pa.array(dealt)).cast(pa.string()), bounds))
            number, upto, lo = np.concatenate([np.empty(0, np.int32), *counts]), np.array(ends), 0
            index = coded.indices.to_numpy()
            while lo < len(rest):
                cuts = [lo]  # documents where blocks begin
                while cuts[-1] < len(rest) and len(cuts) <= SENT_BLOCKS and upto[cuts[-1]] - upto[lo] < BLOCK * SENT_BLOCKS:
                    cuts.append(max(cuts[-1] + 1, int(np.searchsorted(upto, upto[cuts[-1]] + BLOCK, "right")) - 1))
                hi, bounds, span = cuts[-1], upto[cuts] - upto[lo], slice(upto[lo], upto[cuts[-1]])
                rising = np.concatenate([upto[x:y + 1] - upto[x] for x, y in pairwise(cuts)])
                yield rows(len(cuts) - 1, kinds, docs=of(rest[lo:hi], np.array(cuts) - lo),
                           indptr=of(pa.array(rising, pa.int32()), np.array(cuts) - lo + np.arange(len(cuts))),
                           indices=of(pa.array(place[index[span]]), bounds), counts=of(pa.array(number[span], pa.int32()), bounds))
                lo = hi

        for batch in batches:
            texts = batch.column("text")
            measured = [pa.array([f(t.as_py()) for t in texts], pa.int64()) for f in shape.values()]
            rest = pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *measured], [*keep, *shape])
            start = 0
            for i, text in enumerate(texts):
                every = text.as_py().split()  # bytes split at the six ASCII blanks
                times = Counter(every)
                found.extend(times)
                counts.append(np.fromiter(times.values(), np.int32, len(times)))
                ends.append(ends[-1] + len(times))
                words += len(every)
                if len(found) >= HELD_WORDS:
                    known.append(coded_words(found))
                    found = []
                if words >= shard_words:
                    kept.append(rest.slice(start, i + 1 - start))
                    yield from shard()
                    made, start = made + 1, i + 1
                    found, known, ends, counts, kept, words = [], [], [0], [], [], 0
                    _release()
            if start < batch.num_rows:
                kept.append(rest.slice(start))
        if kept:
            yield from shard()
            found, known, ends, counts, kept = [], [], [0], [], []
        _release()

    return docs.select(*keep, F.col("text").cast("binary").alias("text")).mapInArrow(
        build, "shard long, bucket int, vocab array<string>, start int, indptr array<int>, indices array<int>, "
               f"counts array<int>, docs array<struct<{struct}>>")


def _release() -> None:
    """Gives back what Arrow holds of freed memory: the workers of earlier stages stay beside those that run."""
    pa.default_memory_pool().release_unused()


def _numbers() -> defaultdict:
    """Numbers its keys 0, 1, 2, ... as they are first asked for."""
    code = defaultdict()
    code.default_factory = code.__len__
    return code


def _bounds(lists: pa.ListArray) -> pa.Array:
    """Where the lists begin and end in ``lists.flatten()``."""
    ends = lists.offsets.to_numpy()
    return pa.array(ends - ends[0], pa.int32())


def _lists(parts: list, kind: pa.DataType) -> pa.ListArray:
    """A list array of one array of ``kind`` per row."""
    ends = np.cumsum([0, *map(len, parts)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.concat_arrays([pa.array([], kind), *(pa.array(x, kind) for x in parts)]))


def _codes(shards: DataFrame) -> DataFrame:
    """``(shard, start, rank, offset, new, first)`` per shard and hash bucket: the numbers
    of the shard's words from ``start`` on are ``offset`` and ``rank``; the words ``new``
    stand here first, with the ranks from ``first`` on."""
    pieces = shards.where("bucket IS NOT NULL").select("shard", "bucket", "vocab", "start")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, code = None, _numbers()
        for batch in batches:
            ranks, news, firsts = [], [], []
            for bucket, vocab in zip(batch.column("bucket").to_pylist(), batch.column("vocab")):
                if bucket != at:
                    at, code = bucket, _numbers()
                first, words = len(code), vocab.values.cast(pa.binary()).to_pylist()
                rank = np.fromiter(map(code.__getitem__, words), np.int32, len(words))
                ranks.append(rank)
                # the words of a shard are distinct: each new one stands once
                news.append(vocab.values.take(pa.array(np.flatnonzero(rank >= first))))
                firsts.append(first)
            yield pa.RecordBatch.from_arrays(
                [batch.column("shard"), batch.column("bucket"), batch.column("start"), _lists(ranks, pa.int32()),
                 _lists(news, pa.string()), pa.array(firsts, pa.int64())],
                ["shard", "bucket", "start", "rank", "new", "first"])
        _release()

    # a bucket is read in one go, its words alone are held; the numbers are written, so nothing renumbers them
    coded = checkpoint(pieces.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        number, "shard long, bucket int, start int, rank array<int>, new array<string>, first long"), "word-codes")
    ahead = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # one row a bucket
    offsets = coded.groupBy("bucket").agg(F.sum(F.size("new")).alias("words"))
    offsets = offsets.select("bucket", F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("offset"))
    return coded.join(F.broadcast(offsets), "bucket")


def document_term_matrix(docs: DataFrame, keep: list[str], text_col: str = "text", shard_words: int = SHARD_WORDS,
                         shape: dict[str, Callable[[bytes], int]] | None = None) -> tuple[DataFrame, DataFrame]:
    """The matrix in blocks of its shards ``(shard, docs, indptr, indices, counts)`` and its
    dictionary ``(id, word)``.

    A row is a block of a shard: ``docs`` holds the columns ``keep`` of its documents and the numbers
    that ``shape`` takes of their bytes, ``indptr`` the bounds of their rows,
    ``indices`` global word numbers, ``counts`` how often each word stands in
    the document.  Vocabularies are dealt to ``spark.sql.shuffle.partitions`` buckets.
    """
    own = docs.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    with small_batches(docs.sparkSession, BATCH_BYTES):
        shards = checkpoint(_shards(own, keep, shard_words, buckets, shape or {}), "term-shards", {"parquet.block.size": BATCH_BYTES})
        codes = _codes(shards)
    left = shards.where("bucket IS NULL").drop("bucket", "vocab", "start")

    def globally(shard: pa.Table, words: pa.Table) -> pa.Table:
        if not shard.num_rows:
            return shard
        number = np.zeros(sum(len(x) for x in words.column("rank")), np.int64)
        for start, rank, offset in zip(words.column("start").to_pylist(), words.column("rank"), words.column("offset").to_pylist()):
            number[start:start + len(rank)] = rank.values.to_numpy() + np.int64(offset)
        blocks, at = [], shard.schema.get_field_index("indices")
        for batch in shard.to_batches(max_chunksize=SENT_BLOCKS):
            local = batch.column(at)
            made = pa.ListArray.from_arrays(_bounds(local), pa.array(number[local.flatten().to_numpy()], pa.int64()))
            blocks.append(batch.set_column(at, "indices", made))
        _release()
        return pa.Table.from_batches(blocks)

    matrix = left.groupBy("shard").cogroup(codes.select("shard", "start", "rank", "offset").groupBy("shard")).applyInArrow(
        globally, f"shard long, docs {dict(left.dtypes)['docs']}, indptr array<int>, indices array<long>, counts array<int>")
    words = codes.select((F.col("offset") + F.col("first")).alias("base"), F.posexplode("new").alias("at", "word"))
    return matrix, words.select((F.col("base") + F.col("at")).alias("id"), "word")


def row_sums(matrix: DataFrame) -> DataFrame:
    """The documents of a matrix with ``words`` (sum of the row) and ``distinct`` (its entries)."""
    def sums(doc: Column, i: Column) -> Column:
        lo, distinct = F.col("indptr")[i], F.col("indptr")[i + 1] - F.col("indptr")[i]
        words = F.aggregate(F.slice("counts", lo + 1, distinct), F.lit(0).cast("long"), lambda total, n: total + n)
        return F.struct(*(doc[c].alias(c) for c in names), words.alias("words"), distinct.cast("long").alias("distinct"))

    # not in Python: these tasks have a worker each already, for the global numbers
    names = matrix.schema["docs"].dataType.elementType.names
    return matrix.select(F.inline(F.transform("docs", sums)))


def failed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
           shard_words: int = SHARD_WORDS) -> DataFrame:
    """``(id, part, mask)`` per row; bit i of ``mask`` is set if filter i of ``LETTERS`` fails."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("text"),
                       F.md5(text.cast("binary")).alias("same"))
    matrix, _ = document_term_matrix(rows, ["id", "part", "same"], "text", shard_words, SHAPE)
    with small_batches(docs.sparkSession, BATCH_BYTES):
        stats = checkpoint(row_sums(matrix), "row-sums")
    copies = (stats.select("id", "same").groupBy("same").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
              .where("n > 1").select("same", "first"))
    fails = [F.col("words") < 200, F.col("distinct") * 100 < F.col("words") * 50,
             F.col("upper") * 100 > F.col("chars") * 3, F.col("signs") > 0,
             F.coalesce(F.col("id") > F.col("first"), F.lit(False))]
    mask = sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))
    return stats.join(copies, "same", "left").select("id", "part", mask.alias("mask"))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
          shard_words: int = SHARD_WORDS) -> DataFrame:
    """Per part, order of the five filters and step: documents kept, removed,
    failing though removed earlier, failing this filter alone, good and toxic
    ones lost, and the filter's removals over all orders."""
    marks = (labels.select(F.col(id_col).alias("of"), F.col("quality"), F.col("toxic")).where("of IS NOT NULL").groupBy("of")
             .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")))
    rows = failed(docs, id_col, text_col, part_col, shard_words).join(marks, F.col("id") == F.col("of"), "left")
    zero = F.lit(0)
    counts = rows.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("good", zero)).alias("good"),
                                              F.sum(F.coalesce("toxic", zero)).alias("toxic"))
    # at most 32 sets of failures a part
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("sets"))
    orders = F.array(*[F.lit("".join(p)) for p in permutations(LETTERS)])
    steps = (parts.withColumn("filter_order", F.explode(orders))
             .select("part", "sets", "filter_order", F.posexplode(F.split("filter_order", "")).alias("at", "letter")))
    bit = lambda letter: F.call_function("shiftleft", F.lit(1), F.ascii(letter) - 65)
    earlier = F.aggregate(F.slice(F.split("filter_order", ""), F.lit(1), F.col("at")), F.lit(0), lambda acc, x: acc + bit(x))
    steps = steps.select("part", "sets", "filter_order", (F.col("at") + 1).alias("step"), bit(F.col("letter")).alias("own"),
                         earlier.alias("earlier"))
    own, before = F.col("own"), F.col("earlier")

    def total(chosen, value=lambda s: s["n"]) -> Column:
        return F.aggregate(F.filter("sets", chosen), F.lit(0).cast("long"), lambda acc, s: acc + value(s))

    def fails(s, bits):
        return s["mask"].bitwiseAND(bits) != 0
    removed = lambda s: fails(s, own) & ~fails(s, before)
    # of the 120 orders, a filter comes first among n failing ones in 120 / n
    first = lambda s: F.call_function("div", s["n"] * 120, F.bit_count(s["mask"]).cast("long"))
    return steps.select(
        "part", "filter_order", F.col("step").cast("int").alias("step"),
        total(lambda s: ~fails(s, own) & ~fails(s, before)).alias("kept"), total(removed).alias("removed"),
        total(lambda s: fails(s, own) & fails(s, before)).alias("redundant"),
        total(lambda s: s["mask"] == own).alias("unique_fails"),
        total(removed, lambda s: s["good"]).alias("good_lost"), total(removed, lambda s: s["toxic"]).alias("toxic_lost"),
        total(lambda s: fails(s, own), first).alias("shapley"))
