"""Document fingerprints: bottom-k sketches of shingle hashes, in DataFrame
functions alone.

Words are runs of ``[^\\x20\\x09-\\x0D]`` of the lower-cased text, cut every
``PIECE`` characters, so that a text without spaces has shingles too.  A
shingle is ``WIDTH`` words in a row (fewer words: the whole sequence; none: no
shingle), hashed by a chain of XXH64 over its words.  The sketch holds the
``K`` smallest distinct hashes in ascending order, so it depends on the set of
shingles alone and equal texts have equal sketches.

The sketch of a union is the bottom k of the joined sketches (``merge``,
``merge_groups``).  Two sketches estimate the resemblance (share of common
shingles among all), the containment of one in the other, and each its number
of distinct shingles; the numbers are exact where a sketch is not full.

Defined results: a null text is an empty one, whose sketch is empty; two empty
sketches resemble each other by 1, an empty and another one by 0.  In
``compare_edits`` documents stand in ascending order of id, null ids first,
those that share an id by the hash of their text; rows that share id and text
are one document and each return its row; a sole document is its own next one.
An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.operators.ids import dense_ids

K = 128
WIDTH = 5
PIECE = 32
_SPAN = 2.0 ** 64


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def sketch(text: Column, k: int = K, width: int = WIDTH) -> Column:
    """The ``k`` smallest shingle hashes of a text, ascending."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(rf"[^\x20\x09-\x0D]{{1,{PIECE}}}"), F.lit(0))

    def lowest(w):
        starts = F.sequence(F.lit(0), F.greatest(F.size(w) - width, F.lit(0)))
        hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(width)]))
        return F.when(F.size(w) > 0, F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)).otherwise(
            F.array().cast("array<bigint>"))
    return _let(words, lowest)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union of two documents' shingles."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_groups(sketches: DataFrame, keys: list[str], sketch_col: str = "sketch", k: int = K) -> DataFrame:
    """One sketch per group of documents, ``keys`` and ``sketch_col``.

    Repeated hashes go before the shuffle, which is dealt by (group, hash); each
    task then passes on the ``k`` smallest of a group, so no group of any size
    meets in one task.
    """
    hashes = sketches.select(*keys, F.explode_outer(sketch_col).alias("_hash")).distinct()
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("_hash").asc_nulls_last()))
    return (hashes.withColumn("_n", first).where(F.col("_n") <= k).groupBy(*keys)
            .agg(F.sort_array(F.collect_list("_hash")).alias(sketch_col)))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Number of distinct shingles: exact below ``k``, else (k - 1) over the share of the hash range that k hashes fill."""
    share = (F.element_at(a, -1).cast("double") + F.lit(_SPAN / 2)) / F.lit(_SPAN)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(F.lit(float(k - 1)) / share)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Common shingles over all shingles of two documents."""
    def shared(low):
        common = F.filter(F.array_intersect(a, b), lambda h: h <= F.element_at(low, -1))
        return F.when(F.size(low) == 0, 1.0).otherwise(F.size(common) / F.size(low))
    return _let(merge(a, b, k), shared)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Share of the first document's shingles that the second one has."""
    def of(r):
        na, nb = distinct_shingles(a, k), distinct_shingles(b, k)
        return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), r * (na + nb) / (r + 1) / na))
    return _let(resemblance(a, b, k), of)


def to_text(a: Column) -> Column:
    """A sketch as text: base64 of its hashes, eight bytes each."""
    made = F.base64(F.unhex(F.array_join(F.transform(a, lambda h: F.lpad(F.hex(h), 16, "0")), "")))
    return F.translate(made, "\r\n", "")  # no line breaks


def from_text(fingerprint: Column) -> Column:
    """The sketch that ``to_text`` has written."""
    def hashes(digits):
        at = F.filter(F.sequence(F.lit(0), F.length(digits)), lambda i: (i % 16 == 0) & (i < F.length(digits)))
        return F.transform(at, lambda i: F.conv(F.substr(digits, i + 1, F.lit(16)), 16, -10).cast("long"))
    return _let(F.hex(F.unbase64(fingerprint)), hashes)


def fingerprint_documents(docs: DataFrame, text_col: str = "text", sketch_col: str = "sketch", k: int = K, width: int = WIDTH) -> DataFrame:
    """``docs`` with the sketch of each text added."""
    return docs.withColumn(sketch_col, sketch(F.col(text_col), k, width))


def compare_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, width: int = WIDTH) -> DataFrame:
    """Per row the sketches of its text and of its edited text (the last quarter
    of the characters replaced by the first ones of the next document) and
    how much its sketch resembles that one and the next document's.

    Only ids, hashes and lengths are sorted for the next document.  Texts are
    dealt out once by id and hash; a document then sends the characters wanted
    and its sketch to the one before it, where the join finds the texts dealt
    by its own keys.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    own = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
           .select("id", text.alias("text"), F.coalesce(F.col("id").cast("string"), F.lit("\u0000")).alias("b"),
                   F.xxhash64(text).alias("h"), F.length(text).cast("long").alias("n")))
    # both readers take the same columns, so the exchange of the texts is made once
    one = own.groupBy("b", "h").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies")).where("copies > 0")
    keys = dense_ids(own.select("id", "h", "n", "b"), ["id", "h", "n", "b"], "r", null_id=None)
    total = F.lit(max(1, keys.count()))
    before = keys.select((F.col("r") % total + 1).alias("r"), F.col("id").alias("to_id"), F.col("b").alias("to_b"),
                         F.col("h").alias("to_h"), F.floor(F.col("n") / 4).cast("int").alias("wanted"))
    told = keys.select("b", "h", "r").join(before, "r").drop("r")
    heads = one.join(told, ["b", "h"]).select("to_id", "to_b", "to_h", "wanted", F.left("text", F.col("wanted")).alias("head"),
                                              sketch(F.col("text"), k, width).alias("next_sketch"))
    both = one.join(heads, (F.col("b") == F.col("to_b")) & (F.col("h") == F.col("to_h")))
    n = F.length("text")
    both = both.select(F.col("to_id").alias("id"), "copies", n.cast("long").alias("n_chars"), "next_sketch", "text",
                       F.concat(F.left("text", n - F.col("wanted")), "head").alias("edited"))
    made = both.select("id", "copies", "n_chars", "next_sketch", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                       sketch(F.col("text"), k, width).alias("sketch"), sketch(F.col("edited"), k, width).alias("edited_sketch"))
    return made.select(F.col("id").alias(id_col), "n_chars", "edited_sha256", "sketch", "edited_sketch",
                       resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
                       resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"),
                       containment(F.col("edited_sketch"), F.col("sketch"), k).alias("edited_in_own"),
                       distinct_shingles(F.col("sketch"), k).alias("n_shingles"),
                       F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")).drop("copy")


def digest(compared: DataFrame) -> DataFrame:
    """The rows of ``compare_edits`` with fingerprints as text."""
    first = [c for c in compared.columns if c not in ("sketch", "edited_sketch", "near_edited", "near_next", "edited_in_own", "n_shingles")]
    return compared.select(*first, to_text(F.col("sketch")).alias("fingerprint"), to_text(F.col("edited_sketch")).alias("edited_fingerprint"),
                           "near_edited", "near_next", "edited_in_own", "n_shingles")
