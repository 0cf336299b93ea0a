"""Prefix trie of conversations from vertical bitmaps.

``rebuild`` gives the conversations whose trie is wanted; ``trie`` takes any
turns ``(conv, pos, a, b, words)`` with positions from 0 and two hashes of what
a turn says.  Conversations are numbered in ascending order of id; a shard is
``SHARD`` of them in a row and, where conversations are long, ``BLOCK``
positions, so neither many alike nor one very long conversation meets in one
task.  In a shard every (position, turn) has the bitset of the conversations
that say it there.  From a node's bitset, intersections with the postings of
the turns that its members say next give its children, depth first; one
intersection finds one child.  A node's name is the exclusive or of the hashes
of its (position, turn) pairs (128 bits), so equal prefixes of different shards
and blocks meet by name, after each shard has counted its own members.

Sums over subtrees need no walk over the whole trie.  A conversation stands for
(is the smallest member of) the nodes of its path from some depth on.  A node's
subtree saves the words that its members say before that depth, from the node's
own turn on; and its leaves are the members that stand for a childless last
node.  Both are sums over the members of a node, taken from the bitsets.

Defined results: turns without a conversation id belong to none and are left
out; turns of equal number stand by the hash of role and text, repeated ones
are all kept; a negative id counts its 20 from zero; an empty table gives no
rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.llm.common import WORD
from cadenza.operators.ids import dense_ids
from cadenza.session import checkpoint

SHARD = 512
BLOCK = 256
FAMILY = 20
_LOW_BITS = (1 << 33) - 1  # monotonically_increasing_id: partition << 33 | row


def ordered_turns(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """``(conv, pos, a, b, words)``: turns in order, positions from 0.

    Narrow rows are sorted by range and numbered as written; a position is the
    number less the conversation's first, so a long conversation spreads over
    many tasks.
    """
    said = [F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col)]
    narrow = rows.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), F.xxhash64(F.lit(1), *said).alias("a"),
        F.xxhash64(F.lit(2), *said).alias("b"), F.regexp_count(said[1], F.lit(WORD)).cast("long").alias("words"))
    mid = F.monotonically_increasing_id()
    sorted_ = checkpoint(narrow.orderBy("conv", F.col("turn").asc_nulls_first(), "a", "b").select(
        "conv", "a", "b", "words", F.shiftright(mid, 33).alias("part"), mid.bitwiseAND(F.lit(_LOW_BITS)).alias("row")), "turns")
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    parts = sorted_.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    parts = F.broadcast(parts.select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before")))
    numbered = sorted_.join(parts, "part").withColumn("at", F.col("before") + F.col("row"))
    first = numbered.groupBy("conv").agg(F.min("at").alias("first")).withColumnRenamed("conv", "c")
    return numbered.join(first, F.col("conv") == F.col("c")).select("conv", (F.col("at") - F.col("first")).alias("pos"), "a", "b", "words")


def rebuild(turns: DataFrame, family: int = FAMILY) -> tuple[DataFrame, DataFrame]:
    """Every conversation c anew: the first h turns of c - c % ``family``, then
    its own after its first h, h = crc32(c) % 4.  Returns the turns and
    ``(conv, len)`` of all conversations, turnless ones too."""
    lens = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n"))
    convs = lens.select("conv", "n", (F.col("conv") - F.col("conv") % family).alias("base"),
                        (F.crc32(F.col("conv").cast("string").cast("binary")) % 4).alias("h"))
    bases = lens.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    convs = checkpoint(convs.join(bases, "base", "left").select(
        "conv", "n", "base", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("k")), "conversations")
    own = turns.join(convs.select("conv", "h", "k"), "conv").where(F.col("pos") >= F.col("h"))
    own = own.select("conv", (F.col("pos") - F.col("h") + F.col("k")).alias("pos"), "a", "b", "words")
    given = turns.where("pos < 3").withColumnRenamed("conv", "base").join(
        convs.where("k > 0").select("conv", "base", "k"), "base").where(F.col("pos") < F.col("k"))
    made = own.unionByName(given.select("conv", "pos", "a", "b", "words"))
    return made, convs.select("conv", (F.col("k") + F.greatest(F.lit(0), F.col("n") - F.col("h"))).alias("len"))


def _shards(turns: DataFrame, lens: DataFrame, shard: int, block: int) -> DataFrame:
    """The rows that a shard's task reads: a start row (``pos`` null) per
    conversation and block it reaches, with the name and the words of what it
    said before, and its turns."""
    rank = dense_ids(lens.select("conv"), "conv", "rank", null_id=None)
    placed = lens.join(rank, "conv").select(
        "conv", "len", F.floor((F.col("rank") - 1) / shard).alias("shard"), ((F.col("rank") - 1) % shard).cast("int").alias("bit"))
    placed = checkpoint(placed, "shards")
    turns = turns.join(placed.select("conv", "shard", "bit"), "conv").select(
        "conv", "shard", "bit", "pos", F.floor(F.col("pos") / block).alias("block"), "words",
        F.xxhash64(F.lit(3), "pos", "a", "b").alias("x"), F.xxhash64(F.lit(4), "pos", "a", "b").alias("y"))
    blocks = turns.groupBy("conv", "shard", "bit", "block").agg(
        F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"), F.sum("words").alias("words"))
    none = F.lit(0).cast("long")
    first = placed.select("conv", "shard", "bit", none.alias("block"), none.alias("x"), none.alias("y"), none.alias("words"))
    # a block's start is what the blocks before it say
    upto = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    later = blocks.select("conv", "shard", "bit", "block", *[F.coalesce(f(c).over(upto), F.lit(0)).alias(c) for c, f in
                                                             (("x", F.bit_xor), ("y", F.bit_xor), ("words", F.sum))]).where("block > 0")
    starts = first.unionByName(later).join(placed.select("conv", "len"), "conv")
    return (starts.withColumn("pos", F.lit(None).cast("long"))
            .unionByName(turns.withColumn("len", none)))


def _search(key, pdf: pd.DataFrame, block: int) -> pd.DataFrame:
    """The nodes of one shard: depth-first intersections of bitsets."""
    number, base = key[0], int(key[1]) * block
    is_start = pdf["pos"].isna().to_numpy()
    start, said = pdf[is_start], pdf[~is_start]
    conv = {}
    ended: dict[int, int] = {}          # depth: members whose last turn that is
    roots: dict[tuple, tuple] = {}      # name of the prefix: bitset, words before
    for c, bit, length, x, y, words in start[["conv", "bit", "len", "x", "y", "words"]].itertuples(index=False, name=None):
        conv[bit] = c
        ended[length] = ended.get(length, 0) | 1 << bit
        roots[x, y] = (roots.get((x, y), (0, 0))[0] | 1 << bit, words)
    index: dict[tuple, int] = {}        # (position, turn): bitset
    turn_of: dict[tuple, tuple] = {}    # (position, conversation): turn
    speaks: dict[int, int] = {}         # position: conversations that say something there
    for bit, pos, x, y, words in said[["bit", "pos", "x", "y", "words"]].itertuples(index=False, name=None):
        pos, posting = int(pos), (int(pos), x, y)
        index[posting] = index.get(posting, 0) | 1 << bit
        turn_of[pos, bit] = (x, y, words)
        speaks[pos] = speaks.get(pos, 0) | 1 << bit
    size, out = max(conv) // 8 + 1, []

    def node(name, parent, depth, bits, words, before):
        ends, ids = bits & ended.get(depth, 0), []
        while ends:
            low = ends & -ends
            ids.append(str(conv[low.bit_length() - 1]))
            ends ^= low
        out.append((number, *name, *parent, depth, bits.bit_count(), conv[(bits & -bits).bit_length() - 1], words, before,
                    ",".join(ids), bits.to_bytes(size, "little")))

    stack = [(name, base, bits, before) for name, (bits, before) in roots.items()]
    if base == 0:
        everyone = sum(1 << b for b in conv)
        node((0, 0), (0, 0), 0, everyone, 0, 0)
    while stack:
        name, depth, bits, before = stack.pop()
        rest = bits & speaks.get(depth, 0)
        while rest:
            x, y, words = turn_of[depth, (rest & -rest).bit_length() - 1]
            child = bits & index[depth, x, y]
            rest &= ~child
            below = (name[0] ^ x, name[1] ^ y)
            node(below, name, depth + 1, child, words, before)
            if depth + 1 < base + block:
                stack.append((below, depth + 1, child, before + words))
    return pd.DataFrame(out, columns=["shard", "x", "y", "px", "py", "depth", "members", "least", "words", "before", "ends", "bits"])


_NODE = ("shard long, x long, y long, px long, py long, depth long, members long, least long, words long, before long, "
         "ends string, bits binary")


def _ends(nodes: DataFrame) -> DataFrame:
    """``(x, y, depth, ends_sha256)`` of the nodes at which conversations end:
    the shards' lists in ascending order, streamed through one hash a node."""
    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, sha = None, None
        for pdf in batches:
            out = []
            for x, y, depth, ends in pdf[["x", "y", "depth", "ends"]].itertuples(index=False, name=None):
                if (x, y, depth) != at:
                    if at is not None:
                        out.append((*at, sha.hexdigest()))
                    at, sha = (x, y, depth), hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(ends.encode())
            yield pd.DataFrame(out, columns=["x", "y", "depth", "ends_sha256"])
        if at is not None:
            yield pd.DataFrame([(*at, sha.hexdigest())], columns=["x", "y", "depth", "ends_sha256"])

    ended = nodes.where("ends != ''").select("x", "y", "depth", "shard", "ends")
    return ended.repartition("x", "y", "depth").sortWithinPartitions("x", "y", "depth", "shard").mapInPandas(
        stream, "x long, y long, depth long, ends_sha256 string")


def _subtrees(nodes: DataFrame, stands: DataFrame, block: int) -> DataFrame:
    """``(x, y, depth, saved, leaves)`` per shard's node, from its bitset.
    ``stands`` has per conversation the depth from which it stands for its
    nodes, the words it says before, and whether its last node is a leaf."""
    parts = nodes.withColumn("part", F.floor(F.greatest(F.col("depth") - 1, F.lit(0)) / block))
    reached = parts.select(F.col("shard").alias("s"), F.col("part").alias("p")).distinct()
    spread = stands.join(reached, F.col("shard") == F.col("s")).select("s", "p", "bit", "since", "said", "leaf")

    def sums(key, node: pd.DataFrame, who: pd.DataFrame) -> pd.DataFrame:
        if node.empty:
            return pd.DataFrame(columns=["x", "y", "depth", "saved", "leaves"])
        at = who["bit"].to_numpy()
        n = max(8 * max(map(len, node["bits"])), at.max() + 1)  # a later block has the bits of its own members alone
        since, said, leaf = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        since[at], said[at], leaf[at] = who["since"], who["said"], who["leaf"]
        saved, leaves = [], []
        for bits, depth, before in zip(node["bits"], node["depth"], node["before"]):
            member = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little").nonzero()[0]
            leaves.append(int(leaf[member].sum()))
            member = member[since[member] > depth]
            saved.append(int(said[member].sum()) - len(member) * before)
        return node[["x", "y", "depth"]].assign(saved=saved, leaves=leaves)

    return parts.select("shard", "part", "x", "y", "depth", "before", "bits").groupBy("shard", "part").cogroup(
        spread.groupBy("s", "p")).applyInPandas(
            sums, "x long, y long, depth long, saved long, leaves long")


def trie(turns: DataFrame, lens: DataFrame, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """One row per node of the trie over all conversations of ``lens``."""
    name = ["x", "y", "depth"]
    rows = checkpoint(_shards(turns, lens, shard, block), "trie-rows")
    found = rows.groupBy("shard", "block").applyInPandas(lambda key, pdf: _search(key, pdf, block), _NODE)
    found = checkpoint(found, "trie-shards")
    # shards meet by the nodes' names
    merged = found.groupBy(*name).agg(
        F.sum("members").alias("n_convs"), F.min("least").alias("conv_id"), F.min("px").alias("px"), F.min("py").alias("py"),
        F.min("before").alias("before"))
    children = merged.where("depth > 0").groupBy(F.col("px").alias("x"), F.col("py").alias("y"), (F.col("depth") - 1).alias("depth")).agg(
        F.count(F.lit(1)).alias("n_children"))
    nodes = checkpoint(merged.join(children, name, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie-nodes")

    # a conversation stands for its path's nodes from some depth on, or for none
    own = nodes.groupBy(F.col("conv_id").alias("conv")).agg(
        F.min("depth").alias("since"), F.min("before").alias("said"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf"))
    whole = rows.where("pos IS NOT NULL").groupBy("conv").agg(F.sum("words").alias("all_words"))
    who = rows.where("pos IS NULL AND block = 0").select("conv", "shard", "bit", "len")
    stands = who.join(own, "conv", "left").join(whole, "conv", "left").select(
        "shard", "bit", F.coalesce("since", F.col("len") + 1).alias("since"),
        F.coalesce("said", "all_words", F.lit(0)).alias("said"), F.coalesce("leaf", F.lit(0)).alias("leaf"))
    sums = _subtrees(found, stands, block).groupBy(*name).agg(F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"))
    above = nodes.select(F.col("x").alias("ax"), F.col("y").alias("ay"), (F.col("depth") + 1).alias("ad"),
                         F.col("conv_id").alias("parent_conv_id"))
    return (nodes.join(above, (F.col("px") == F.col("ax")) & (F.col("py") == F.col("ay")) & (F.col("depth") == F.col("ad")), "left")
            .join(sums, name).join(_ends(found), name, "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")))


def prefix_trie(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                family: int = FAMILY, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """The trie of the rebuilt conversations of ``rows``."""
    turns = checkpoint(ordered_turns(rows, conv_col, turn_col, role_col, text_col), "ordered-turns")
    made, lens = rebuild(turns, family)
    return trie(made, lens, shard, block)
