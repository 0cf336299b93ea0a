"""Mixing sources to target weights by weighted fair queueing.

Sources stand by code point, null last, and weigh ``weights`` in turn.  Their
targets share the total of all sizes by weight; a target stops at
``max_epochs`` times its source's size and the excess is shared again by weight
among the others (water filling, solved in closed form over the sources).

Every source is a queue of its documents in a seeded shuffle, up to
``max_epochs`` times over.  A document enters as packets of at most a
thousandth of the source's target; a packet's virtual finish time is the
source's words up to its end divided by the target.  All packets are ordered by
finish time and the order is cut where the total budget is reached.

A source's queue and the global order are range-partitioned (by the shuffle
hash, by virtual time); running totals come from totals per range plus an order
inside a range, so no source and no order ever meets in one task.

Defined results: a null text has size 0 and takes nothing; a source whose
documents are all empty has target 0; null and repeated ids are rows like any
other (ties of the shuffle are broken by size); an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.llm.common import WORD
from cadenza.session import checkpoint

WEIGHTS = (1, 2, 3)
EPOCHS = 3
PACKETS = 1_000
RANGES = 4_096
ROWS_IN_RANGE = 20_000


def targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = EPOCHS) -> DataFrame:
    """``(source, source_size)`` with ``weight`` and ``target`` added; one row per source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (turn + 1).cast("int"))
    cap = F.lit(max_epochs) * F.col("source_size")
    # sources reach their cap in the order of cap / weight
    order = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
             / F.sum("weight").over(rest))
    out = (sizes.withColumn("weight", w).withColumn("cap", cap).withColumn("level", level)
           .withColumn("capped", F.col("level") * F.col("weight") > F.col("cap")))
    # the first source that its share does not fill sets the level of all after it
    free = F.min(F.when(~F.col("capped"), F.col("cap") / F.col("weight"))).over(every)
    share = F.max(F.when(~F.col("capped") & (F.col("cap") / F.col("weight") == F.col("free")), F.col("level"))).over(every)
    return (out.withColumn("free", free).withColumn("share", share)
            .withColumn("target", F.when(F.col("cap") / F.col("weight") < F.col("free"), F.col("cap").cast("double"))
                        .otherwise(F.least(F.col("share") * F.col("weight"), F.col("cap").cast("double"))))
            .select("source", "source_size", "weight", "target"))


def queue(docs: DataFrame, seed: int = 17) -> DataFrame:
    """``docs`` (``id, source, size``) with ``start``: the words before the
    document in its source's shuffled queue."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.md5(key.cast("binary")), 1, 15), 16, 10).cast("long")
    docs = docs.withColumn("h", h).withColumn("part", F.shiftright("h", 48))
    parts = docs.groupBy("source", "part").agg(F.sum("size").alias("words"))
    ahead = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("source").alias("s"), F.col("part").alias("p"),
                         F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("offset"))
    inside = (Window.partitionBy("source", "part").orderBy("h", "id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    ranked = docs.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return (ranked.join(parts, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")))
            .withColumn("start", F.col("offset") + F.col("inside")).drop("s", "p", "part", "offset", "inside", "h"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, max_epochs: int = EPOCHS, seed: int = 17) -> DataFrame:
    """Per row: ``id_col, size, source_size, target, taken`` and ``source``."""
    rows = checkpoint(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                                  F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size")), "mix")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = checkpoint(targets(sizes, weights, max_epochs), "mix-targets")
    queued = checkpoint(queue(rows, seed), "mix-queue")
    named = plan.select(F.col("source").alias("s"), "source_size", "target")
    joined = queued.join(named, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    limits = _limits(joined, max_epochs)
    limits = limits.select(F.col("source").alias("s"), F.col("words").alias("limit"))
    taken = F.lit(0).cast("long")
    for epoch in range(max_epochs):
        at = F.lit(epoch) * F.col("source_size") + F.col("start")
        taken = taken + F.greatest(F.lit(0), F.least(F.coalesce("limit", F.lit(0)) - at, F.col("size")))
    return (joined.join(limits, F.col("source").eqNullSafe(F.col("s")), "left")
            .select(F.col("id").alias(id_col), "source", "size", "source_size", "target", taken.alias("taken")))


def _limits(joined: DataFrame, max_epochs: int) -> DataFrame:
    """Words that the cut leaves of each source's queue: ``(source, words)``."""
    quantum = F.greatest(F.lit(1), F.ceil(F.col("target") / PACKETS)).cast("long")
    packets = (joined.where("size > 0 AND target > 0").withColumn("q", quantum)
               .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1))))
               .withColumn("k", F.explode(F.sequence(F.lit(1).cast("long"), F.ceil(F.col("size") / F.col("q")).cast("long")))))
    end = F.col("epoch") * F.col("source_size") + F.col("start") + F.least(F.col("k") * F.col("q"), F.col("size"))
    packets = packets.select("source", (F.least(F.col("k") * F.col("q"), F.col("size")) - (F.col("k") - 1) * F.col("q")).alias("words"),
                             (end / F.col("target")).alias("finish"))
    total = joined.agg(F.sum("size")).first()[0] or 0
    spent, low, width, part = 0, 0.0, 1.0 / RANGES, packets
    # narrow the range of virtual time that holds the cut, by totals per range
    while True:
        slot = F.floor((F.col("finish") - F.lit(low)) / F.lit(width))
        sums = part.groupBy(slot.alias("slot")).agg(F.sum("words").alias("words"), F.count(F.lit(1)).alias("n"))
        run = Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)
        cut = (sums.withColumn("upto", F.sum("words").over(run) + F.lit(spent)).where(F.col("upto") >= F.lit(total))
               .orderBy("slot").first())
        if cut is None:  # no words at all
            return packets.groupBy("source").agg(F.sum("words").alias("words"))
        spent = cut["upto"] - cut["words"]
        inside = (slot == F.lit(cut["slot"]))
        full = part.where(slot < F.lit(cut["slot"]))
        done = full if part is packets else done.unionByName(full)
        part = part.where(inside)
        if cut["n"] <= ROWS_IN_RANGE or width < 1e-12:
            break
        low, width = low + cut["slot"] * width, width / RANGES
    order = Window.orderBy("finish", F.col("source").asc_nulls_last(), "words")
    last = (part.withColumn("before", F.lit(spent) + F.coalesce(
        F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .select("source", F.greatest(F.lit(0), F.least(F.col("words"), F.lit(total) - F.col("before"))).alias("words"), "finish"))
    return done.unionByName(last).groupBy("source").agg(F.sum("words").alias("words"))
