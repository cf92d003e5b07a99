"""A mix of sources with target shares of words, filled by whole documents.

Sources in code-point order (NULL last) weigh 5, 2, 1, 5, … and share 1.5 times all
words; none gets more than 2 times its own size, and what it leaves goes to the
others by weight (a few sums over the table of sources find the level).

A source's target is met by whole documents. All are taken as often as the target
holds the source in full. The remaining budget is a bounded subset-sum problem over
the counts of documents of each exact length: every length gives its proportional
part, long lengths bring the rest down, and bounded-knapsack dynamic programming
over a bit set of reachable sums finds the nearest fit. Which documents of a length
are taken follows a seeded hash order, the same in every run.

Hot groups: counts are aggregated before the shuffle; one task gets the lengths of a
source, not its documents. Documents of one source and length are ranked in ranges
of the hash order, about ``RANKED`` to a task, whose counts give the offsets.

Results for the odd cases: NULL or blank text has size 0 and is never taken; NULL is
a source of its own; rows that repeat an id are documents each; a source without
words has target 0; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from planefold.llm.ship import ready
from planefold.operators.ordering import numbered
from planefold.session import settle

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SEED = 20240
DP_WORDS = 1 << 14
RANKED = 100_000
WORD = r"[^\x20\x09-\x0D]+"


def fit(lengths: list[int], counts: list[int], budget: int) -> list[int]:
    """How many documents of each length to take, so that the words come nearest to ``budget``."""
    total = sum(n * c for n, c in zip(lengths, counts))
    if budget <= 0 or not total:
        return [0] * len(lengths)
    if budget >= total:
        return list(counts)
    taken = [c * budget // total for c in counts]
    rest = budget - sum(n * t for n, t in zip(lengths, taken))
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        more = min(counts[i] - taken[i], max(0, rest - DP_WORDS) // lengths[i]) if lengths[i] else 0
        taken[i] += more
        rest -= more * lengths[i]
    for i, more in _knapsack(lengths, [c - t for c, t in zip(counts, taken)], rest):
        taken[i] += more
    return taken


def _knapsack(lengths: list[int], free: list[int], budget: int) -> list[tuple[int, int]]:
    """Bounded knapsack over a bit set: (position, count) whose words come nearest to ``budget``."""
    if budget <= 0:
        return []
    usable = [i for i, n in enumerate(lengths) if free[i] and 0 < n <= 2 * budget]
    mask = (1 << (2 * budget + 1)) - 1
    reached, steps = 1, []
    for i in sorted(usable, key=lambda i: lengths[i]):
        left, chunk = min(free[i], 2 * budget // lengths[i]), 1
        while left and not reached >> budget & 1:
            chunk = min(chunk, left)
            steps.append((i, chunk, reached))
            reached |= (reached << chunk * lengths[i]) & mask
            left -= chunk
            chunk *= 2
        if reached >> budget & 1:
            break
    low = reached & ((1 << (budget + 1)) - 1)
    below = low.bit_length() - 1
    high = reached >> (budget + 1)
    above = budget + (high & -high).bit_length() if high else None
    at = above if above is not None and above - budget < budget - below else below
    chosen: dict[int, int] = {}
    for i, chunk, before in reversed(steps):
        if not before >> at & 1:
            at -= chunk * lengths[i]
            chosen[i] = chosen.get(i, 0) + chunk
    return list(chosen.items())


def _plan(group: pd.DataFrame) -> pd.DataFrame:
    """Full passes and additional documents by length, for one source."""
    group = group.sort_values("size")
    total, target = int(group["source_size"].iloc[0]), float(group["target"].iloc[0])
    passes = min(int(target // total), MOST) if total else 0
    extra = [0] * len(group)
    if passes < MOST and total:
        extra = fit(group["size"].tolist(), group["n"].tolist(), int(np.rint(target)) - passes * total)
    return pd.DataFrame({"src": group["src"], "size": group["size"], "passes": passes, "extra": extra})


def _targets(totals: DataFrame) -> DataFrame:
    """Add ``target`` to the sources: weight times level, at most ``MOST`` times the size."""
    placed = settle(numbered(totals, [], [F.col("source").isNull(), "source"], "place"))
    choice = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("place") % len(WEIGHTS) + 1).cast("int"))
    placed = placed.withColumn("weight", choice)
    words = placed.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    most = F.col("source_size") * MOST
    level = 0.0
    while True:
        full = F.col("weight") * F.lit(level) > most
        used, open_weight = placed.agg(
            F.coalesce(F.sum(F.when(full, most)), F.lit(0)), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0))
        ).first()
        higher = (SHARE * words - used) / open_weight if open_weight else level
        if higher <= level:
            break
        level = higher
    return placed.withColumn("target", F.least(F.col("weight") * F.lit(level), most.cast("double")))


def words_in(text: Column) -> Column:
    """Size of a text; 0 for NULL."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def mix_sources(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` for every row of ``doc_id, text, source``."""
    spark = docs.sparkSession
    ready(spark)
    size = words_in(F.col("text"))
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size.alias("size"))
    sized = settle(sized.withColumn("src", F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))))
    lengths = settle(sized.groupBy("src", "size").agg(F.count(F.lit(1)).alias("n"), F.first("source").alias("source")))
    totals = lengths.groupBy("src", "source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = settle(_targets(totals).select("src", "source_size", "target"))
    plan = lengths.drop("source").join(targets, "src").groupBy("src").applyInPandas(_plan, "src string, size long, passes int, extra long")
    salts = F.ceil(F.col("n") / F.lit(RANKED)).cast("long")
    plan = settle(plan.join(lengths.select("src", "size", salts.alias("salts")), ["src", "size"]))
    order = F.xxhash64(F.lit(SEED), "doc_id")
    place = F.pmod(F.shiftright(order, 32), F.lit(1 << 31)) / F.lit(float(1 << 31))
    rows = sized.join(plan, ["src", "size"]).withColumn("order", F.pmod(F.shiftright(order, 32), F.lit(1 << 31)))
    rows = rows.withColumn("salt", F.floor(place * F.col("salts")))
    group = ["src", "size", "salt"]
    rank = F.row_number().over(Window.partitionBy(*group).orderBy("order", "doc_id"))
    earlier = Window.partitionBy("src", "size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    many = rows.filter("salts > 1").groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    before = many.select(*group, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = rows.withColumn("rank", rank).join(before, group, "left")
    copies = F.col("passes") + (F.col("rank") + F.coalesce("before", F.lit(0)) <= F.col("extra")).cast("int")
    copies = F.when(F.col("size") > 0, copies).otherwise(F.lit(0))
    return ranked.withColumn("copies", copies).join(targets, "src").select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken")
    )


def mixed(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with all their columns.

    Rows that repeat an id, source and size are matched in order of their text.
    """
    keys = ["doc_id", "source", "size"]
    copies = mix_sources(docs).filter("copies > 0")
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("copies").desc()))
    copies = copies.select(*[F.col(k).alias(f"of_{k}") for k in keys], place.alias("of_place"), F.col("copies").alias("of_copies"))
    # the row travels as one value: no column of it can clash with a helper's name
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        words_in(F.col("text")).alias("size"),
        F.col("text").alias("text"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
    )
    own = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("text").asc_nulls_first()))
    rows = rows.withColumn("place", own)
    same = [F.col(k).eqNullSafe(F.col(f"of_{k}")) for k in (*keys, "place")]
    return rows.join(copies, same).select("row", F.explode(F.sequence(F.lit(1), F.col("of_copies")))).select("row.*")
