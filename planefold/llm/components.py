"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from planefold.session import settle


#: Edges from which the grouped minimum is written before it is joined back.
MANY = 1 << 22


def _star(edges: DataFrame, large: bool, many: bool) -> DataFrame:
    """One step: link the larger (or the smaller) neighbours of a node to its least one."""
    if large:
        near = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = near.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
    met = near.join(settle(least) if many else least, "u")
    if large:
        out = met.filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    else:
        out = met.filter("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        out = out.unionByName(least.select("u", F.col("low").alias("v")))
    return out.filter("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    mark = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mark)).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, label``: the least node reachable, for every node of ``u, v`` edges.

    Alternating large-star and small-star steps; each is a grouped minimum and a
    join back on the node, and every round is written to the shared folder. A hot
    node is pre-aggregated in the minimum; with more than ``MANY`` edges the minimum is
    written first, so that no aggregate stands between the join and its shuffle and
    adaptive execution can split the node. Edges may repeat, loop or hold NULL (dropped); no edge gives no row.
    """
    now = settle(edges.select("u", "v").filter("u IS NOT NULL AND v IS NOT NULL AND u <> v").distinct())
    state = _state(now)
    while state[0]:
        many = state[0] > MANY
        now = settle(_star(_star(now, True, many), False, many))
        after = _state(now)
        if after == state:
            break
        state = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    )
