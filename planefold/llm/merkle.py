"""Merkle manifest of a dataset: a tree of digests per source, and one over the sources.

A row's leaf is the SHA-256 of its columns. Within a source leaves stand in order of
their id; every ``RUN`` consecutive nodes, the last run fewer, become the digest of
their digests, level by level, until one is left: the subroot. Subroots, in order of
the source, form a tree the same way; what is left is the root.

The nodes of a level are rows (tree, place, digest). Lag and lead columns at the fixed
offsets 1 … ``RUN`` - 1 hold the neighbours' digests; a lag counts where the row's slot
in its run reaches that far back, a lead where the run is long enough. What counts are
the siblings, and the row at slot 0 hashes itself and those after it: the parent. The
windows are cut into ``CHUNK`` places, so no source is ordered in one task; places in
a source come from a distributed numbering.

Proofs come from the top down: a node's path is its siblings followed by its parent's
path. A parent is joined to at most ``RUN`` children, so nothing is skewed, and only the
rows of the last level carry whole paths through a join, one for each run.

Results for the odd cases: NULL in a column is ``-`` in the leaf; NULL as source is a
source of its own, before all others; NULL as id comes first, rows that repeat an id are
ordered by their leaf; a NULL id and a NULL text are digested like any other; a source
of one row has that leaf as subroot, one source's subroot is the root; an empty table
gives an empty result; further columns are carried along unless they are named like a
result column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from planefold.operators.ordering import numbered
from planefold.session import settle

RUN = 16
CHUNK = RUN * RUN
RESULT = ("subroot", "root", "path")


def field(value: Column) -> Column:
    """A value with its size in front, so that no two rows of values read the same."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    """Leaf of a row: digest of its fields."""
    return F.sha2(F.concat(*[field(value) for value in values]), 256)


def _siblings(nodes: DataFrame) -> DataFrame:
    """Nodes ``tree, place, n, digest`` with the digests ``before`` and ``after`` them in their run."""
    window = Window.partitionBy("tree", F.expr(f"place div {CHUNK}")).orderBy("place")
    slot = F.col("place") % RUN
    length = F.least(F.lit(RUN), F.col("n") - (F.col("place") - slot))
    lags = [F.when(slot >= k, F.lag("digest", k).over(window)) for k in range(RUN - 1, 0, -1)]
    leads = [F.when(slot + k < length, F.lead("digest", k).over(window)) for k in range(1, RUN)]
    return nodes.select("*", F.concat_ws("", *lags).alias("before"), F.concat_ws("", *leads).alias("after"))


def _parents(nodes: DataFrame) -> DataFrame:
    """The next level of the trees that still have several nodes."""
    first = _siblings(nodes.filter("n > 1").select("tree", "place", "n", "digest")).filter(F.col("place") % RUN == 0)
    return first.select(
        "tree",
        F.expr(f"place div {RUN}").alias("place"),
        F.expr(f"(n + {RUN - 1}) div {RUN}").alias("n"),
        F.sha2(F.concat("digest", "after"), 256).alias("digest"),
    )


def _levels(leaves: DataFrame) -> list[DataFrame]:
    """All levels of all trees, from the leaves ``tree, place, n, digest`` up."""
    levels = [leaves]
    most = leaves.agg(F.max("n")).first()[0] or 0
    while most > 1:
        levels.append(settle(_parents(levels[-1])))
        most = -(-most // RUN)
    return levels


def _tops(levels: list[DataFrame]) -> DataFrame:
    """The one digest left of each tree."""
    tops = [level.filter("n = 1").select("tree", "digest") for level in levels]
    whole = tops[0]
    for more in tops[1:]:
        whole = whole.unionByName(more)
    return whole


def _down(levels: list[DataFrame], above: DataFrame) -> DataFrame:
    """The leaves with ``subroot``, ``root`` and ``path``; ``above`` has ``tree, root, path`` of each top."""
    parents = None
    for level in reversed(levels):
        top = level.filter("n = 1").join(above.select("tree", "root", "path"), "tree").withColumn("subroot", F.col("digest"))
        kept = [c for c in level.columns if c != "digest"] if level is not levels[0] else level.columns
        here = top.select(*kept, *RESULT)
        if parents is not None:
            inner = _siblings(level.filter("n > 1")).withColumn("parent", F.expr(f"place div {RUN}"))
            own = F.array(F.struct("before", "after"))
            upper = parents.select("tree", F.col("place").alias("parent"), "subroot", "root", F.col("path").alias("rest"))
            inner = inner.join(upper, ["tree", "parent"]).withColumn("path", F.concat(own, "rest"))
            here = here.unionByName(inner.select(*kept, *RESULT))
        parents = here if level is levels[0] else settle(here)
    return parents


def manifest(rows: DataFrame) -> DataFrame:
    """Rows of ``doc_id, source, leaf`` and others, with ``subroot``, ``root`` and ``path``.

    ``path`` lists, from the leaf's level to the root, the digests ``before`` and
    ``after`` the row's node in its run, as hex digits run together.
    """
    others = [c for c in rows.columns if c not in RESULT]
    packed = rows.select(
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("tree"),
        F.col("doc_id").alias("key"),
        F.col("leaf").alias("digest"),
        F.struct(*[F.col(c) for c in others]).alias("row"),
    )
    placed = numbered(settle(packed), ["tree"], [F.col("key").asc_nulls_first(), "digest"], "place", total="n")
    levels = _levels(settle(placed.select("tree", "place", "n", "digest", "row")))
    subroots = numbered(settle(_tops(levels)), [], ["tree"], "place", total="n")
    subroots = settle(subroots.select(F.lit(0).alias("all"), "place", "n", "digest", F.col("tree").alias("source_tree")))
    upper = _levels(subroots.withColumnRenamed("all", "tree"))
    start = _tops(upper).select("tree", F.col("digest").alias("root"), F.array().cast("array<struct<before:string,after:string>>").alias("path"))
    sources = _down(upper, start).select(F.col("source_tree").alias("tree"), "root", "path")
    return _down(levels, settle(sources)).select(*[F.col("row")[c].alias(c) for c in others], *RESULT)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf leads to along a path."""
    return F.aggregate(path, leaf, lambda digest, level: F.sha2(F.concat(level["before"], digest, level["after"]), 256))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level, left to right."""
    siblings = F.transform(path, lambda level: F.concat(level["before"], level["after"]))
    return F.sha2(F.array_join(siblings, ""), 256)
