"""Document fingerprints: the ``K`` smallest hashes of a document's word shingles.

A sketch is a sorted array of at most ``K`` distinct 64-bit hashes of 5-word
shingles (fewer words: one shingle of all). It stands for the whole set: the sketch
of a union is the ``K`` smallest of both, so sketches of parts merge, and from them
follow the number of distinct shingles, resemblance and containment. Below ``K``
shingles all estimates are exact. Only DataFrame functions are used.

Results for the odd cases: NULL and blank texts have an empty sketch and the empty
fingerprint; two empty sketches have likeness 1, an empty and another 0; rows that
repeat an id are documents each, in order of their text; a NULL id comes after all
others in descending order; the only row of a table is its own next document; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from planefold.functions.arrays import bind
from planefold.operators.ordering import top_per_group

K = 128
SHINGLE = 5
SPACES = " \t\n\x0b\f\r"
_TWO_63 = float(1 << 63)


def _shingles(words: Column) -> Column:
    n = F.size(words)
    each = F.transform(
        F.sequence(F.lit(0), F.greatest(n - SHINGLE, F.lit(0))),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(SHINGLE)]),
    )
    return F.array_distinct(each)


def sketch(text: Column, k: int = K) -> Column:
    """Sorted array of the ``k`` smallest shingle hashes of a text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    hashes = bind(F.split(trimmed, r"[\x20\x09-\x0D]+"), _shingles)
    none = F.array().cast("array<bigint>")
    return F.when(F.length(trimmed) == 0, none).otherwise(F.slice(F.sort_array(hashes), 1, k))


def fingerprint(of: Column) -> Column:
    """A sketch as text: 16 hexadecimal digits per hash."""
    return F.array_join(F.transform(of, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def merged(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of two sets."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_sketches(df: DataFrame, by: Sequence[str], of: str, k: int = K) -> DataFrame:
    """Sketch ``of`` the union of all sets of each group; no task gets more than ``k`` hashes of a group from another."""
    hashes = df.select(*by, F.explode(of).alias("_hash")).distinct()
    least = top_per_group(hashes, by, ["_hash"], k, "_rank")
    return least.groupBy(*by).agg(F.sort_array(F.collect_list("_hash")).alias(of))


def distinct_shingles(of: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    share = (F.element_at(of, -1).cast("double") + _TWO_63) / (2 * _TWO_63)
    return F.when(F.size(of) < k, F.size(of).cast("double")).otherwise((k - 1) / share)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity of two sets."""

    def share(least: Column) -> Column:
        both = F.size(F.array_intersect(F.array_intersect(a, b), least))
        return F.when(F.size(least) == 0, F.lit(1.0)).otherwise(both / F.size(least))

    return bind(merged(a, b, k), share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the first set that the second has."""
    common = resemblance(a, b, k) * distinct_shingles(merged(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), common / distinct_shingles(a, k)))


def _bounds(docs: DataFrame, n: int) -> list[int]:
    """Ids that cut the table into about ``n`` equal ranges."""
    cuts = [i / n for i in range(1, n)]
    found = docs.agg(F.percentile_approx("doc_id", cuts, 20 * n)).first()[0]
    return sorted(set(found or []))


def _range_of(doc_id: Column, bounds: list[int]) -> Column:
    """Number of bounds at or below an id, found in two steps of about a square root of them each."""
    if not bounds:
        return F.lit(0)
    step = max(1, round(len(bounds) ** 0.5))
    parts = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    heads = F.array(*[F.lit(p[0]).cast("long") for p in parts])
    table = F.array(*[F.array(*[F.lit(x).cast("long") for x in p]) for p in parts])
    part = F.size(F.filter(heads, lambda x: x <= doc_id))
    inside = F.size(F.filter(F.get(table, part - 1), lambda x: x <= doc_id))
    return F.when(doc_id.isNull() | (part == 0), F.lit(0)).otherwise((part - 1) * step + inside)


def with_next(docs: DataFrame, ranges: int) -> tuple[DataFrame, Window]:
    """Rows of ``doc_id, text`` by range of ids, each range closed by the head of the next lower one.

    The added rows have ``added`` set. In the window returned, the next row is the
    next document in descending order; after the last comes the first.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    bounds = _bounds(docs.select("doc_id"), ranges)
    rows = docs.withColumn("range", _range_of(F.col("doc_id"), bounds))
    heads = rows.groupBy("range").agg(F.max("doc_id").alias("head"))
    above = Window.orderBy("range")
    lowest = F.min("range").over(above.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = heads.withColumn("to", F.coalesce(F.lead("range").over(above), lowest))
    heads = F.broadcast(heads.select("to", F.col("range").alias("from"), "head"))  # one row per range
    same = (F.col("range") == F.col("from")) & F.col("doc_id").eqNullSafe(F.col("head"))
    added = rows.join(heads, same).groupBy("to", "head").agg(F.min("text").alias("text"))
    added = added.select(F.col("head").alias("doc_id"), "text", F.col("to").alias("range"), F.lit(True).alias("added"))
    window = Window.partitionBy("range").orderBy("added", F.col("doc_id").desc_nulls_last(), "text")
    return rows.withColumn("added", F.lit(False)).unionByName(added), window


def edited_pairs(docs: DataFrame, k: int = K) -> DataFrame:
    """Sketches of every text, of its edit by the next document, and of that document.

    ``doc_id, n_chars, edited, sketch, edited_sketch, next_sketch``. The edit replaces
    the last half of the text by as many characters from the start of the next one.
    """
    ranges = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows, window = with_next(docs, ranges)
    half = F.floor(F.length("text") / 2).cast("int")
    rows = rows.withColumn("next", F.coalesce(F.lead("text").over(window), F.lit("")))
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("next", F.lit(1), half)))
    rows = rows.withColumns({"sketch": sketch(F.col("text"), k), "edited_sketch": sketch(F.col("edited"), k)})
    rows = rows.withColumn("next_sketch", F.lead("sketch").over(window))
    return rows.filter(~F.col("added")).select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), "edited", "sketch", "edited_sketch", "next_sketch"
    )
