import pytest
from pyspark.sql import functions as F

from planefold.operators import ordering, sizing
from planefold.operators.ordering import numbered, running_total


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds most rows."""
    return spark.range(3000).select(
        F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 10)).alias("g"),
        F.expr("pmod(xxhash64(id), 500)").alias("k"),
        "id",
    )


def brute_force(rows, value):
    seen, result = {}, {}
    for row in sorted(rows, key=lambda r: (r.g, -r.k, r.id)):
        result[row.id] = seen.get(row.g, 0)
        seen[row.g] = result[row.id] + value(row)
    return result, seen


@pytest.mark.parametrize("broadcast", [True, False])
def test_numbered(spark, skewed, broadcast, monkeypatch):
    if not broadcast:
        monkeypatch.setattr("planefold.operators.ordering.small_side", lambda df: df)
    got = numbered(skewed, ["g"], [F.desc("k"), F.col("id")], "n", total="size").collect()
    expected, sizes = brute_force(got, lambda r: 1)
    assert {r.id: r.n for r in got} == expected
    assert all(r["size"] == sizes[r.g] for r in got) and len(got) == 3000


def test_numbered_without_groups(spark, skewed):
    got = numbered(skewed, [], ["id"], "n").collect()
    assert all(r.n == r.id for r in got)


def test_hot_group_spreads_over_partitions(skewed):
    from planefold.operators.ordering import _PART, _ranged

    rows = _ranged(skewed, ["g"], ["k", "id"]).filter("g = 'hot'")
    assert rows.select(_PART).distinct().count() > 4


def test_running_total(skewed):
    got = running_total(skewed, ["g"], [F.desc("k"), F.col("id")], "k", "before").collect()
    assert {r.id: r.before for r in got} == brute_force(got, lambda r: r.k)[0]


def test_measured_bytes(spark):
    table = spark.createDataFrame([(1, "ab", 0.5), (2, None, 1.0)], "a int, b string, c double")
    assert sizing.measured_bytes(table) == 2 * (32 + 4 + 8 + 8) + 2
    assert sizing.measured_bytes(table.filter("a > 5")) == 0
    assert sizing.measured_bytes(spark.range(1).select(F.array(F.lit(1)))) is None


def test_measured_bytes_of_arrays(spark):
    table = spark.range(2).select(F.array(F.lit(1), F.lit(2)).alias("a"), F.struct(F.lit(1.0).alias("v")).alias("s"))
    assert sizing.measured_bytes(table) is None
    assert sizing.measured_bytes(table, nested=True) == 2 * (32 + 24 + 8 + 16 + 8)
    assert sizing.fits(table) and not sizing.fits(table, limit=100)


def test_broadcast_only_below_the_limit(spark):
    def hinted(df):
        return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()

    table = spark.range(100)
    assert hinted(sizing.small_side(table)) and not hinted(sizing.small_side(table, limit=100))


def test_null_is_a_group(spark):
    df = spark.createDataFrame([(None, 3), (None, 1), (1, 5)], "g int, k int")
    got = sorted(map(tuple, ordering.numbered(df, ["g"], ["k"], "i").collect()), key=str)
    assert got == sorted([(None, 1, 0), (None, 3, 1), (1, 5, 0)], key=str)
    totals = ordering.running_total(df, ["g"], ["k"], "k", "before").collect()
    assert {(r.g, r.k, r.before) for r in totals} == {(None, 1, 0), (None, 3, 1), (1, 5, 0)}


def test_large_k_gathers_no_group(spark):
    df = spark.range(3000).select((F.col("id") % 2).alias("g"), "id")
    top = ordering.top_per_group(df, ["g"], ["id"], 1001, "rank")
    assert "row_number" not in top._jdf.queryExecution().executedPlan().toString()
    assert top.count() == 2002 and top.agg(F.max("rank")).first()[0] == 1001


def test_settled_tables_are_removed(spark):
    from pathlib import Path

    from planefold import session

    session.settle(spark.range(3).toDF("id"))
    path = Path(session._settled[-1].removeprefix("file:"))
    assert path.exists()
    assert session.clear_settled(spark) >= 1
    assert not path.exists() and session._settled == []
