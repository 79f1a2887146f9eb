"""J3 with band tables of any size, C3 by bitmaps."""

import bisect
import random

import pytest
from pyspark.sql import functions as F

from creditspark.operators import catalog, joins


def by_hand(values, bands):
    starts = sorted(bands, key=lambda b: (b[0] is not None, b[0]))
    lows = [float("-inf") if b[0] is None else b[0] for b in starts]
    out = []
    for i, v in values:
        k = bisect.bisect_right(lows, v) - 1 if v is not None and v == v else -1
        hit = starts[k] if k >= 0 and (starts[k][1] is None or v < starts[k][1]) else (None, None, None)
        out.append((i, v if v is None or v == v else "nan", *hit))
    return sorted(out, key=str)


def run(df):
    return sorted(((r.i, r.x if r.x is None or r.x == r.x else "nan", r.lo, r.hi, r.name) for r in df.collect()), key=str)


@pytest.mark.parametrize("ranges", [1, 4, 33])
def test_lookup_by_hand(spark, ranges):
    rng = random.Random(ranges)
    cuts = sorted(rng.sample(range(0, 4000), 300))
    bands = [(float(a), float(b) if rng.random() < 0.8 else (a + b) / 2, f"b{a}") for a, b in zip(cuts, cuts[1:])]
    bands.append((None, -50.0, "below"))
    values = [(i, rng.choice([rng.uniform(-100, 4100), float(rng.choice(cuts)), 777.0, 777.0, None, float("nan")])) for i in range(3000)]
    left = spark.createDataFrame(values, "i int, x double").repartition(5)
    right = spark.createDataFrame(bands, "lo double, hi double, name string").repartition(3)
    want = by_hand(values, bands)
    assert run(joins.range_lookup(left, right, "x", hi_col="hi", ranges=ranges)) == want
    assert run(joins.band_join(left, right, "x", block=50)) == want == run(joins.band_join(left, right, "x"))


def test_a_shared_value_is_spread(spark):
    left = spark.range(4000).selectExpr("id AS i", "if(id % 3 < 2, 5D, double(id)) AS x").repartition(4)
    right = spark.createDataFrame([(0.0, "a"), (5.0, "b"), (6.0, "c")], "lo double, name string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = joins.range_lookup(left, right, "x", ranges=8).withColumn("part", F.spark_partition_id())
        counts = {(r["name"], r["part"]): r["count"] for r in got.groupBy("name", "part").count().collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(n for (name, _), n in counts.items() if name == "b") == left.where("x = 5").count()
    assert sum(name == "b" for name, _ in counts) > 3


def test_a_million_bands_without_a_collect(spark, monkeypatch):
    bands = spark.range(1_000_000).selectExpr("double(id) * 2 AS lo", "double(id) * 2 + 1 AS hi", "id AS band")
    left = spark.range(20_000).selectExpr("id AS i", "double(id) * 97.5 AS x")
    plan = joins.range_lookup(left, bands, "x", hi_col="hi")
    got = {r.i: r.band for r in plan.collect()}
    assert got == {i: int(i * 97.5 // 2) if (i * 97.5) % 2 < 1 else None for i in range(20_000)}


def test_empty_sides(spark):
    none = spark.createDataFrame([], "lo double, name string")
    left = spark.createDataFrame([(1, 2.0)], "i int, x double")
    assert [tuple(r) for r in joins.range_lookup(left, none, "x").collect()] == [(1, 2.0, None, None)]
    assert joins.range_lookup(left.limit(0), none, "x").collect() == []


@pytest.mark.parametrize("keys", [
    [1, 1, 2, None, 3, 3, 3], [], [None, None], [5], [-3, -3, 0, 7, 40_000, 40_000], list(range(-40_000, 40_000)) + [12, 32_768, 32_768],
    [1, 2**62, 1, -(2**62)],
])
def test_bitmap_check_equals_grouping(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(3)
    a, b = catalog.pk_check_bitmap(df, "k", "t").collect(), catalog.pk_check(df, ["k"], "t").collect()
    assert a == b


def test_bitmaps_shuffle_a_small_part_of_the_keys(spark):
    """Only keys of buckets with repeated keys are grouped."""
    df = spark.range(300_000).selectExpr("id AS k").unionByName(spark.createDataFrame([(70_000,)] * 3, "k long"))
    buckets = catalog.bitmap_keys(df, "k")
    assert buckets.count() == -(-300_000 // 32_768) + 1
    doubtful = [r for r in buckets.collect() if r.n != r.kinds]
    assert len(doubtful) == 1 and doubtful[0].n - doubtful[0].kinds == 3
    assert catalog.pk_check_bitmap(df, "k").first().duplicate_keys == 1
