"""Operators over millions of rows and several partitions, where a table of one partition would hide faults."""

import pytest
from pyspark.sql import functions as F

from lectern.operators import packs, planner

N = 3_000_000


@pytest.fixture(params=["true", "false"])
def adaptive(spark, request):
    spark.conf.set("spark.sql.adaptive.enabled", request.param)
    yield request.param
    spark.conf.unset("spark.sql.adaptive.enabled")


def shuffled(spark):
    """Rows with a payload in no order; `place` is where a row stands by (a, b)."""
    place = (F.col("id") * 7_919) % N
    return spark.range(0, N, 1, 8).select(F.col("id"), place.alias("place"), F.floor(place / 100_000).cast("int").alias("a"), F.format_string("%07d", place).alias("b"), F.repeat(F.lit("x"), 50).alias("payload"))


def test_rows_are_numbered_by_their_place(spark, adaptive):
    numbered = planner.with_row_number(shuffled(spark), ("a", "b"))
    assert numbered.agg(F.count(F.lit(1)), F.count_if(F.col("row_number") != F.col("place")), F.max(F.length("payload"))).first()[:] == (N, 0, 50)


def test_rows_are_numbered_within_groups(spark, adaptive):
    numbered = planner.with_row_number(shuffled(spark).withColumn("g", F.when(F.col("a") > 3, F.col("a"))), ("b",), by=("g",))
    # Places below 400,000 have a null group.
    want = F.col("place") - F.coalesce(F.col("g") * 100_000, F.lit(0))
    assert numbered.agg(F.count(F.lit(1)), F.count_if(F.col("row_number") != want)).first()[:] == (N, 0)


def test_shards_are_disjoint_and_complete(spark):
    shards = [planner.shard(shuffled(spark), i, 3, order=("a", "b")).select("id", "place", F.lit(i).alias("i")) for i in range(3)]
    held = shards[0].union(shards[1]).union(shards[2])
    assert held.agg(F.count(F.lit(1)), F.count_if(F.col("place") % 3 != F.col("i")), F.sum("id")).first()[:] == (N, 0, N * (N - 1) // 2)


def test_nulls_ties_and_few_rows(spark):
    rows = spark.createDataFrame([(None, 1.5), (2, None), (2, float("nan")), (1, 0.0), (None, None)], "a int, b double")
    got = [(r["a"], str(r["b"])) for r in planner.with_row_number(rows, ("a", "b")).orderBy("row_number").collect()]
    assert got == [(None, "None"), (None, "1.5"), (1, "0.0"), (2, "None"), (2, "nan")]
    tied = spark.range(100_000).select((F.col("id") % 2).alias("k"))
    numbers = planner.with_row_number(tied, ("k",))
    assert numbers.agg(F.count_distinct("row_number"), F.max("row_number")).first()[:] == (100_000, 99_999)
    assert planner.with_row_number(spark.createDataFrame([], "a int"), ("a",)).collect() == []


def test_bounds_of_many_types(spark):
    """Dates, times, decimals, strings and bytes order as Spark orders them."""
    rows = spark.range(60_000).select(*[F.expr(e).alias(c) for c, e in {"d": "date_add(date'1990-01-01', cast(id * 7 % 1000 as int))", "t": "timestamp_seconds(id * 3571 % 60000)", "m": "cast(id % 97 as decimal(12, 3))", "s": "case when id % 11 > 0 then md5(string(id)) end", "x": "unhex(md5(string(id + 1)))", "f": "cast(id as float) / 7"}.items()])
    for order in (("d", "t"), ("m", "s", "t"), ("s", "x"), ("x",), ("f",)):
        got = planner.with_row_number(rows, order).selectExpr("row_number", f"struct({', '.join(order)}) as k")
        from pyspark.sql import Window as W

        steps = got.repartition(1).withColumn("before", F.lag("k").over(W.orderBy("row_number")))
        assert steps.agg(F.count(F.lit(1)), F.count_if(F.col("before") > F.col("k")), F.max("row_number")).first()[:] == (60_000, 0, 59_999), order


def ranges(spark, n, step=40):
    """n ranges that don't overlap, of 1 to 30 ids each; every thousandth fills all ids up to the next."""
    width = F.when(F.col("id") % 1_000 == 0, step - 1).otherwise((F.col("id") * 31) % 30)
    return spark.range(n).select(F.col("id").alias("name"), (F.col("id") * step - 5_000).alias("low"), (F.col("id") * step - 5_000 + width).alias("high"))


def held_by(v, n, step=40):
    """The range of an id, by arithmetic."""
    k = F.floor((v + 5_000) / step)
    width = F.when(k % 1_000 == 0, step - 1).otherwise((k * 31) % 30)
    return F.when((v >= -5_000) & (k < n) & ((v + 5_000) % step <= width), k)


def test_ids_in_200000_ranges(spark):
    n = 200_000
    ids = spark.range(0, N, 1, 8).select(((F.col("id") * 7_919) % N * 3 - 10_000).alias("id"), F.repeat(F.lit("x"), 20).alias("payload"))
    met = packs.assign(ids, ranges(spark, n))
    assert met.agg(F.count(F.lit(1)), F.count_if(~F.col("pack").eqNullSafe(held_by(F.col("id"), n))), F.count("pack") > N // 3).first()[:] == (N, 0, True)


def test_ranges_of_all_lengths_and_ids_far_apart(spark, monkeypatch):
    monkeypatch.setattr(packs, "BROADCAST_RANGES", 0)
    bounds = [(-(1 << 40), -7), (-6, -6), (0, 9), (10, 10), (11, 1_000_000), (1 << 33, (1 << 50) - 1), (1 << 50, 1 << 50)]
    dim = spark.createDataFrame([(f"p{k}", a, b) for k, (a, b) in enumerate(bounds)], "name string, low long, high long")
    ids = sorted({v + d for pair in bounds for v in pair for d in (-1, 0, 1)} | {5, 999, 1 << 60, -(1 << 60), 3 << 40})
    rows = spark.createDataFrame([(v,) for v in ids + [None, 5, 5]], "id long")
    for part in (rows, rows.where("id between -100 and 2000000")):
        for r in packs.assign(part, dim).collect():
            assert r["pack"] == next((f"p{k}" for k, (a, b) in enumerate(bounds) if r["id"] is not None and a <= r["id"] <= b), None)
    assert packs.assign(rows.limit(0), dim).collect() == []
    assert {r["pack"] for r in packs.assign(rows, dim.limit(0)).collect()} == {None}


def test_points_cut_from_one_range_of_all(spark):
    n = 400_000
    whole = spark.createDataFrame([(0, 3 * n), (3 * n + 1, 3 * n + 5)], "low long, high long")
    left = packs.without_points(whole, spark.range(n).select((F.col("id") * 3).alias("id")))
    # Between two ids two are left; behind the last one three; the other range stays.
    assert left.groupBy((F.col("high") - F.col("low") + 1).alias("k")).count().orderBy("k").collect() == [(2, n - 1), (3, 1), (5, 1)]


def test_ranges_join_over_all_tasks(spark):
    n = 400_000
    touching = spark.range(n).select((F.col("id") * 2).alias("low"), (F.col("id") * 2 + 1).alias("high"))
    assert packs.merged(touching.union(spark.createDataFrame([(2 * n + 5, 2 * n + 9), (-9, -8), (3, 2)], "low long, high long"))).orderBy("low").collect() == [(-9, -8), (0, 2 * n - 1), (2 * n + 5, 2 * n + 9)]
    # A long range early on reaches over many short ones.
    apart = spark.range(n).select((F.col("id") * 5).alias("low"), (F.col("id") * 5 + 1).alias("high"))
    assert packs.merged(apart.union(spark.createDataFrame([(0, 5 * (n - 1))], "low long, high long"))).collect() == [(0, 5 * (n - 1) + 1)]


def test_many_buckets(spark, monkeypatch):
    """As many split points as tables of 40,000,000 rows get."""
    monkeypatch.setattr(planner, "BUCKET_ROWS", 250)
    n = 200_000
    place = (F.col("id") * 7_919) % n
    placed = spark.range(0, n, 1, 4).select(place.alias("place"), F.format_string("%06d", place).alias("name"))
    numbered = planner.with_row_number(placed, ("name",))
    assert numbered.agg(F.count(F.lit(1)), F.count_if(F.col("row_number") != F.col("place"))).first()[:] == (n, 0)
    totals = planner.running(placed, ("name", "place"), "upto", F.sum, F.lit(1))
    assert totals.agg(F.count(F.lit(1)), F.count_if(F.col("upto") != F.col("place") + 1)).first()[:] == (n, 0)
    # Runs of seven ranges, one of which reaches over many buckets; each range twice.
    low = F.col("place") * 10 + F.floor(F.col("place") / 7) * 10
    short = placed.select(low.alias("low"), (low + 9).alias("high"))
    runs = packs.merged(short.union(short).union(spark.createDataFrame([(800_000, 1_199_999)], "low long, high long")))
    # 28,572 runs, of 70 ids with a gap of 10 behind; those that begin from 800,000 to 1,200,000 are one.
    assert runs.agg(F.count(F.lit(1)), F.sum(F.col("high") - F.col("low") + 1)).first()[:] == (28_572 - 5_001 + 1, 10 * n + 10 * 5_000)


def test_buckets_are_even(spark):
    n = 500_000
    rows = spark.range(0, n, 1, 4).select(((F.col("id") * 7_919) % n).alias("v"))
    sizes = [r["count"] for r in planner.with_bucket(rows, planner.split_points(rows, ("v",)), ("v",)).groupBy("_bucket").count().collect()]
    # Of a bucket's forty sampled rows the number varies by a sixth.
    assert len(sizes) == 10 and sum(sizes) == n and max(sizes) < 1.5 * n / 10


def test_overlaps(spark):
    rows = spark.createDataFrame([("a", 1, 9), ("b", 9, 9), ("c", 10, 12), ("d", 1, 9), ("e", 11, 10), ("f", -5, 100)], "name string, low long, high long")
    assert sorted(tuple(r) for r in packs.overlapping(rows).collect()) == [("a", "b"), ("a", "d"), ("a", "f"), ("b", "d"), ("b", "f"), ("c", "f"), ("d", "f")]
