"""Decisions over several takes of one clip, as array expressions; agreement of whole groups as a plan.

A take is struct(heard, seconds, similarity); predicates are functions from a take's column to a
boolean column, so that callers choose the rule.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions import match

FLOOR = 0.25
AGREE, CONFIRM = 0.6, 0.7
STEADY = 3
#: Distinct values of a group that one side of a comparison holds.
BLOCK = 64
Rule = Callable[[Column], Column]


def first_acceptable(takes: Column, ok: Rule, limit: Column | None = None) -> Column:
    """struct(outcome, take, best): takes in order; too short or beyond the limit skipped; the first acceptable wins."""
    heard = F.filter(takes, lambda t: t["seconds"] >= FLOOR)
    within = heard if limit is None else F.filter(heard, lambda t: F.isnull(limit) | (t["seconds"] <= limit))
    take = F.get(F.filter(within, ok), 0)
    return F.struct(F.when(F.isnull(take), "unsettled").otherwise("fixed").alias("outcome"), take.alias("take"), F.array_max(F.transform(within, lambda t: t["similarity"])).alias("best"))


def shortest(takes: Column) -> Column:
    """The shortest take, the first of ties."""
    keyed = F.transform(takes, lambda t, i: F.struct(t["seconds"].alias("seconds"), i.alias("i"), t.alias("take")))
    return F.array_min(keyed)["take"]


def settle(takes: Column, ok: Rule, too_long: Rule, rambling: Rule, agreement: Column, confirms: Column, was_rambles: Column) -> Column:
    """struct(outcome, take, steady).

    A passing take (the shortest acceptable one that isn't too long): fixed. Else the steady takes
    (not rambling, not too long, not silent): three or more that agree confirm what was there or
    replace it; any, where what was there rambles, are forced; otherwise unstable.
    """
    heard = F.filter(takes, lambda t: t["seconds"] >= FLOOR)
    passing = shortest(F.filter(heard, lambda t: ok(t) & ~too_long(t)))
    steady = F.filter(heard, lambda t: ~rambling(t) & ~too_long(t) & (F.length(t["heard"]) > 0))
    agreed = (F.size(steady) >= STEADY) & (agreement >= AGREE)
    outcome = F.when(~F.isnull(passing), "fixed").when(agreed & (confirms >= CONFIRM), "confirmed").when(agreed, "replaced").when((F.size(steady) > 0) & was_rambles, "forced").otherwise("unstable")
    take = F.when(~F.isnull(passing), passing).when(outcome.isin("replaced", "forced"), shortest(steady))
    return F.struct(outcome.alias("outcome"), take.alias("take"), F.size(steady).alias("steady"))


def rejudged(agreement: Column, confirms: Column, bar: float = 0.85) -> Column:
    """An unstable clip judged again by sound: promoted, disagrees, or still unstable."""
    return F.when(agreement < bar, "still").when(confirms >= bar, "promoted").otherwise("disagrees")


def cleanest(takes: Column) -> Column:
    """The first take without a stumble, else the one with the fewest (struct with stumbles)."""
    keyed = F.transform(takes, lambda t, i: F.struct(t["stumbles"].alias("n"), i.alias("i"), t.alias("take")))
    return F.array_min(keyed)["take"]


def verification_fault(seconds: Column, rate: Column, channels: Column, limit: Column, rambling: Column, exists: Column) -> Column:
    """First fault in the order missing, encoding, too long, rambles; null for a sound clip."""
    return F.when(~exists, "missing").when((rate != "24000") | (channels != "1"), "encoding").when(seconds > limit, "too long").when(rambling, "rambles")


def group_agreement(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, agreement, medoid: `match.agreement` of the sorted values of each group, of any size.

    Distinct values with their counts are compared block by block, each pair of blocks in a task of its
    own; only sums come together. Means that differ by less than 1e-12 are ties.
    """
    spark = rows.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # Structs are equal where the same fields are null.
    kept = rows.select(F.struct(*keys).alias("key"), F.coalesce(F.col(value), F.lit("")).alias("v")).groupBy("key", "v").agg(F.count(F.lit(1)).alias("c"))
    sizes = kept.groupBy("key").agg(F.sum("c").alias("n"), F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    dealt = kept.join(sizes, "key").withColumn("own", F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    left = dealt.select("key", F.col("own").alias("i"), others.alias("j"), F.col("v").alias("a")).repartition(tasks, "key", "i", "j")
    right = dealt.select("key", others.alias("i"), F.col("own").alias("j"), F.col("v").alias("b"), "c").repartition(tasks, "key", "i", "j")
    pairs = left.join(right.hint("shuffle_hash"), ["key", "i", "j"]).where("a <> b").withColumn("r", match.block_ratio(F.col("a"), F.col("b")))
    later, earlier = F.col("b") > F.col("a"), F.col("b") < F.col("a")
    sums = pairs.groupBy("key", F.col("a").alias("v")).agg(
        F.sum(F.col("c") * F.col("r")).alias("all"), F.sum(F.when(later, F.col("c") * F.col("r")).otherwise(0.0)).alias("later"), F.sum(F.when(earlier, F.col("c")).otherwise(0)).alias("before")
    )
    each = dealt.join(sums, ["key", "v"], "left").na.fill(0, ["all", "later", "before"])
    c, n, same = F.col("c"), F.col("n"), F.when(F.col("v") == "", 0.0).otherwise(1.0)
    mean = F.round((F.col("all") + (c - 1) * same) / F.greatest(n - 1, F.lit(1)), 12)
    judged = each.groupBy("key").agg(
        F.max("n").alias("n"), F.sum(c * F.col("later") + c * (c - 1) / 2 * same).alias("pairs"), F.max(F.struct(mean.alias("mean"), (-F.col("before")).alias("at"))).alias("top")
    )
    n = F.col("n")
    return judged.select(
        "key.*", F.when(n < 2, 0.0).otherwise(F.col("pairs") / F.greatest(n * (n - 1) / 2, F.lit(1))).alias("agreement"), F.when(n < 2, 0).otherwise(-F.col("top.at")).cast("int").alias("medoid")
    )


def close_pairs(rows: DataFrame, keys: list[str], value: str, bar: float) -> DataFrame:
    """keys, a, b, similarity: the ordered pairs of different values of a group that are at least `bar` alike.

    What two strings can share is bounded natively before Python sees a pair. Values lie in bins by the
    logarithm of their length, so that a partner is in the same or a neighbouring bin; bins are dealt into
    blocks of about `BLOCK` values that have about the same letters; a pair of blocks is dropped if the
    greatest counts of their letters can't reach the bar, and of the others each pair of values that
    can't. No two strings at the bar are lost. Null values count as empty; one row for each pair, however
    often its values stand there.
    """
    if not 0 < bar <= 1:
        raise ValueError("bar must lie above 0, and at most at 1")
    # 2 * shorter / (shorter + longer) >= bar, so that longer / shorter <= widest.
    widest = (2 - bar) / bar
    step = math.log(max(widest, 1.01))
    spark = rows.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    kept = rows.select(F.struct(*keys).alias("key"), F.coalesce(F.col(value), F.lit("")).alias("v")).distinct()
    size = F.length("v")
    # Empty strings are like no others.
    kept = kept.where(size > 0).select("key", "v", size.alias("size"), match.letter_counts(F.col("v")).alias("letters"), F.floor(F.log(size.cast("double")) / step).cast("int").alias("bin"))
    numbers = kept.groupBy("key", "bin").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    # Values of the same different letters come into the same block, while that isn't full by far.
    alike = F.xxhash64(F.array_sort(F.map_keys("letters")))
    dealt = kept.join(numbers, ["key", "bin"]).withColumn("block", F.pmod(F.when(F.col("blocks") > 1, alike + F.pmod(F.xxhash64("v"), F.lit(2))).otherwise(alike), F.col("blocks")).cast("int")).drop("blocks")
    place = ["key", "bin", "block"]
    most = dealt.select(*place, "size", F.explode("letters").alias("c", "k")).groupBy(*place, "c").agg(F.max("k").alias("k"), F.min("size").alias("least"))
    blocks = most.groupBy(*place).agg(F.map_from_entries(F.collect_list(F.struct("c", "k"))).alias("letters"), F.min("least").alias("least"))
    as_side = lambda df, side: df.select("key", *[F.col(c).alias(f"{c}_{side}") for c in df.columns if c != "key"])
    near = blocks.withColumn("near", F.explode(F.array(*[F.col("bin") + d for d in (-1, 0, 1)])))
    left, right = as_side(near, "a"), as_side(blocks, "b")
    reach = lambda: match.ratio_bound(match.shared_letters(F.col("letters_a"), F.col("letters_b")).cast("double"), F.col("size_a") + F.col("size_b")) >= bar - 1e-9
    met = left.join(right, (left["key"] == right["key"]) & (left["near_a"] == right["bin_b"])).drop(right["key"])
    met = met.withColumnsRenamed({"least_a": "size_a", "least_b": "size_b"}).where(reach()).select("key", "bin_a", "block_a", "bin_b", "block_b")
    mine, others = as_side(dealt, "a"), as_side(dealt, "b")
    halves = mine.join(met, ["key", "bin_a", "block_a"]).repartition(tasks, "key", "bin_a", "block_a", "bin_b", "block_b")
    theirs = others.join(met, ["key", "bin_b", "block_b"]).repartition(tasks, "key", "bin_a", "block_a", "bin_b", "block_b")
    pairs = halves.join(theirs, ["key", "bin_a", "block_a", "bin_b", "block_b"]).where("v_a <> v_b").where(reach())
    told = pairs.select("key", F.col("v_a").alias("a"), F.col("v_b").alias("b"), match.block_ratio(F.col("v_a"), F.col("v_b")).alias("similarity"))
    return told.where(F.col("similarity") >= bar).select("key.*", "a", "b", "similarity")
