"""Clip durations against what words of their length take."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .planner import running

SUSPECT, LONG = 3.0, 1.8
MIN_GROUP = 20
#: Word lengths that are broadcast at most, with two counts each.
BROADCAST_LENGTHS = 100_000


def medians(clips: DataFrame, *, least: int = MIN_GROUP) -> DataFrame:
    """len, median of (word, seconds): the exact median per word length, of lengths with enough clips.

    Selected from counted values: equal ones are one row, running counts over (length, value) tell
    which value stands in the middle, and no task gathers a length's clips. Clips without seconds
    count for `least` only; a length that has no others has no median.
    """
    counted = clips.groupBy(F.length("word").alias("len"), "seconds").agg(F.count(F.lit(1)).alias("n"))
    known = running(counted.where("len is not null and seconds is not null"), ("len", "seconds"), "_upto", F.sum, F.col("n"))
    # The least running count of a length is that of its first value.
    whole = known.groupBy("len").agg(F.sum("n").alias("_all"), F.min(F.col("_upto") - F.col("n")).alias("_before"))
    if clips.select(F.length("word")).distinct().count() <= BROADCAST_LENGTHS:
        # Counted values needn't be dealt by length, of which one may have most.
        whole = F.broadcast(whole)
    placed = known.join(whole, "len").withColumn("_to", F.col("_upto") - F.col("_before")).withColumn("_from", F.col("_to") - F.col("n"))
    holds = lambda place: F.max(F.when((F.col("_from") <= place) & (place < F.col("_to")), F.col("seconds")))
    middle = placed.groupBy("len").agg((holds(F.expr("(_all - 1) div 2")) * 0.5 + holds(F.expr("_all div 2")) * 0.5).alias("median"))
    enough = counted.groupBy("len").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return middle.join(enough, "len").select("len", "median")


def suspicious(clips: DataFrame, table: DataFrame, factor: float = SUSPECT) -> DataFrame:
    """Clips longer than `factor` times the median of their length, with ratio; lengths without a median are never."""
    met = clips.join(table, F.length("word") == F.col("len"))
    return met.withColumn("ratio", F.col("seconds") / F.col("median")).where(F.col("seconds") > factor * F.col("median")).drop("len")


def expectation(length: Column, table: DataFrame) -> tuple[DataFrame, Column]:
    """One row of the table as a map, and the seconds due at a length, past its longest by the slope from ten on."""
    row = table.agg(F.map_from_entries(F.collect_list(F.struct("len", "median"))).alias("by_len"), F.max("len").alias("longest"))
    top, ten = F.element_at("by_len", F.col("longest")), F.try_element_at(F.col("by_len"), F.lit(10))
    slope = F.try_divide(top - ten, F.col("longest") - 10)
    return row, F.coalesce(F.try_element_at(F.col("by_len"), length), F.when(length > F.col("longest"), top + slope * (length - F.col("longest"))))


def long_for_length(clips: DataFrame, table: DataFrame, headwords: DataFrame, factor: float = LONG) -> DataFrame:
    """Dictionary words of three letters or more, no letter three times running, that take `factor` times their due or more."""
    shaped = clips.where(F.col("word").rlike(r"^\p{L}{3,}$") & ~F.col("word").rlike(r"(.)\1\1"))
    known = shaped.join(headwords.select(F.lower("key").alias("_k")).distinct(), F.lower("word") == F.col("_k"), "left_semi")
    row, due = expectation(F.length("word"), table)
    met = known.crossJoin(F.broadcast(row)).withColumn("due", due)  # the table is one row
    return met.where(F.col("seconds") >= factor * F.col("due")).withColumn("ratio", F.col("seconds") / F.col("due")).drop("by_len", "longest")


def ceiling(length: Column, median: Column, factor: float = SUSPECT) -> Column:
    """The longest that passes; null, no limit, without a median."""
    return median * factor


def defects_by_length(rows: DataFrame, k: int = 10) -> DataFrame:
    return rows.groupBy(F.length("word").alias("len")).agg(F.count(F.lit(1)).alias("n")).orderBy("len").limit(k)


def verdict_histogram(rows: DataFrame) -> DataFrame:
    """verdict, n, percent, most common first. The window runs over one row per verdict."""
    from pyspark.sql import Window as W

    per = rows.groupBy("verdict").agg(F.count(F.lit(1)).alias("n"))
    return per.withColumn("percent", F.col("n") * 100 / F.sum("n").over(W.partitionBy(F.lit(1)))).orderBy(F.desc("n"), "verdict")


def histogram(rows: DataFrame, by: str) -> DataFrame:
    """How many rows have each value of a column: sample rates, outcomes of a repair pass."""
    return rows.groupBy(by).agg(F.count(F.lit(1)).alias("n"))


def size_shares(probes: DataFrame) -> DataFrame:
    """original, encoded, failed, percent, silence of probes (original, encoded, seconds, head, tail).

    percent: encoded bytes of the original's; silence: percent of the seconds that lie silent at the
    edges. A probe that couldn't be encoded has null there and counts as failed; one without seconds
    adds no silence.
    """
    sum_ = lambda c: F.coalesce(F.sum(c), F.lit(0))
    known = F.col("seconds").isNotNull()
    edges, total = sum_(F.when(known, F.col("head") + F.col("tail"))), sum_("seconds")
    return probes.agg(
        sum_("original").alias("original"), sum_("encoded").alias("encoded"), F.count_if(F.col("encoded").isNull()).alias("failed"),
        F.try_divide(100.0 * sum_("encoded"), sum_("original")).alias("percent"), (100.0 * edges / F.greatest(total, F.lit(0.001))).alias("silence"),
    )
