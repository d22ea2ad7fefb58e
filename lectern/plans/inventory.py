"""Queries over whole plans: counts by kind, named paths, installed packs, clips judged again, dictionary words."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators import consensus, packs, planner

from .registry import query, table


@query(
    """with plan as (select 'quest' as kind, s_suppkey as k, s_name as text from supplier union all select 'word', p_partkey, p_name from part)
select kind, count(*) as clips, count(*) filter (k % 3 = 0) as done, count(*) filter (k % 3 = 1) as missing, count(*) filter (k % 3 = 2) as stale, sum(length(text)) / 15.0 / 3600 as hours from plan group by kind"""
)
def counts_by_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers stand in for quests, parts for words; a third each is done, missing and stale."""
    quests = table(spark, sf_dir, "supplier").select(F.lit("quest").alias("kind"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("text"))
    words = table(spark, sf_dir, "part").select(F.lit("word").alias("kind"), F.col("p_partkey").cast("string").alias("key"), F.col("p_name").alias("text"))
    k = F.coalesce(F.col("id"), F.col("key").cast("bigint")) % 3
    plan = planner.whole_plan(quests, words)
    return planner.counts_by_kind(plan.withColumn("status", F.when(k == 0, "done").when(k == 1, "missing").otherwise("stale")))


@query("select s_suppkey, list_pos from supplier join (select n_nationkey % 10 as k, min(n_nationkey) as list_pos from nation group by 1) on s_suppkey = k")
def named_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the paths in a list that names some twice."""
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", F.concat(F.lit("q/"), F.col("s_suppkey").cast("string")).alias("path"))
    named = table(spark, sf_dir, "nation").select(F.concat(F.lit("q/"), (F.col("n_nationkey") % 10).cast("string")).alias("path"), F.col("n_nationkey").alias("pos"))
    return planner.restricted(rows, named, in_list_order=True).select("s_suppkey", "list_pos")


@query("select count(*) filter (s_suppkey % 2 = 0) as ranged, bool_or(s_suppkey % 5 = 0) as has_words from supplier")
def installed_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A27."""
    ranges = F.when(F.col("s_suppkey") % 2 == 0, F.array("s_suppkey")).otherwise(F.array().cast("array<bigint>"))
    return packs.installed(table(spark, sf_dir, "supplier").select(ranges.alias("ranges"), (F.col("s_suppkey") % 5 == 0).alias("words")))


@query(
    """select outcome, count(*) as clips from (select case when event_id % 100 < 85 then 'still' when event_id % 97 >= 85 then 'promoted' else 'disagrees' end as outcome from events) group by 1"""
)
def rejudged_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unstable clips by what judging them again says."""
    share = lambda n: F.col("event_id") % n / 100
    return table(spark, sf_dir, "events").groupBy(consensus.rejudged(share(100), share(97)).alias("outcome")).agg(F.count(F.lit(1)).alias("clips"))


@query("select 'word' as kind, p_brand as key, arg_min(p_name, p_partkey) as text, substr(sha1(arg_min(p_name, p_partkey)), 1, 16) as hash from part group by p_brand")
def dictionary_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4's rows as a plan, H8, A12: the first row of a key wins."""
    words = table(spark, sf_dir, "part").select(F.col("p_brand").alias("key"), F.col("p_name").alias("word"), F.col("p_partkey").alias("pos"))
    return planner.word_plan(words).select("kind", "key", "text", "hash")
