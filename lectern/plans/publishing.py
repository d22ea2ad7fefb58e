"""Queries that write, check and read back: packs, copies, report logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators import planner, reconcile
from lectern.sources import publish, staging

from .registry import query, table


@query(
    """select 'published' as attempt, 'entry' as what, count(*)::bigint as n, sum(length(p_name) + 1)::bigint as size from part
union all select 'refused', 'loaded but absent', count(*), null from part where p_partkey % 10 = 0
union all select 'refused', 'outside the folder', count(*), null from part where p_partkey % 7 = 0 and p_partkey % 10 <> 0
union all select 'afterwards', 'entry', count(*), sum(length(p_name) + 1) from part"""
)
def published_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: a pack that is right is published; one that isn't is refused, and the one before it stays."""
    part = table(spark, sf_dir, "part")
    path = lambda folder: F.concat(folder, F.lit("/w/"), F.col("p_partkey").cast("string"), F.lit(".ogg")).alias("path")
    content = F.concat("p_name", F.lit("\n")).cast("binary").alias("content")
    target, loads = staging.fresh(spark, "pack"), part.select(path(F.lit("Pack")))
    inside = lambda attempt: spark.read.parquet(target).agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("content")).alias("size")).select(F.lit(attempt).alias("attempt"), F.lit("entry").alias("what"), "n", "size")
    first = publish.publish(part.select(path(F.lit("Pack")), content), target, folder="Pack", loads=loads)
    one = first.select(F.lit("published").alias("attempt"), F.col("problem").alias("what"), "n", F.lit(None).cast("long").alias("size")).union(inside("published"))
    rows = spark.createDataFrame(one.collect(), one.schema)  # a handful; the target is published over below
    # A seventh lies in another folder beside the one that it is loaded from.
    fewer = part.where("p_partkey % 10 <> 0")
    more = fewer.select(path(F.lit("Pack")), content).union(fewer.where("p_partkey % 7 = 0").select(path(F.lit("Other")), content))
    second = publish.publish(more, target, folder="Pack", loads=loads)
    return rows.union(second.select(F.lit("refused"), "problem", "n", F.lit(None).cast("long"))).union(inside("afterwards"))


@query(
    """select case when p_brand = 'Brand#1' then 'missing' when p_brand = 'Brand#2' then 'content differs' when p_brand = 'Brand#3' then 'size differs' else 'same' end as status, count(distinct p_brand)::bigint as files
from part group by 1 union all select 'extra', 1 where exists (select 1 from part where p_brand = 'Brand#1')"""
)
def copied_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9: a copy against its source by size and checksum: a file is missing, one new, one longer, one has other letters."""
    part = table(spark, sf_dir, "part").select(F.col("p_brand").alias("brand"), F.format_string("%s %s", "p_partkey", "p_name").alias("value"))
    source, target = staging.fresh(spark, "source"), staging.fresh(spark, "target")
    write = lambda rows, to: rows.repartition("brand").sortWithinPartitions("brand", "value").write.partitionBy("brand").text(to)
    write(part, source)
    b = F.col("brand")
    worn = F.when(b == "Brand#2", F.translate("value", "0123456789", "1234567890")).when(b == "Brand#3", F.concat("value", F.lit("!"))).otherwise(F.col("value"))
    write(part.select(F.when(b == "Brand#1", "Brand#1b").otherwise(b).alias("brand"), worn.alias("value")), target)
    of = lambda path: publish.files(spark, path, "*.txt").withColumn("path", F.substring_index("path", "/", 1))
    return reconcile.reconcile(of(source), of(target), content="sum").groupBy("status").agg(F.count(F.lit(1)).alias("files"))


@query("select event_id, event_type as outcome from events")
def report_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run of reports dies behind its second batch, is started again, and each row is there once."""
    e = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("outcome"))
    arriving, log = staging.fresh(spark, "outcomes"), staging.fresh(spark, "log")
    e.repartition(4, "event_id").write.parquet(arriving)
    stream = lambda: spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 2).parquet(arriving)
    write = publish.report_batch(log)

    def dies(rows: DataFrame, batch: int) -> None:
        write(rows, batch)
        if batch == 1:
            raise RuntimeError("killed")

    first = stream().writeStream.foreachBatch(dies).option("checkpointLocation", log + "-check").trigger(availableNow=True).start()
    try:
        first.awaitTermination()
    except Exception as error:  # noqa: BLE001
        if "killed" not in str(error):
            raise
    publish.report(stream(), log, log + "-check").awaitTermination()
    held = publish.reported(spark, log, "event_id long, outcome string")
    # What the log has isn't outstanding any more: no row is left to add.
    left = planner.resume(e, held, key="event_id")
    return held.select("event_id", "outcome").union(left.select("event_id", "outcome"))
