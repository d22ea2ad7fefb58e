"""Writing that is checked before it counts: packs published only when they read back right, copies
compared by checksum, and a report log to which a repeated batch adds nothing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lectern.operators import reconcile

#: Bytes that a pack may hold: what the distributor takes.
LIMIT = 2_000_000_000
PROBLEMS = "problem string, n long, example string"


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _measured(entries: DataFrame) -> DataFrame:
    return entries.select("path", F.octet_length("content").cast("long").alias("size"), F.sha2("content", 256).alias("sum"))


def write_pack(entries: DataFrame, path: str) -> None:
    """Entries (path, content) as a folder of Parquet files, over what was there."""
    entries.select("path", "content").write.mode("overwrite").parquet(path)


def problems_of(entries: DataFrame, written: str, *, folder: str, loads: DataFrame | None = None, limit: int = LIMIT) -> DataFrame:
    """problem, n, example: what a written pack lacks, has too much or holds with other bytes than its entries; what its
    manifest loads (path) and it lacks; paths outside its folder; too many bytes. Empty if it may be published.

    The pack is read back whole, and every entry's checksum taken anew from what was read.
    """
    found = _measured(entries.sparkSession.read.schema("path string, content binary").parquet(written))
    compared = reconcile.reconcile(_measured(entries), found, content="sum").where("status <> 'same'").select(F.col("status").alias("problem"), "path")
    outside = found.where(~F.startswith("path", F.lit(folder + "/"))).select(F.lit("outside the folder").alias("problem"), "path")
    told = compared.union(outside)
    if loads is not None:
        told = told.union(loads.select("path").distinct().join(found, "path", "left_anti").select(F.lit("loaded but absent").alias("problem"), "path"))
    counted = told.groupBy("problem").agg(F.count(F.lit(1)).alias("n"), F.min("path").alias("example"))
    heavy = found.agg(F.sum("size").alias("n")).where(F.col("n") > limit).select(F.lit("over the limit").alias("problem"), "n", F.lit(None).cast("string").alias("example"))
    return counted.union(heavy)


def publish(entries: DataFrame, target: str, *, folder: str, loads: DataFrame | None = None, limit: int = LIMIT, write: Callable[[DataFrame, str], None] = write_pack) -> DataFrame:
    """Write a pack beside its target, read it back, and put it in the target's place only if nothing is wrong.

    Returns the problems, none if it was published. A refused pack leaves the target as it was, and
    stays beside it to be looked at until the next try. Files that can't be read are a problem too.
    """
    spark, aside = entries.sparkSession, target.rstrip("/") + ".partial"
    write(entries, aside)
    try:
        # At most six rows: one for each kind of problem.
        told = [tuple(r) for r in problems_of(entries, aside, folder=folder, loads=loads, limit=limit).collect()]
    except Exception as e:  # noqa: BLE001 - a torn file fails in many ways; all of them forbid publishing
        told = [("unreadable", 1, str(e).splitlines()[0][:200])]
    if not told:
        system, place = _at(spark, target)
        system.delete(place, True)
        if not system.rename(_at(spark, aside)[1], place):
            told = [("not renamed", 1, target)]
    return spark.createDataFrame(told, PROBLEMS)


def files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path (below the folder), size, sum of all files below a folder; their contents are read for the checksum. Spark's readers skip empty files."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    root = _at(spark, path)[0].makeQualified(_at(spark, path)[1]).toString().rstrip("/") + "/"
    below = F.expr("substring(path, {})".format(len(root) + 1))
    return read.select(below.alias("path"), F.col("length").alias("size"), F.sha2("content", 256).alias("sum"))


def compared(spark: SparkSession, source: str, target: str, pattern: str = "*") -> DataFrame:
    """path, expected_size, written_size, status of a copy, file by file."""
    return reconcile.reconcile(files(spark, source, pattern), files(spark, target, pattern), content="sum")


def report_batch(path: str) -> Callable[[DataFrame, int], None]:
    """What a stream's foreachBatch does to log its rows: a batch has a folder of its own, written over when the batch comes again."""

    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").json(f"{path}/batch={batch}")

    return write


def report(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Log a stream's rows as JSON lines; a run that dies anywhere and starts again leaves each row once."""
    return stream.writeStream.foreachBatch(report_batch(path)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def reported(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of a log."""
    return spark.read.schema(schema).json(f"{path}/batch=*")
