"""Shared plumbing of the operators: staged tables, id handling, bounded broadcasts."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Ids that are broadcast at most (16 bytes each) to pick texts out of a table; beyond it the table is shuffled.
BROADCAST_IDS = 2_000_000

#: The six white-space characters of all contracts: space and U+0009 to U+000D.
SPACE = " \t\n\x0b\x0c\r"


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors share: `spark.checkpoint.dir`; on one machine a folder of our own where that is unset."""
    own = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not own:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        own = "file://" + tempfile.gettempdir() + "/lectern-checkpoint"
    return own.rstrip("/")


#: What Spark hands a Python worker at once while a table is staged: rows, and bytes where the rows are long texts.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}


@contextlib.contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Bound the Arrow batches by what a worker can hold several times over.

    Spark's default is 10,000 rows whatever their size, and workers keep what a batch made them grow
    to. The session's own settings are back afterwards.
    """
    before = {k: spark.conf.get(k, None) for k in BATCHES}
    try:
        for k, v in BATCHES.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as Parquet into the shared folder and read it back.

    Cuts the lineage: what follows reads replicated files and survives lost executors. Values that
    depend on the partitioning (row ids) are fixed from here on. The folder goes when the driver ends.
    """
    spark = df.sparkSession
    root = f"{shared_dir(spark)}/lectern/{spark.sparkContext.applicationId}"
    path = f"{root}/{uuid.uuid4().hex}/{name}"
    with small_batches(spark):
        df.write.parquet(path)
    _folder(spark, root).deleteOnExit(_path(spark, root))
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path  # type: ignore[attr-defined]
    return out


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _folder(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def dropped(*tables: DataFrame) -> None:
    """Remove staged tables that nothing will read again."""
    for table in tables:
        if path := getattr(table, "staged_at", None):
            _folder(table.sparkSession, path).delete(_path(table.sparkSession, path), True)


T = TypeVar("T")


def tidied(batches: Iterable[T]) -> Iterator[T]:
    """The batches of a Python worker; when they end, freed memory goes back to the system, as workers are used again."""
    try:
        yield from batches
    finally:
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):
            ctypes.CDLL("libc.so.6").malloc_trim(0)


def free(name: str, taken: Iterable[str]) -> str:
    """The name, with underscores before it until no column has it."""
    have = {c.lower() for c in taken}
    while name.lower() in have:
        name = "_" + name
    return name


def picked(docs: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the names of the operator; all others, whatever their names, go."""
    return docs.select(*[docs[have].alias(want) for want, have in columns.items()])


def dense_rank_in(df: DataFrame, key: str, rows: int, per_group: int = 50_000, least: int = 64) -> DataFrame:
    """Add `rank`, gapless from 0 within `key`, without putting a key's rows into one task.

    `df` is a staged table with a column `mid` (unique row number). Rows of a key are dealt over
    salts; counts per (key, salt) give each salt its offset, and numbering happens within a salt.
    """
    from pyspark.sql import Window as W

    salts = max(least, -(-rows // per_group))
    dealt = df.withColumn("_salt", F.pmod(F.col("mid"), F.lit(salts)).cast("int"))
    counts = dealt.groupBy(key, "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(key).orderBy("_salt").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(F.col(key).alias("_k"), F.col("_salt").alias("_s"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    own = W.partitionBy(key, "_salt").orderBy("mid")
    ranked = dealt.withColumn("_rn", F.row_number().over(own) - 1)
    joined = ranked.join(offsets, (ranked[key] == offsets["_k"]) & (ranked["_salt"] == offsets["_s"]))
    return joined.withColumn("rank", (F.col("_off") + F.col("_rn")).cast("long")).drop("_salt", "_k", "_s", "_off", "_rn")


def in_training(doc_id: Column) -> Column:
    """The split of the contracts: rows whose crc32 of the id as text leaves another remainder than 2 by 4."""
    return ~held_out(doc_id)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
