"""Orders and samples. An order is a column `row_number` from 0, numbered over range partitions, so no task sorts all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions import match

from .planner import with_row_number


def by_length(rows: DataFrame) -> DataFrame:
    """(word, seq): shorter words first, within a length as they came."""
    return with_row_number(rows.withColumn("_len", F.length("word")), ("_len", "seq")).drop("_len")


def worst_first(rows: DataFrame) -> DataFrame:
    """(path, want, heard): clips of which the least is heard first."""
    return with_row_number(rows.withColumn("_kept", match.survival(F.col("want"), F.col("heard"))), ("_kept", "path")).drop("_kept")


def longest_first(rows: DataFrame) -> DataFrame:
    """(ratio, similarity, word, path, folder): the most overlong first, of these the least similar."""
    return with_row_number(rows.withColumn("_r", -F.col("ratio")), ("_r", "similarity", "word", "path", "folder")).drop("_r")


def known_first(rows: DataFrame, known: DataFrame) -> DataFrame:
    """(name): names in the order of a list (name, pos), those it lacks after them by name."""
    places = known.groupBy(F.col("name").alias("_name")).agg(F.min("pos").alias("_pos"))
    met = rows.join(places, F.col("name") == F.col("_name"), "left").withColumn("_pos", F.coalesce(F.col("_pos").cast("long"), F.lit((1 << 63) - 1)))
    return with_row_number(met, ("_pos", "name")).drop("_name", "_pos")


def seeded_sample(rows: DataFrame, k: int, seed: int, key: str) -> DataFrame:
    """k rows, the same for the same seed: those whose key has the least digest with it. Each task keeps its own k only."""
    return rows.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))), key).limit(k)


def preview(rows: DataFrame, k: int, *order: str) -> DataFrame:
    """The first k rows of a plan: what a dry run shows."""
    return rows.orderBy(*order).limit(k)
