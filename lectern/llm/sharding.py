"""Sharding by weighted rendezvous hashing, in DataFrame functions only.

Every (record key, shard) pair has a score, -weight / ln(u) with u a uniform hash of the two; the
shard of the greatest score takes the record. A new shard therefore takes records only into itself,
and a shard's share follows its weight. Slots number a shard's records from 0 without a task ever
holding a whole shard.

Edge cases: a null text has no bytes and crc32 0; a null id is a key like any other ("" after
prefixing), so all such rows share a shard; repeated rows go to the same shard and get slots of
their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._store import dense_rank_in, picked, staged

SHARDS = 40
OVERHEAD = 16


def score(key: Column, shard: Column, weight: Column) -> Column:
    uniform = (F.xxhash64(key, shard).bitwiseAND((1 << 53) - 1).cast("double") + 0.5) / float(1 << 53)
    return -weight / F.ln(uniform)


def winner(key: Column, weights: list[float]) -> Column:
    """struct(score, shard) of the shard that takes `key`; ties go to the larger number."""
    shards = F.array(*[F.struct(F.lit(i).alias("shard"), F.lit(float(w)).alias("weight")) for i, w in enumerate(weights)])
    scored = F.transform(shards, lambda s: F.struct(score(key, s["shard"], s["weight"]).alias("score"), s["shard"].alias("shard")))
    return F.array_max(scored)


def shard(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, weights: list[float] | None = None, new_weight: float = 1.0) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    weights = weights or [1.0] * shards
    rows = picked(docs, doc_id=id_col, text=text_col)
    key = F.coalesce(F.concat(F.lit("k"), F.col("doc_id").cast("string")), F.lit(""))
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = rows.select("doc_id", key.alias("key"), (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    won = keyed.withColumn("won", winner(F.col("key"), weights))
    newer = score(F.col("key"), F.lit(len(weights)), F.lit(float(new_weight)))
    dealt = won.select("doc_id", "size", "text_crc32", F.col("won.shard").alias("shard"), F.when(newer > F.col("won.score"), F.lit(len(weights))).otherwise(F.col("won.shard")).alias("grown_shard"), F.monotonically_increasing_id().alias("mid"))
    table = staged(dealt, "dealt")
    most = table.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    slotted = dense_rank_in(table, "shard", most)
    return slotted.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), F.col("shard").cast("int"), F.col("rank").alias("slot"), F.col("grown_shard").cast("int"))
