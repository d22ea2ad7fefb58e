"""The queries over the driver's tables, with SQL where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, decontamination, language_id, line_dedup, merkle, near_dedup, packing, quality, secret_scan, sharding, spelling, suffix_dedup, toxicity
from ._store import held_out, in_training


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op2_kneser_ney_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    told = language_id.identify(docs, docs.where(in_training(F.col("doc_id"))))
    return told.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


def op3_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op4_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(table(spark, sf_dir, "documents"))


def op5_line_first_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).drop("clean_text")


def op6_cuckoo_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op7_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("tie")


def op8_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    told = toxicity.score_documents(docs, docs.where(in_training(F.col("doc_id"))), table(spark, sf_dir, "labels"))
    return told.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "passages")


def op9_setsketch_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op10_log_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffix_dedup.dedup_passages(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_rare_first_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.pmod(F.crc32(F.col("own_id").cast("string").cast("binary")), F.lit(7)) == 0
    done = merkle.manifest(table(spark, sf_dir, "documents"), tampered=tampered)
    return done.select("doc_id", "leaf", "subroot", "root", F.sha2(F.col("proof").cast("binary"), 256).alias("proof_sha256"), "folded_root", "verified")


def op13_merge_replay_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode(table(spark, sf_dir, "documents"), digests=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_best_fit_packing, op2_kneser_ney_language_id, op3_rendezvous_sharding, op4_secret_ownership, op5_line_first_quality, op6_cuckoo_line_dedup, op7_template_decontamination, op8_toxic_segments, op9_setsketch_near_dedup, op10_log_suffix_dedup, op11_rare_first_spelling, op12_merkle_manifest, op13_merge_replay_bpe)
}

SQL: dict[str, str] = {
    "op6_cuckoo_line_dedup": r"""
with lines as (
  select doc_id, n, line, lower_key as key from (
    select doc_id, unnest(range(1, len(ls) + 1)) as n, unnest(ls) as line,
           unnest(list_transform(ls, lambda x: translate(regexp_replace(regexp_replace(x, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))) as lower_key
    from (select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents))),
often as (select key, max(doc_id) as last_doc from lines where length(key) >= 40 group by key having count(distinct doc_id) >= 5)
select doc_id, count(*)::bigint as n_lines,
       count(*) filter (o.key is not null and doc_id <> last_doc)::bigint as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by n) filter (o.key is null or doc_id = last_doc), '')) as kept_sha256
from lines left join often o using (key) group by doc_id
""",
}
