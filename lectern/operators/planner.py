"""Planning: which clips are missing, stale or done, and in what order the rest is made.

Inventories and plans are joined by path; keys are high-cardinality strings, so the joins shuffle
evenly. Dimensions (voices, packs, priority lists) are small by nature but not proven so; their joins
are left to Catalyst's own size check.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.functions import ident, small, text


def valid_quest_id(id_: Column) -> Column:
    """The id as a number where it is a non-negative one; null for gossip and named ids."""
    n = id_.cast("string").try_cast("bigint")
    return F.when(n >= 0, n)


def quest_plan(corpus: DataFrame, *, fields: tuple[str, ...] = tuple(ident.FIELD_LETTERS), compose: bool = True) -> DataFrame:
    """kind, id, field, sentence, path, text, hash: one row per clip of each passage of (id, fields...)."""
    rows = corpus.withColumn("id", valid_quest_id(F.col("id"))).where("id is not null")
    each = rows.select("id", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("passage")) for f in fields])).alias("p"))
    clips = each.select("id", "p.field", F.posexplode(text.clips(text.clean(F.col("p.passage"), compose=compose))).alias("i", "clip"))
    made = clips.select(F.lit("quest").alias("kind"), "id", "field", (F.col("i") + 1).alias("sentence"), F.col("clip.text").alias("text"))
    return made.select("kind", "id", "field", "sentence", ident.quest_path(F.col("id"), F.col("field"), F.col("sentence")).alias("path"), "text", ident.text_hash(F.col("text")).alias("hash"))


def word_plan(dictionary: DataFrame, *, order: str = "pos") -> DataFrame:
    """kind, key, path, text, hash of dictionary rows (key, word, pos); the first row of a key wins."""
    first = dictionary.where("key is not null").groupBy("key").agg(F.min_by("word", order).alias("text"))
    return first.select(F.lit("word").alias("kind"), "key", ident.word_path(F.col("key")).alias("path"), "text", ident.text_hash(F.col("text")).alias("hash"))


def whole_plan(quests: DataFrame, words: DataFrame) -> DataFrame:
    return quests.unionByName(words, allowMissingColumns=True)


def cast_voices(plan: DataFrame, quest_voice: DataFrame, presets: dict[str, str], default: str) -> DataFrame:
    """With voice and stamp: quests by their giver's sex, words and all others by default."""
    named = F.element_at(F.create_map(*[F.lit(x) for kv in presets.items() for x in kv]), F.col("sex")) if presets else F.lit(None).cast("string")
    met = plan.join(quest_voice.select(F.col("quest_id").alias("id"), "sex"), "id", "left")
    cast = met.withColumn("voice", F.when(F.col("kind") == "word", F.lit(default)).otherwise(F.coalesce(named, F.lit(default)))).drop("sex")
    return cast.withColumn("stamp", F.concat_ws(" ", "hash", "voice"))


def cast_by_chain(speakers: DataFrame, presets: DataFrame, default: str) -> DataFrame:
    """voice of (race, sex) rows: a preset for both, else one for the sex, else the default.

    presets: name, voice; names are "race_sex" or "sex".
    """
    both = presets.select(F.col("name").alias("b"), F.col("voice").alias("both"))
    sex = presets.select(F.col("name").alias("s"), F.col("voice").alias("by_sex"))
    met = speakers.join(both, F.concat_ws("_", "race", "sex") == F.col("b"), "left").join(sex, F.col("sex") == F.col("s"), "left")
    return met.withColumn("voice", F.coalesce("both", "by_sex", F.lit(default))).drop("b", "s", "both", "by_sex")


def plan_status(plan: DataFrame, inventory: DataFrame, previous: DataFrame) -> DataFrame:
    """plan with status: missing without a clip, stale where the previous plan had another or no hash, else done."""
    have = inventory.select("path", F.lit(True).alias("_have")).distinct()
    known = previous.groupBy("path").agg(F.max("hash").alias("_known"))
    met = plan.join(have, "path", "left").join(known, "path", "left")
    status = F.when(F.isnull("_have"), "missing").when(~F.col("hash").eqNullSafe(F.col("_known")), "stale").otherwise("done")
    return met.withColumn("status", status).drop("_have", "_known")


def outstanding(cast_plan: DataFrame, stamps: DataFrame) -> DataFrame:
    """Rows of a cast plan without a clip, or whose stamp differs from what they are to be."""
    have = stamps.select("path", F.col("stamp").alias("_stamp"))
    met = cast_plan.join(have, "path", "left")
    return met.where(~F.col("stamp").eqNullSafe(F.col("_stamp"))).drop("_stamp")


def missing(plan: DataFrame, inventory: DataFrame) -> DataFrame:
    return plan.join(inventory, "path", "left_anti")


def orphans(inventory: DataFrame, plan: DataFrame) -> DataFrame:
    return inventory.join(plan, "path", "left_anti")


def resume(rows: DataFrame, *reports: DataFrame, key: str = "path") -> DataFrame:
    """Rows that no report has yet."""
    done = reports[0].select(key)
    for r in reports[1:]:
        done = done.union(r.select(key))
    return rows.join(done.distinct(), key, "left_anti")


def restricted(rows: DataFrame, paths: DataFrame, *, in_list_order: bool = False) -> DataFrame:
    """Rows of the named paths; optionally with list_pos, the place of the path in the list (path, pos)."""
    if not in_list_order:
        return rows.join(paths, "path", "left_semi")
    return rows.join(paths.groupBy("path").agg(F.min("pos").alias("list_pos")), "path")


def release_order(plan: DataFrame, packs: DataFrame, *, n_packs: int) -> DataFrame:
    """With rank: quests by the rank of their pack (name, rank), then quests of no pack, words last.

    Sort by (rank, order_id, path): words have order_id 0.
    """
    met = plan.join(packs.select(F.col("name").alias("pack"), F.col("rank").alias("_rank")), "pack", "left")
    rank = F.when(F.col("kind") == "word", F.lit(n_packs + 1)).otherwise(F.coalesce("_rank", F.lit(n_packs)))
    return met.withColumn("rank", rank).withColumn("order_id", F.when(F.col("kind") == "word", F.lit(0).cast("long")).otherwise(F.col("id").cast("long"))).drop("_rank")


def prioritised(rows: DataFrame, first: DataFrame) -> DataFrame:
    """With priority: the place in the list (quest_id, pos) for quests named there, null for the rest."""
    listed = first.groupBy("quest_id").agg(F.min("pos").alias("priority"))
    return rows.join(listed, rows["id"] == listed["quest_id"], "left").drop("quest_id")


def counts_by_kind(status: DataFrame) -> DataFrame:
    """kind, clips, done, missing, stale, hours."""
    n = lambda s: F.count_if(F.col("status") == s).alias(s)
    return status.groupBy("kind").agg(F.count(F.lit(1)).alias("clips"), n("done"), n("missing"), n("stale"), small.spoken_hours(F.sum(F.length("text"))).alias("hours"))


def remaining_by_pack(todo: DataFrame) -> DataFrame:
    """pack, rank, clips, through: what is left per pack in queue order, with the running total.

    The window runs over one row per pack: a bounded handful.
    """
    per = todo.groupBy("rank", F.coalesce("pack", F.when(F.col("kind") == "word", "words").otherwise("none")).alias("pack")).agg(F.count(F.lit(1)).alias("clips"))
    return per.withColumn("through", F.sum("clips").over(W.orderBy("rank", "pack").rowsBetween(W.unboundedPreceding, W.currentRow)))


def systematic_sample(rows: DataFrame, k: int, *, order: tuple[str, ...]) -> DataFrame:
    """Every step-th row by `order`, the first k of them, with step = max(1, n div k)."""
    numbered = with_row_number(rows, order)
    step = max(1, rows.count() // k)
    return numbered.where((F.col("row_number") % step == 0) & (F.col("row_number") < step * k)).drop("row_number")


def shard(rows: DataFrame, i: int, of: int, *, order: tuple[str, ...]) -> DataFrame:
    """Rows whose number by `order` leaves the remainder i."""
    return with_row_number(rows, order).where(F.col("row_number") % of == i).drop("row_number")


def with_row_number(rows: DataFrame, order: tuple[str, ...], *, by: tuple[str, ...] = ()) -> DataFrame:
    """With row_number from 0 by `order`, over all rows or within the groups of `by`; no task sorts all rows.

    Split points are sampled once and are literals from then on, so a row's bucket is a function of
    its own values: however often, and over whatever partitions, Spark evaluates the rows, the counts
    and the numbering agree. Rows are numbered within their bucket, after all buckets before it.

    `order` must tell the rows of a group apart, or rows that tie are numbered in any order; nulls come
    first. The rows must be the same whenever they are read: stage random ones first.
    """
    keys = (*by, *order)
    bucketed = with_bucket(rows, split_points(rows, keys), keys)
    counts = bucketed.groupBy("_bucket", *by).agg(F.count(F.lit(1)).alias("_n"))
    # A row per bucket, and one more for each group that begins within one.
    earlier = W.partitionBy(*by).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    before = counts.select(F.col("_bucket").alias("_b"), *[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)], F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    within = bucketed.withColumn("_k", F.row_number().over(W.partitionBy("_bucket", *by).orderBy(*order)) - 1)
    same = F.col("_bucket") == F.col("_b")
    for i, c in enumerate(by):
        same = same & within[c].eqNullSafe(F.col(f"_by{i}"))
    met = within.join(before if by else F.broadcast(before), same)
    return met.withColumn("row_number", (F.col("_before") + F.col("_k")).cast("long")).drop("_bucket", "_b", "_before", "_k", *[f"_by{i}" for i in range(len(by))])


def running(rows: DataFrame, order: tuple[str, ...], name: str, total: Callable[[Column], Column], value: Column, *, before: bool = False) -> DataFrame:
    """With `name`: F.sum or F.max of the value over all rows up to this one by `order`, or only those before it.

    As for row numbers, buckets are summed up first, and what stands before a bucket is one row.
    """
    bucketed = with_bucket(rows, split_points(rows, order), order).withColumn("_value", value)
    sums = bucketed.groupBy(F.col("_bucket").alias("_b")).agg(total(F.col("_value")).alias("_sum"))
    earlier = W.orderBy("_b").rowsBetween(W.unboundedPreceding, -1)  # a row per bucket
    carried = sums.select("_b", total(F.col("_sum")).over(earlier).alias("_carried"))
    own = W.partitionBy("_bucket").orderBy(*order).rowsBetween(W.unboundedPreceding, -1 if before else W.currentRow)
    met = bucketed.withColumn("_own", total(F.col("_value")).over(own)).join(F.broadcast(carried), F.col("_bucket") == F.col("_b"))
    # The total of two totals; null where there is no row yet.
    both = F.array_compact(F.array("_carried", "_own"))
    joined = F.array_max(both) if total is F.max else F.when(F.size(both) > 0, F.coalesce("_carried", F.lit(0)) + F.coalesce("_own", F.lit(0)))
    return met.withColumn(name, joined).drop("_bucket", "_value", "_b", "_carried", "_own")


#: Rows of a bucket on average, sampled rows for each, and buckets at most (their bounds are literals of the plan).
BUCKET_ROWS, SAMPLED, MOST_BUCKETS = 50_000, 40, 1_024


def split_points(rows: DataFrame, keys: tuple[str, ...]) -> list[Column]:
    """Ascending literals, structs of the keys, that part the rows into buckets of about equally many.

    About MOST_BUCKETS x SAMPLED rows of keys come to the driver at most, and all of them count: split
    points of only the first would leave the rest of the rows to the last bucket. The sample decides
    how even the buckets are, never what a row's number is.
    """
    own = rows.select(*keys)
    n = own.count()
    buckets = min(MOST_BUCKETS, -(-n // BUCKET_ROWS))
    if buckets < 2:
        return []
    key = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keys)])
    drawn = own.sample(min(1.0, buckets * SAMPLED / n), seed=n).select(key.alias("k")).orderBy("k").collect()
    picked = list(dict.fromkeys(drawn[len(drawn) * k // buckets]["k"] for k in range(1, buckets) if drawn))
    return [F.struct(*[F.lit(v).cast(f.dataType).alias(f"k{i}") for i, (v, f) in enumerate(zip(r, own.schema.fields))]) for r in picked]


def with_bucket(rows: DataFrame, bounds: list[Column], keys: tuple[str, ...]) -> DataFrame:
    """With _bucket: the number of bounds at or below the keys; not falling along the order, whatever the bounds.

    The bounds are one literal that is bisected, a projection a step: a comparison in the plan for each
    of them makes code that no longer links from some hundreds on.
    """
    key = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keys)])
    found = rows.withColumn("_bucket", F.lit(0))
    if not bounds:
        return found
    found = found.withColumn("_bounds", F.array(*bounds))
    at = F.col("_bucket")
    for k in reversed(range(len(bounds).bit_length())):
        # Null behind the last bound, where the step isn't taken.
        found = found.withColumn("_bucket", F.when(F.get("_bounds", at + ((1 << k) - 1)) <= key, at + (1 << k)).otherwise(at))
    return found.drop("_bounds")


def new_words(passages: DataFrame, dictionary: DataFrame, *, order: str = "pos") -> DataFrame:
    """key, word: words of (text, pos) that no headword of (key) has, in their first-seen spelling."""
    each = passages.select(F.col(order).alias("_pos"), F.posexplode(text.word_tokens(F.col("text"))).alias("_i", "word"))
    first = each.groupBy(text.fold_case(F.col("word")).alias("key")).agg(F.min_by("word", F.struct("_pos", "_i")).alias("word"))
    return first.join(dictionary.select(text.fold_case(F.col("key")).alias("key")), "key", "left_anti")
