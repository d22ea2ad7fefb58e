"""Packs: id ranges, passage tables, totals, coverage, bin packing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.functions import small

from .planner import split_points, with_bucket, with_row_number


#: Ranges that are broadcast at most (some 100 bytes each, and every row is compared with each); more of them are met in bins.
BROADCAST_RANGES = 1_000

#: A bin is this much wider than the bins of the level below it.
BASE = 16
#: Bins of the widest level over the span of the ids.
WIDEST = 1 << 16


def assign(rows: DataFrame, packs: DataFrame, special: DataFrame | None = None, *, key: str = "id") -> DataFrame:
    """With pack: the pack (name, low, high) whose inclusive range holds the id; ids in `special`
    (quest_id, name) go where that says. Ids in no range have null. Ranges must not overlap."""
    dim = packs.select(F.col("name").alias("_pack"), F.col("low").cast("long").alias("_low"), F.col("high").cast("long").alias("_high"))
    if dim.limit(BROADCAST_RANGES + 1).count() <= BROADCAST_RANGES:
        met = rows.join(F.broadcast(dim), rows[key].between(F.col("_low"), F.col("_high")), "left").drop("_low", "_high")
    else:
        # Ids are looked up once each; rows meet what was found by equality.
        found = holding(rows.select(F.col(key).cast("long").alias("_v")), dim).select(F.col("_v").alias("_id"), "_pack")
        met = rows.join(found, rows[key].cast("long") == found["_id"], "left").drop("_id")
    if special is None:
        return met.withColumnRenamed("_pack", "pack")
    own = special.select(F.col("quest_id").alias("_q"), F.col("name").alias("_own"))
    return met.join(own, met[key] == own["_q"], "left").withColumn("pack", F.coalesce("_own", "_pack")).drop("_q", "_own", "_pack")


def holding(ids: DataFrame, ranges: DataFrame) -> DataFrame:
    """Each different id (_v) with each range (_low, _high and more) that holds it, by equality of bins and then the bounds.

    A range belongs to the level whose bins are as wide as it, or up to BASE times wider, so it lies in
    two bins at most; of ranges that don't overlap a bin has BASE + 1 at most. An id asks one bin of
    each level in use, sixteen at most. Where a level's bins would hold more than a share of
    1 / WIDEST of the ids' span, ranges are laid over several bins of that width instead: as they
    don't overlap, over WIDEST more than there are ranges in all. Ranges that do overlap give right
    results too, in fuller bins.
    """
    asked = ids.where("_v is not null").distinct()
    least, greatest = asked.agg(F.min("_v"), F.max("_v")).first()
    kept = ranges.where(F.lit(least is not None) & (F.col("_low") <= F.col("_high")) & (F.col("_high") >= F.lit(least)) & (F.col("_low") <= F.lit(greatest)))
    # Within the ids' span nothing overflows.
    low, high = (bound.cast("decimal(20,0)") - F.lit(least) for bound in (F.greatest(F.col("_low"), F.lit(least)), F.least(F.col("_high"), F.lit(greatest))))
    top = 0
    while least is not None and BASE ** (top + 1) * WIDEST <= greatest - least:
        top += 1
    level = F.lit(top)
    for l in range(top - 1, -1, -1):
        level = F.when(high - low < BASE**l, F.lit(l)).otherwise(level)
    levelled = kept.select("*", low.alias("_from"), high.alias("_to"), level.alias("_level"))
    used = sorted(r[0] for r in levelled.select("_level").distinct().collect())
    bins = lambda v, l: F.floor(v / BASE**l).cast("long")
    first, last = (F.coalesce(*[F.when(F.col("_level") == l, bins(F.col(c), l)) for l in used or [0]]) for c in ("_from", "_to"))
    laid = levelled.withColumn("_bin", F.explode(F.sequence(first, last))).drop("_from", "_to")
    places = [F.struct(F.lit(l).alias("_level"), bins(F.col("_v").cast("decimal(20,0)") - F.lit(least), l).alias("_bin")) for l in used or [0]]
    asking = asked.select("_v", F.inline(F.array(*places)))
    return asking.join(laid, ["_level", "_bin"]).where("_v between _low and _high").drop("_level", "_bin")


def overlapping(packs: DataFrame) -> DataFrame:
    """Pairs of packs whose ranges overlap, by name: empty where `assign` is well defined. Of two that do, the later begin lies in the other."""
    other = packs.select(F.col("name").alias("_other"), F.col("low").cast("long").alias("_low"), F.col("high").cast("long").alias("_high"))
    begins = packs.where("low <= high").select(F.col("name").alias("_name"), F.col("low").cast("long").alias("_begin"))
    met = begins.join(holding(begins.select(F.col("_begin").alias("_v")), other), F.col("_begin") == F.col("_v"))
    pairs = met.where("_name <> _other").select(F.least("_name", "_other").alias("one"), F.greatest("_name", "_other").alias("other"))
    return pairs.distinct()


def passage_lengths(durations: DataFrame) -> DataFrame:
    """quest_id, letter, lengths, has_gap of (quest_id, letter, idx, centis): by index, gaps closed up."""
    by = F.array_sort(F.collect_list(F.struct("idx", "centis")))
    return durations.groupBy("quest_id", "letter").agg(by.alias("_x")).select("quest_id", "letter", F.transform("_x", lambda x: x["centis"]).alias("lengths"), (F.element_at("_x", -1)["idx"] != F.size("_x")).alias("has_gap"))


def as_table(lengths: DataFrame) -> DataFrame:
    """value: lines "quest letter n,n,..."; sort by (quest_id, letter) to write."""
    return lengths.select("quest_id", "letter", F.concat_ws(" ", F.col("quest_id").cast("string"), "letter", F.array_join(F.col("lengths").cast("array<string>"), ",")).alias("value"))


def parse_table(lines: DataFrame) -> DataFrame:
    """quest_id, letter, lengths of lines as `as_table` writes them; other lines are skipped."""
    parts = F.split("value", " ")
    ok = F.col("value").rlike(r"^\d+ [a-z] \d+(,\d+)*$")
    return lines.where(ok).select(F.get(parts, 0).cast("long").alias("quest_id"), F.get(parts, 1).alias("letter"), F.transform(F.split(F.get(parts, 2), ","), lambda v: v.cast("int")).alias("lengths"))


def totals(lengths: DataFrame, *by: str) -> DataFrame:
    """clips and hours, in all or by columns."""
    clips = F.sum(F.size("lengths")).alias("clips")
    hours = (F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)) / 100 / 3600).alias("hours")
    return lengths.groupBy(*by).agg(clips, hours)


def timeline(durations: DataFrame, gap_centis: int = 25) -> DataFrame:
    """With start and total in centiseconds of each clip of its passage: lengths before it plus a gap after each but the last."""
    passage = W.partitionBy("quest_id", "letter")
    before = passage.orderBy("idx", "centis").rowsBetween(W.unboundedPreceding, -1)
    n = F.count(F.lit(1)).over(passage)
    return durations.withColumn("start", F.coalesce(F.sum("centis").over(before), F.lit(0)) + gap_centis * (F.row_number().over(passage.orderBy("idx", "centis")) - 1)).withColumn("total", F.sum("centis").over(passage) + gap_centis * (n - 1))


def spans(starts: DataFrame) -> DataFrame:
    """quest_id, letter, idx, first, last of (quest_id, letter, firsts, n_sentences): a clip ends before the next begins."""
    each = starts.select("quest_id", "letter", "n_sentences", F.posexplode("firsts").alias("i", "first"), "firsts")
    nxt = F.coalesce(F.get("firsts", F.col("i") + 1), F.col("n_sentences") + 1)
    return each.select("quest_id", "letter", (F.col("i") + 1).alias("idx"), "first", F.greatest(nxt - 1, F.col("first")).alias("last"))


def clip_spans(passages: DataFrame, starts: DataFrame, lengths: DataFrame) -> DataFrame:
    """quest_id, letter, firsts of passages (quest_id, letter, has_starts, n_sentences, own_firsts).

    With a grouping table: its row, or one clip for each length (or sentence). Without: the client's own grouping.
    """
    key = ["quest_id", "letter"]
    met = passages.join(starts.select(*key, F.col("firsts").alias("_row")), key, "left").join(lengths.select(*key, F.size("lengths").alias("_n")), key, "left")
    n = F.coalesce("_n", "n_sentences")
    plain = F.when(n > 0, F.sequence(F.lit(1), n.cast("int"))).otherwise(F.array().cast("array<int>"))
    return met.select(*key, F.when(F.col("has_starts"), F.coalesce("_row", plain)).otherwise(F.col("own_firsts")).alias("firsts"))


def accepted_groupings(groupings: DataFrame, lengths: DataFrame) -> DataFrame:
    """With accepted: whether a grouping (quest_id, letter, firsts) has as many clips as there are lengths."""
    key = ["quest_id", "letter"]
    return groupings.join(lengths.select(*key, F.size("lengths").alias("clips")), key).withColumn("accepted", F.size("firsts") == F.col("clips"))


def islands(rows: DataFrame, key: str = "id", *by: str, buckets: int = 1 << 16) -> DataFrame:
    """low, high: runs of consecutive ids, duplicates removed.

    Ids are first merged within blocks of `buckets` neighbouring ids, each a task of bounded size;
    only the blocks' runs, of which those that touch a border matter, meet in the second step.
    """
    ids = rows.where(F.col(key).isNotNull()).select(*by, F.col(key).cast("long").alias("_v")).distinct()
    blocked = ids.withColumn("_b", F.floor(F.col("_v") / buckets))
    local = blocked.withColumn("_g", F.col("_v") - F.row_number().over(W.partitionBy(*by, "_b").orderBy("_v")))
    runs = local.groupBy(*by, "_b", "_g").agg(F.min("_v").alias("low"), F.max("_v").alias("high"))
    inner = (F.pmod("low", F.lit(buckets)) > 0) & (F.pmod(F.col("high") + 1, F.lit(buckets)) > 0)
    edge = runs.where(~inner)
    w = W.partitionBy(*by).orderBy("low")
    joined = edge.withColumn("_new", F.when(F.lag("high").over(w) == F.col("low") - 1, 0).otherwise(1)).withColumn("_run", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, W.currentRow)))
    return runs.where(inner).select(*by, "low", "high").union(joined.groupBy(*by, "_run").agg(F.min("low").alias("low"), F.max("high").alias("high")).select(*by, "low", "high"))


def without_points(ranges: DataFrame, points: DataFrame) -> DataFrame:
    """low, high: ranges less single ids; what is left on each side of an id stays. Ranges must not overlap.

    Each id knows the ids before and after it by its number, so what is left of a range is told by its
    ids one by one, however many a range has.
    """
    ids = points.where("id is not null").select(F.col("id").cast("long").alias("_v")).distinct()
    numbered = with_row_number(ids, ("_v",))
    beside = lambda name, step: numbered.select((F.col("row_number") + step).alias("row_number"), F.col("_v").alias(name))
    known = numbered.join(beside("_before", 1), "row_number", "left").join(beside("_after", -1), "row_number", "left").drop("row_number")
    whole = ranges.where("low <= high").select(F.col("low").cast("long").alias("_low"), F.col("high").cast("long").alias("_high"))
    met = holding(ids, whole).join(known, "_v")
    # Null beside the first and the last id; greatest and least skip it.
    left = F.struct(F.greatest(F.col("_low"), F.col("_before") + 1).alias("low"), (F.col("_v") - 1).alias("high"))
    right = F.struct((F.col("_v") + 1).alias("low"), F.col("_high").alias("high"))
    cut = met.select(F.inline(F.array_compact(F.array(left, F.when(F.col("_after").isNull() | (F.col("_after") > F.col("_high")), right))))).where("low <= high")
    untouched = whole.join(met.select("_low", "_high").distinct(), ["_low", "_high"], "left_anti")
    return cut.union(untouched)


def merged(ranges: DataFrame) -> DataFrame:
    """low, high: ranges that overlap or touch joined to one; empty ranges go. Runs of any length, over any number of tasks.

    Ranges join within buckets of neighbours first. Of these runs, a bucket's first ones may go on from
    the buckets before it: they belong to the last run that began there. The rest begin one.
    """
    order = ("low", "high")
    own = ranges.where("low <= high").select(F.col("low").cast("long").alias("low"), F.col("high").cast("long").alias("high"))
    bucketed = with_bucket(own, split_points(own, order), order)
    w = W.partitionBy("_bucket").orderBy(*order)
    topped = bucketed.withColumn("_top", F.max("high").over(w.rowsBetween(W.unboundedPreceding, -1)))
    begins = F.when(F.col("low") <= F.col("_top") + 1, 0).otherwise(1)
    local = topped.withColumn("_run", F.sum(begins).over(w.rowsBetween(W.unboundedPreceding, W.currentRow)))
    runs = local.groupBy("_bucket", "_run").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    earlier = W.orderBy("_b").rowsBetween(W.unboundedPreceding, -1)  # a row per bucket
    tops = bucketed.groupBy(F.col("_bucket").alias("_b")).agg(F.max("high").alias("_high"))
    carried = tops.select("_b", F.max("_high").over(earlier).alias("_carried"))
    met = runs.join(F.broadcast(carried), F.col("_bucket") == F.col("_b")).drop("_b")
    placed = met.withColumn("_first", F.when(F.col("_carried").isNull() | (F.col("low") > F.col("_carried") + 1), F.col("low")))
    lasts = placed.groupBy(F.col("_bucket").alias("_b")).agg(F.max("_first").alias("_own"))
    before = lasts.select("_b", F.max("_own").over(earlier).alias("_before"))
    whole = placed.join(F.broadcast(before), F.col("_bucket") == F.col("_b")).groupBy(F.coalesce("_first", "_before").alias("low"))
    return whole.agg(F.max("high").alias("high"))


def coverage(expansions: DataFrame, layout: DataFrame, counts: DataFrame) -> DataFrame:
    """Expansions (name, low, high) with the pack that carries them and its counts (pack, clips); "not recorded" without one."""
    met = expansions.join(layout.select("name", "pack"), "name", "left").join(counts, "pack", "left")
    return met.select("name", "low", "high", F.coalesce("pack", F.lit("not recorded")).alias("pack"), F.coalesce("clips", F.lit(0)).alias("clips"))


def bin_layout(sizes: DataFrame, cap: Column | float) -> DataFrame:
    """name, pos, part: ordered packs (name, pos, size) in the fewest runs within the cap, and of these the largest run least.

    For a dimension, of tens to some thousands of rows: it becomes one row of lists, over which the
    plan of every suffix is built from the right. The best plan of a suffix is a cut and the best plan
    of the rest; of equal ones the earliest cut stays. A pack beyond the cap is a run of its own. The
    cap is a number or an aggregate over the sizes' rows.
    """
    cap = cap if isinstance(cap, Column) else F.lit(float(cap))
    gathered = sizes.agg(F.array_sort(F.collect_list(F.struct("pos", F.col("size").cast("double").alias("size"), "name"))).alias("rows"), small.capped(cap).alias("cap"))
    capped = gathered.select("rows", F.size("rows").alias("n"), "cap")
    # upto[k]: the size of the first k; a plan: runs, largest run, first cut.
    upto = F.aggregate("rows", F.array(F.lit(0.0)), lambda a, r: F.concat(a, F.array(F.element_at(a, -1) + r["size"])))
    made = capped.select("rows", "n", "cap", upto.alias("upto"))
    plan = lambda n, big, cut: F.struct(n.cast("int").alias("n"), big.cast("double").alias("big"), cut.cast("int").alias("cut"))

    def longer(best: Column, i: Column) -> Column:
        """With the plan of the suffix that begins one pack sooner, at i, before those of the suffixes behind it."""
        total = lambda j: F.get("upto", j) - F.get("upto", i)
        cuts = F.filter(F.sequence(i + 1, F.col("n")), lambda j: (j == i + 1) | (total(j) <= F.col("cap")))
        rest = lambda j: F.get(best, j - i - 1)
        return F.concat(F.array(F.array_min(F.transform(cuts, lambda j: plan(rest(j)["n"] + 1, F.greatest(total(j), rest(j)["big"]), j)))), best)

    backward = F.when(F.col("n") > 0, F.sequence(F.col("n") - 1, F.lit(0), F.lit(-1))).otherwise(F.array().cast("array<int>"))
    planned = made.select("rows", F.aggregate(backward, F.array(plan(F.lit(0), F.lit(0.0), F.col("n"))), longer).alias("best"))

    def walk(cuts: Column, _: Column) -> Column:
        at = F.element_at(cuts, -1)
        return F.when(at < F.size("rows"), F.concat(cuts, F.array(F.get("best", at)["cut"]))).otherwise(cuts)

    cut = planned.select("rows", F.aggregate("rows", F.array(F.lit(0)), walk).alias("cuts"))
    each = cut.select(F.posexplode("rows").alias("k", "row"), "cuts")
    return each.select("row.name", "row.pos", (F.size(F.filter("cuts", lambda c: c <= F.col("k"))) - 1).alias("part"))


def installed(packs: DataFrame) -> DataFrame:
    """ranged, has_words: how many installed packs (ranges, words) carry a range, and whether one carries words."""
    return packs.agg(F.count_if(F.size("ranges") > 0).alias("ranged"), F.coalesce(F.bool_or("words"), F.lit(False)).alias("has_words"))
