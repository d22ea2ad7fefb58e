"""From a quest to the voice that speaks it, over givers, displays and their extras; and zones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_resolving_giver(givers: DataFrame, models: DataFrame, display: DataFrame, extra: DataFrame, races: DataFrame) -> DataFrame:
    """quest_id, npc, race, sex: of a quest's givers in order the first whose model resolves.

    Of a creature's models the first that shows something counts. A race without a name is its number
    as text; a sex other than 1 is male.
    """
    shown = models.where("display <> 0").groupBy("creature").agg(F.min_by("display", "idx").alias("display"))
    resolved = shown.join(display, "display").join(extra, "extra").join(races, "race", "left")
    named = resolved.select(F.col("creature").alias("npc"), F.coalesce("name", F.col("race").cast("string")).alias("race"), F.when(F.col("sex") == 1, "female").otherwise("male").alias("sex"))
    met = givers.join(named, "npc")
    return met.groupBy("quest_id").agg(F.min_by(F.struct("npc", "race", "sex"), F.struct("pos", "npc")).alias("v")).select("quest_id", "v.npc", "v.race", "v.sex")


def ordered_distinct(rows: DataFrame, key: str, value: str, order: tuple[str, ...]) -> DataFrame:
    """key, list: distinct values of each key, in the order in which they first appear."""
    first = rows.groupBy(key, value).agg(F.min(F.struct(*order)).alias("_at"))
    return first.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_at", value))), lambda x: x[value]).alias("list"))


def on_map(quest_npcs: DataFrame, npc_places: DataFrame, map_id: int) -> DataFrame:
    """quest_id of quests any of whose givers or takers (quest_id, npc) stands on the map."""
    there = npc_places.where(F.col("map") == map_id).select("npc").distinct()
    return quest_npcs.join(there, "npc", "left_semi").select("quest_id").distinct()


def recall(found: DataFrame, known: DataFrame) -> DataFrame:
    """found, known, both, recall."""
    both = found.select("quest_id", F.lit(1).alias("f")).distinct().join(known.select("quest_id", F.lit(1).alias("k")).distinct(), "quest_id", "full_outer")
    n = both.agg(F.count("f").alias("found"), F.count("k").alias("known"), F.count_if(F.expr("f = 1 and k = 1")).alias("both"))
    return n.withColumn("recall", F.when(F.col("known") > 0, F.col("both") / F.col("known")))


def givers_summary(givers: DataFrame) -> DataFrame:
    """one, several: quests with one giver and with more."""
    per = givers.groupBy("quest_id").agg(F.count_distinct("npc").alias("n"))
    return per.agg(F.count_if(F.col("n") == 1).alias("one"), F.count_if(F.col("n") > 1).alias("several"))


def speaker_tally(voices: DataFrame, k: int = 12) -> DataFrame:
    return voices.groupBy("race", "sex").agg(F.count(F.lit(1)).alias("quests")).orderBy(F.desc("quests"), "race", "sex").limit(k)
