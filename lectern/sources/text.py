"""Text sources and sinks: JSON lines, dictionaries, dumps, lists, manifests.

Paths go to Spark's readers as they are, so any file system works. Whole-file parsers read one row
per file: such files (saved variables, small tables) are far below a task's memory.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.functions.text import strip, unescape

Schema = str | T.StructType


def jsonl(spark: SparkSession, path: str, schema: Schema, *, tolerant: bool = False, missing_ok: bool = False) -> DataFrame:
    """Rows of a JSON-lines file; blank lines are skipped. Malformed lines raise, or are dropped if tolerant."""
    reader = spark.read.schema(schema).option("mode", "DROPMALFORMED" if tolerant else "FAILFAST")
    try:
        return reader.json(path)
    except AnalysisException as e:
        if missing_ok and e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def word_rows(plan: DataFrame) -> DataFrame:
    """Rows of kind word; a filter that reaches the scan, or prunes partitions where the plan is partitioned by kind."""
    return plan.where("kind = 'word'")


#: The columns that order lines as their files do: file, begin of the part of it that a task reads, number in that task.
LINE_PLACE = ("file", "block", "nth")


def lines(spark: SparkSession, path: str) -> DataFrame:
    """value, file, block, nth: lines of text files with their place.

    Spark deals parts of files to tasks by size, not by name, so that numbers given while reading don't
    follow the files. A line belongs to the part in which it begins, and parts are read from their begin.
    """
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("nth"))


def _pos(rows: DataFrame) -> Column:
    """The place of a line of `lines`, comparable; of other rows a number in the order in which they are read."""
    return F.struct(*LINE_PLACE).alias("pos") if set(LINE_PLACE) <= set(rows.columns) else F.monotonically_increasing_id().alias("pos")


def dictionary(rows: DataFrame) -> DataFrame:
    """pos, key, word of lines like `["key"] = { word = "Word"`; other lines are skipped."""
    pattern = r'^\s*\["((?:[^"\\]|\\.)*)"\]\s*=\s*\{.*?\bword\s*=\s*"((?:[^"\\]|\\.)*)"'
    parsed = rows.where(F.col("value").rlike(pattern)).select(_pos(rows), F.regexp_extract("value", pattern, 1).alias("k"), F.regexp_extract("value", pattern, 2).alias("w"))
    return parsed.select("pos", unescape(F.col("k")).alias("key"), unescape(F.col("w")).alias("word"))


def brace_blocks(texts: DataFrame) -> DataFrame:
    """kind, id, text, flavor of the brace blocks in whole texts (value), strings unescaped, numbers as they are."""
    block = F.explode(F.regexp_extract_all("value", F.lit(r'(?s)\{((?:[^{}"]|"(?:[^"\\]|\\.)*")*)\}'), F.lit(1))).alias("b")
    found = texts.select(block)
    string = lambda name: F.nullif(F.regexp_extract("b", rf'\["{name}"\]\s*=\s*"((?:[^"\\]|\\.)*)"', 1), F.lit(""))
    number = F.nullif(F.regexp_extract("b", r'\["id"\]\s*=\s*(-?\d+)', 1), F.lit("")).cast("bigint")
    kept = found.select(string("kind").alias("kind"), number.alias("id"), string("text").alias("text"), string("flavor").alias("flavor")).where("kind is not null and id is not null")
    return kept.select("kind", "id", unescape(F.col("text")).alias("text"), "flavor")


def segments(texts: DataFrame, marker: str = r"\bq\((\d+),") -> DataFrame:
    """pos, quest_id, npcs of whole texts (value): a record runs from one marker to the next; its first list counts."""
    parts = texts.select(F.posexplode(F.split("value", f"(?={marker})")).alias("pos", "s")).where(F.col("s").rlike("^" + marker))
    inner = F.regexp_extract("s", r"\{\s*(\d+(?:\s*,\s*\d+)*)\s*,?\s*\}", 1)
    npcs = F.transform(F.filter(F.split(inner, r"\s*,\s*"), lambda x: x != ""), lambda x: x.cast("bigint"))
    return parts.select("pos", F.regexp_extract("s", marker, 1).cast("bigint").alias("quest_id"), npcs.alias("npcs"))


def all_numbers(rows: DataFrame, pattern: str, *names: str) -> DataFrame:
    """A row of whole numbers for each match of the pattern's groups in lines (value)."""
    groups = [F.transform(F.regexp_extract_all("value", F.lit(pattern), F.lit(k + 1)), lambda x: x.cast("bigint")).alias(n) for k, n in enumerate(names)]
    return rows.select(F.inline(F.arrays_zip(*groups)))


def inserted_triples(rows: DataFrame, table: str, names: tuple[str, str, str]) -> DataFrame:
    """Triples of whole numbers in a dump's INSERT lines for the table."""
    own = rows.where(F.startswith("value", F.lit(f"INSERT INTO `{table}`")))
    return all_numbers(own, r"\((\d+),\s*(\d+),\s*(\d+)", *names)


#: Rows of the quest and creature tables, the people of a quest, and a map with a place on it.
QUEST_ROW, CREATURE_ROW = r"^G\[(\d+)\]\s*=\s*'([^']*)'", r"^G\[(\d+)\]\s*=\s*\{'([^']*)'"
PEOPLE, PLACE = r"\b[AT]:([\d,]+)", r"(\d+):\d+\.?\d*,\d+\.?\d*"


def places(rows: DataFrame) -> DataFrame:
    """npc, map: the maps that lines (value) of the creature table name."""
    found = rows.where(F.col("value").rlike(CREATURE_ROW)).select(F.regexp_extract("value", CREATURE_ROW, 1).cast("bigint").alias("npc"), F.regexp_extract("value", CREATURE_ROW, 2).alias("b"))
    return found.select("npc", F.explode(F.regexp_extract_all("b", F.lit(PLACE), F.lit(1))).alias("m")).select("npc", F.col("m").cast("bigint").alias("map")).distinct()


def people(rows: DataFrame) -> DataFrame:
    """quest_id, npc: who gives or takes the quests of lines (value) of the quest table."""
    found = rows.where(F.col("value").rlike(QUEST_ROW)).select(F.regexp_extract("value", QUEST_ROW, 1).cast("bigint").alias("quest_id"), F.regexp_extract("value", QUEST_ROW, 2).alias("b"))
    runs = F.array_join(F.regexp_extract_all("b", F.lit(PEOPLE), F.lit(1)), ",")
    return found.select("quest_id", F.explode(F.split(runs, ",")).alias("n")).where("n <> ''").select("quest_id", F.col("n").cast("bigint").alias("npc")).distinct()


def id_list(texts: DataFrame) -> DataFrame:
    """pos, quest_id of a JSON array of ids in whole texts (value)."""
    return texts.select(F.posexplode(F.from_json("value", "array<bigint>")).alias("pos", "quest_id"))


def any_ids(texts: DataFrame) -> DataFrame:
    return texts.select(F.posexplode(F.regexp_extract_all("value", F.lit(r"\d+"), F.lit(0))).alias("pos", "id")).select("pos", F.col("id").cast("bigint").alias("quest_id"))


def median_table(texts: DataFrame) -> DataFrame:
    """len, median of a JSON object of lengths to seconds."""
    return texts.select(F.explode(F.from_json("value", "map<string,double>")).alias("k", "median")).select(F.col("k").cast("int").alias("len"), "median")


def stamps(spark: SparkSession, path: str) -> DataFrame:
    """path, stamp of side-car files *.hash below a folder; the path is that of the clip."""
    read = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.hash").text(path, wholetext=True)
    return read.select(F.regexp_replace(F.col("_metadata.file_path"), r"\.hash$", "").alias("path"), strip(F.col("value")).alias("stamp"))


def path_list(rows: DataFrame) -> DataFrame:
    """pos, path of a list of paths, blank lines skipped."""
    return rows.select(_pos(rows), strip(F.col("value")).alias("path")).where("path <> ''")


def manifest(rows: DataFrame) -> DataFrame:
    """path of the files that a manifest loads: lines that are neither blank nor directives."""
    return rows.select(F.replace(strip(F.col("value")), F.lit("\\"), F.lit("/")).alias("path")).where("path <> '' and not startswith(path, '#')")


def ignore_list(rows: DataFrame) -> DataFrame:
    """prefix of the `ignore:` entries of a package file."""
    return rows.select(F.regexp_extract("value", r"^\s+-\s+(\S.*?)\s*$", 1).alias("prefix")).where("prefix <> ''")


def blob(texts: DataFrame, which: str) -> DataFrame:
    """value: lines of a long-bracket string field of pack files (whole texts, value)."""
    inner = F.regexp_extract("value", rf"(?s)\b{which}\s*=\s*\[\[(.*?)\]\]", 1)
    return texts.select(F.explode(F.split(inner, "\n")).alias("value")).where("value <> ''")


def headwords(rows: DataFrame, *, every: bool = False) -> DataFrame:
    """key: of (word, headword, key, lemma) the first that is there; or all of word and key."""
    there = lambda c: F.nullif(F.col(c), F.lit(""))
    if every:
        return rows.select(F.explode(F.array(there("word"), there("key"))).alias("key")).where("key is not null").distinct()
    return rows.select(F.coalesce(*[there(c) for c in ("word", "headword", "key", "lemma")]).alias("key")).where("key is not null").distinct()


# Sinks


def write_jsonl(rows: DataFrame, path: str, *, append: bool = False) -> None:
    """JSON lines; the committer publishes whole task outputs only."""
    rows.write.mode("append" if append else "overwrite").json(path)


def as_document(rows: DataFrame, key: str, value: str) -> DataFrame:
    """value: one JSON object of a small table's keys and values, sorted by key."""
    entries = F.array_sort(F.collect_list(F.struct(F.col(key).cast("string").alias("key"), F.col(value).alias("value"))))
    return rows.agg(F.to_json(F.map_from_entries(entries)).alias("value"))


def write_table(table: DataFrame, path: str) -> None:
    """The passage table's lines in (quest_id, letter) order; range-partitioned, so no task sorts all."""
    table.orderBy("quest_id", "letter").select("value").write.mode("overwrite").text(path)
