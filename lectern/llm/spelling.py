"""Spelling variants: words one edit apart, found by the rare-first prefix filter over bigrams.

Words (runs of letters, A-Z lower-cased) are counted over all texts; only counted words go on. The
bigrams of all words are ordered by how often words have them, rarest first. One edit destroys at most
two bigrams of either word, and what it leaves keeps its order, so two words one edit apart share one
of their three first bigrams in that order (ties within a word go by position), moved by at most one
position. Around the shared bigram the edit lies either behind it, and the words begin alike up to it,
or before it, and they end alike from it on. So a word is indexed under its length and, for each of
its three rarest bigrams, the beginning up to it and the ending from it; words of the same and of the
next length are looked up there. That holds the position limits, and a bucket is far smaller than a
bigram's. What is found is verified by edit distance.

A bucket of more than `DENSE` words isn't paired: its words are indexed once more, under every
single deletion of the part that may differ and that part itself, which words one edit apart share.

Each word points to its most frequent neighbour, if that is frequent enough; roots are found by
doubling the pointers, and frequencies at least double along them, so that rounds are few.

Edge cases: a null or empty text has no words; a null id is "" in the key that decides deletions; of
repeated rows every one counts; a text or a word of any length is read whole; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._store import picked, staged

#: Letters of a word: basic letters and the upper half of Latin-1. 26 + 64 after lower-casing, so at most 8,100 bigrams.
RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_CHARS, MIN_COUNT = 5, 3
#: Bigrams of a word that are indexed: 2 x edits + 1.
PREFIX = 3
#: Every how many-th occurrence, by hash, loses a letter.
DAMAGED = 97
#: Words of a bucket that are compared pair by pair at most.
DENSE = 256


def words(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", damaged: int = DAMAGED) -> DataFrame:
    """word, n of all texts. One occurrence in `damaged`, by crc32 of id and word, has lost a letter (0: none)."""
    rows = picked(docs, own_id=id_col, text=text_col)
    runs = rows.select("own_id", F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run"))
    low = runs.select("own_id", F.translate("run", UPPER, LOWER).alias("run"))
    if damaged:
        h = F.crc32(F.concat(F.coalesce(F.col("own_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
        at = F.pmod(F.col("h"), F.length("run")).cast("int")
        less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
        low = low.withColumn("h", h).select(F.when(F.col("h") % damaged == 0, less).otherwise(F.col("run")).alias("run"))
    # Each task counts its own words first: a frequent one is a row per task.
    return low.groupBy(F.col("run").alias("word")).agg(F.count(F.lit(1)).alias("n"))


def rare_first(vocabulary: DataFrame) -> DataFrame:
    """word, n, len, at: the positions (from 0) of each word's PREFIX rarest bigrams; words of two letters or more."""
    places = vocabulary.select("word", "n", F.explode(F.sequence(F.lit(0), F.length("word") - 2)).alias("pos"))
    placed = places.withColumn("gram", F.substring("word", F.col("pos") + 1, F.lit(2)))
    held = placed.groupBy("gram").agg(F.count(F.lit(1)).alias("held"))  # at most 8,100 rows
    rarest = F.slice(F.array_sort(F.collect_list(F.struct("held", "gram", "pos"))), 1, PREFIX)
    ranked = placed.join(F.broadcast(held), "gram").groupBy("word", "n").agg(rarest.alias("rarest"))
    return ranked.select("word", "n", F.length("word").alias("len"), F.transform("rarest", lambda g: g["pos"]).alias("at"))


def _entries(ranked: DataFrame) -> DataFrame:
    """word, n, len, side, fixed, rest: for each bigram and side of it, what stands still beside the edit, and what may differ."""
    each = ranked.select("word", "n", "len", F.explode("at").alias("pos"))
    word, pos = F.col("word"), F.col("pos")
    begins = F.struct(F.lit("b").alias("side"), F.substring(word, F.lit(1), pos + 2).alias("fixed"), F.substring(word, pos + 3, F.col("len")).alias("rest"))
    ends = F.struct(F.lit("e").alias("side"), F.substring(word, pos + 1, F.col("len")).alias("fixed"), F.substring(word, F.lit(1), pos).alias("rest"))
    return each.select("word", "n", "len", F.explode(F.array(begins, ends)).alias("e")).select("word", "n", "len", "e.*")


def near_pairs(vocabulary: DataFrame, *, dense: int = DENSE) -> DataFrame:
    """word, n, other, m: all pairs of words one edit apart, each in both directions."""
    entries = staged(_entries(rare_first(vocabulary)), "word_entries")
    # 64-bit keys; a clash only costs a comparison.
    key = lambda length: F.xxhash64("side", "fixed", length)
    index = entries.select(key(F.col("len")).alias("key"), F.col("word").alias("other"), F.col("n").alias("m"), "rest")
    asked = entries.select(F.explode(F.array(key(F.col("len")), key(F.col("len") + 1))).alias("key"), "word", "n", "rest")
    crowded = staged(index.groupBy("key").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > dense).select("key"), "crowded_keys")

    def spread(side: DataFrame, *columns: str) -> DataFrame:
        """In crowded buckets words meet only where their differing parts share a deletion."""
        left = side.join(crowded, "key", "left_semi").select("key", F.explode(_deletions(F.col("rest"))).alias("left"), *columns)
        return left.select(F.xxhash64("key", "left").alias("key"), *columns).distinct()

    pair = ("word", "n", "other", "m")
    sparse = asked.join(crowded, "key", "left_anti").join(index.join(crowded, "key", "left_anti").drop("rest"), "key").select(*pair)
    close = spread(asked, "word", "n").join(spread(index, "other", "m"), "key").select(*pair)
    found = sparse.union(close).where((F.col("word") != F.col("other")) & (F.levenshtein("word", "other", 1) == 1))
    # A pair is found from one side or both, and by several bigrams.
    one, two = F.struct(F.col("word").alias("w"), F.col("n").alias("c")), F.struct(F.col("other").alias("w"), F.col("m").alias("c"))
    once = found.select(F.least(one, two).alias("a"), F.greatest(one, two).alias("b")).distinct()
    way = lambda x, y: F.struct(F.col(f"{x}.w").alias("word"), F.col(f"{x}.c").alias("n"), F.col(f"{y}.w").alias("other"), F.col(f"{y}.c").alias("m"))
    return once.select(F.inline(F.array(way("a", "b"), way("b", "a"))))


def _deletions(rest: Column) -> Column:
    """The string itself and all that it becomes when one letter goes."""
    whole = F.coalesce(rest, F.lit(""))
    shorter = F.transform(F.sequence(F.lit(1), F.length(whole)), lambda i: F.concat(F.substring(whole, F.lit(1), i - 1), F.substring(whole, i + 1, F.length(whole))))
    return F.when(F.length(whole) == 0, F.array(whole)).otherwise(F.concat(F.array(whole), shorter))


def roots(forms: DataFrame) -> DataFrame:
    """word, root: where the forms (word, form) of all words that have one lead in the end.

    Each round doubles how far a word points. Frequencies double at every step, so that there are at
    most 63 steps and 6 rounds.
    """
    ways = forms.select("word", F.col("form").alias("at"))
    while True:
        further = ways.select(F.col("word").alias("at"), F.col("at").alias("beyond"))
        met = staged(ways.join(further, "at", "left"), "ways")
        if met.where("beyond is not null").isEmpty():
            return met.select("word", F.col("at").alias("root"))
        # A word whose way has ended still shows others theirs.
        ways = met.select("word", F.coalesce("beyond", "at").alias("at"))


def variants(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, ratio: int = 2, damaged: int = DAMAGED, dense: int = DENSE) -> DataFrame:
    """word, form, root, n, n_near, form_n of all words of `min_chars` letters and `min_count` occurrences."""
    counted = words(docs, id_col=id_col, text_col=text_col, damaged=damaged)
    vocabulary = staged(counted.where((F.length("word") >= min_chars) & (F.col("n") >= min_count)), "vocabulary")
    near = staged(near_pairs(vocabulary, dense=dense), "near_words")
    best = near.groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("less"), F.col("other").alias("form"))).alias("best"))
    enough = -F.col("best.less") >= ratio * F.col("n")
    judged = staged(best.select("word", "n_near", F.when(enough, F.col("best.form")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n")), "forms")
    led = roots(judged.where("form is not null").select("word", "form"))
    out = vocabulary.join(judged, "word", "left").join(led, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
