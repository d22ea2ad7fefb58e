r"""Line-first quality rules, in DataFrame functions only.

Every line that holds a word is judged by itself: lines of navigation (separators between few words),
boilerplate (stock phrases), symbols, shouting, and lines that stop without closing punctuation are
removed. A document that loses more than `max_lost` of the characters in such lines goes. Before that stand
rules on the whole text: too few words, or too many words in repeated three-word windows.

Repeated windows are found within the row: window hashes are sorted, neighbours that agree are the
repeated ones, and every window is looked up among these by binary search. That is n log n for a
text of n words, needs no shuffle, and holds one text at a time. (Two different windows of one text
share a 64-bit hash with a chance of about 1e-11 at 20,000 words.)

Edge cases: a null text has no words; a text of any length is judged whole, in one row; repeated
windows and lines count from the second on, and among ties no order is used; an empty table gives no
rows; repeated rows are judged alike;
a line break inside a window counts as white space; columns other than the two named are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._store import SPACE, picked

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LOST = 0.5
#: A line is boilerplate if one character in so many stands in a stock phrase; prose may mention one.
BOILERPLATE_SHARE = 8
SPACES = r"[\x20\x09-\x0D]"
#: Marks that may end a line of prose.
CLOSING = tuple(".!?…:;,\"'”’»)]")
SYMBOLS = r"[#*$%&|<>]"
#: Phrases of lines that belong to a page rather than to its text.
BOILERPLATE = (
    "all rights reserved", "cookie policy", "privacy policy", "terms of service", "terms of use", "enable javascript",
    "click here", "read more", "sign in", "sign up", "log in", "subscribe to", "share this", "skip to content", "licensed under",
)


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACES + "+"), lambda w: w != "")


def line_fails(line: Column) -> Column:
    """Whether a line that holds a word is to be removed."""
    navigation = F.regexp_count(line, F.lit(r"[|»›•>]")) >= 2
    symbols = F.regexp_count(line, F.lit(SYMBOLS)) * 12 > F.length(line)
    shouting = (F.length(line) > 20) & line.rlike(r"\p{Lu}") & ~line.rlike(r"\p{Ll}")
    # Trimming takes a pass over the whole line, so only lines that end with a blank are trimmed.
    last = F.substring(line, -1, 1)
    unclosed = ~F.when(last.isin(*SPACE), F.substring(F.rtrim(line, F.lit(SPACE)), -1, 1)).otherwise(last).isin(*CLOSING)
    low = F.lower(line)
    mentions = F.exists(F.array(*[F.lit(p) for p in BOILERPLATE]), lambda p: F.contains(low, p))
    boilerplate = mentions & ((F.length(low) - F.length(F.regexp_replace(low, "|".join(BOILERPLATE), ""))) * BOILERPLATE_SHARE >= F.length(low))
    return unclosed | shouting | navigation | symbols | boilerplate


def repeat_words(frame: DataFrame) -> DataFrame:
    """`frame` with n_repeat_words from its column `words`: words in windows of three that occur again."""
    last = F.size("words") - 3
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    hashed = frame.withColumn("_h", F.transform(starts, lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2))))
    by_value = hashed.withColumn("_s", F.sort_array("_h"))
    again = by_value.withColumn("_d", F.array_distinct(F.filter("_s", lambda x, i: (i > 0) & (x == F.get("_s", i - 1))))).drop("_s")
    bits = F.when(F.size("_d") > 0, F.reverse(F.transform(F.sequence(F.lit(0), F.floor(F.log2(F.size("_d"))).cast("int")), lambda k: F.pow(F.lit(2), k).cast("int"))))
    sized = again.withColumn("_p", F.coalesce(bits, F.array().cast("array<int>"))).withColumn("_n", F.size("_d"))

    def known(x: Column) -> Column:
        at = F.aggregate("_p", F.lit(0), lambda lo, p: F.when((lo + p < F.col("_n")) & (F.get("_d", lo + p) <= x), lo + p).otherwise(lo))
        return F.get("_d", at) == x

    flags = F.transform("_h", lambda x, i: F.when(known(x), i).otherwise(-1))
    hits = sized.withColumn("_at", F.when(F.col("_n") > 0, F.filter(flags, lambda i: i >= 0)).otherwise(F.array().cast("array<int>")))
    steps = F.transform("_at", lambda x, i: F.when(i == 0, 3).otherwise(F.least(F.lit(3), x - F.get("_at", i - 1))))
    return hits.withColumn("n_repeat_words", F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)).drop("_h", "_d", "_p", "_n", "_at")


def judge(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT, max_lost: float = MAX_LOST) -> DataFrame:
    """doc_id, the measures, base_failed, kept, and the text that the line rules leave (clean_text)."""
    rows = picked(docs, doc_id=id_col, text=text_col)
    base = rows.withColumn("text", F.coalesce("text", F.lit("")))
    split = base.withColumn("words", words_of(F.col("text"))).withColumn("lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    counted = repeat_words(split).withColumn("glued", F.array_join("words", ""))
    measured = counted.select(
        "doc_id",
        "lines",
        F.size("words").cast("long").alias("n_words"),
        F.length("glued").cast("long").alias("word_chars"),
        F.regexp_count("glued", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
    )
    total = lambda lines: F.aggregate(lines, F.lit(0).cast("long"), lambda a, x: a + F.length(x))
    lined = measured.withColumn("good", F.filter("lines", lambda x: ~line_fails(x)))
    clean = lined.withColumn("clean_text", F.array_join("good", "\n")).withColumn("line_chars", total("lines")).withColumn("good_chars", total("good"))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    verdict = F.col("line_chars") - F.col("good_chars") <= max_lost * F.col("line_chars")
    return clean.withColumn("base_failed", failed).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & verdict).alias("kept"), "line_chars", "good_chars", "clean_text"
    )
