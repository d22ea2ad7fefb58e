"""Small pure functions: schedules, labels, versions, clamps."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHARS_PER_SECOND = 15
OVERHEAD = 1.009
NUMBER_WORDS = ("one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve")


def backoff_pause(waited: Column) -> Column:
    """Seconds to wait before the next try, after so many seconds of waiting: 5 doubled every 30, 60 at most."""
    return F.least(F.lit(60).cast("long"), (5 * F.pow(F.lit(2), F.least(F.floor(waited / 30), F.lit(4)))).cast("long"))


def gives_up(waited: Column, patience: int = 1200) -> Column:
    return waited >= patience


def spoken_hours(chars: Column) -> Column:
    return chars / CHARS_PER_SECOND / 3600


def version_newer(a: Column, b: Column) -> Column:
    """Whether dotted version a is newer than b, number by number, missing numbers as 0."""
    parts = lambda v: F.transform(F.regexp_extract_all(F.coalesce(v, F.lit("")), F.lit(r"\d+"), F.lit(0)), lambda x: x.cast("long"))
    n = F.greatest(F.size(parts(a)), F.size(parts(b)))
    padded = lambda v: F.concat(parts(v), F.array_repeat(F.lit(0).cast("long"), n - F.size(parts(v))))
    return padded(a) > padded(b)


def clock(seconds: Column) -> Column:
    """Time left as -m:ss, rounded up but for a millionth."""
    whole = F.ceil(seconds - 1e-6)
    return F.format_string("-%d:%02d", F.floor(whole / 60), whole % 60)


def position_label(i: Column, n: Column) -> Column:
    return F.when(n <= 1, "").otherwise(F.concat_ws(" of ", F.least(F.greatest(i, F.lit(1)), n).cast("string"), n.cast("string")))


def progress(at: Column, total: Column) -> Column:
    return F.when(total > 0, F.least(F.greatest(at, F.lit(0.0)), total) / total).otherwise(0.0)


def range_label(low: Column, high: Column, open_from: int = 10**9) -> Column:
    return F.when(high >= open_from, F.concat(F.format_number(low, 0), F.lit(" and up"))).otherwise(F.concat(F.format_number(low, 0), F.lit("–"), F.format_number(high, 0)))


def joined_with_and(labels: Column) -> Column:
    n = F.size(labels)
    return F.when(n <= 1, F.array_join(labels, "")).otherwise(F.concat(F.array_join(F.slice(labels, F.lit(1), F.greatest(n - 1, F.lit(0))), ", "), F.lit(" and "), F.get(labels, n - 1)))


def number_word(n: Column) -> Column:
    return F.coalesce(F.get(F.array(*[F.lit(w) for w in NUMBER_WORDS]), n.cast("int") - 1), n.cast("string"))


def folder_suffix(folder: Column) -> Column:
    return F.regexp_extract(folder, r"([^-]*)$", 1)


def capped(cap: Column | float) -> Column:
    """A size limit less the archive's own overhead."""
    return (F.lit(cap) if not isinstance(cap, Column) else cap) / OVERHEAD


def clamped(value: Column, low: float, high: float, default: float) -> Column:
    """A setting as a number within bounds; anything that is no number is the default."""
    return F.least(F.greatest(F.coalesce(value.try_cast("double"), F.lit(default)), F.lit(low)), F.lit(high))


def speaker_label(client: Column, quest: Column) -> Column:
    return F.coalesce(F.nullif(client, F.lit("")), quest, F.lit(""))


@F.pandas_udf(T.StringType())
def escape_literal(texts: pd.Series) -> pd.Series:
    """Bytes outside printable ASCII, quotes and backslashes as backslash and three decimal digits."""
    own = {b: chr(b) if 32 <= b <= 126 and b not in b'"\\' else f"\\{b:03d}" for b in range(256)}
    return texts.map(lambda t: None if t is None else "".join(own[b] for b in t.encode()))
