"""How well a transcript matches the word it was meant to say: letters, edges, sound, verdicts.

Similarity by matching blocks depends on the order of its arguments: always (wanted, heard). It is
the one measure here that SQL can't express, so it runs as a pandas UDF on pairs that the native
rules leave open; deduplicate pairs first. Spark can't feed a Python UDF from a higher-order function
in the same projection: the UDF-backed functions take columns that an earlier stage has made.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import fold_edges, let, normalise, pieces

ACCEPT, RESCUE, INITIAL = 0.8, 0.5, 0.45
SOUND_BAR = 0.85
TRAILING_MIN = 4
#: Hesitations.
FILLER = r"(?iU)\b(?:ähm+|äh+|ehm+|öhm+|hm+|mhm+|uh+|em)\b"


@F.pandas_udf(T.DoubleType())
def block_ratio(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for a, b in batches:
        yield pd.Series([SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)], dtype=float)


def similarity(want: Column, heard: Column) -> Column:
    """Share of matching blocks of the normalised strings, 0 to 1."""
    return block_ratio(normalise(want), normalise(heard))


def letter_counts(value: Column) -> Column:
    """Map from each letter of a string to how often it stands there."""
    letters = F.filter(F.split(value, ""), lambda c: c != "")
    return F.map_from_entries(F.transform(F.array_distinct(letters), lambda c: F.struct(c, F.size(F.filter(letters, lambda d: d == c)))))


def shared_letters(a: Column, b: Column) -> Column:
    """How many letters two maps of counts share, each as often as both have it."""
    return F.aggregate(F.map_entries(a), F.lit(0), lambda total, e: total + F.coalesce(F.least(e["value"], F.element_at(b, e["key"])), F.lit(0)) * F.when(F.map_contains_key(b, e["key"]), 1).otherwise(0))


def ratio_bound(shared: Column, length: Column) -> Column:
    """What the similarity by matching blocks can be at most: all shared letters in blocks; of two empty strings, 1.

    `length` is that of both strings together.
    """
    return F.when(length == 0, 1.0).otherwise(2.0 * shared / F.greatest(length, F.lit(1)))


def rambles(want: Column, heard: Column) -> Column:
    a, b = F.length(normalise(want)), F.length(normalise(heard))
    return (a > 0) & (b > F.greatest(a * 3, a + 12))


def classify(want: Column, heard: Column, score: Column | None = None, best_piece: Column | None = None) -> Column:
    """Shape of the disagreement: silent, ok, rambled, ok-ish, clipped, many, different.

    `many` needs the similarity of the whole and the best of the heard pieces; without them such
    pairs are `different`.
    """
    a, b = normalise(want), normalise(heard)
    verdict = (
        F.when(b == "", "silent").when(a == b, "ok").when((a != "") & F.contains(b, a), F.when(F.length(b) >= F.length(a) * 2, "rambled").otherwise("ok-ish")).when(F.contains(a, b), "clipped")
    )
    if score is not None and best_piece is not None:
        verdict = verdict.when((F.size(pieces(want)) == 1) & (F.size(pieces(heard)) >= 2) & (score < 0.7) & (best_piece < 0.8), "many")
    return verdict.otherwise("different")


@F.pandas_udf(T.DoubleType())
def best_ratio(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for want, parts in batches:
        yield pd.Series([max((SequenceMatcher(None, w, p).ratio() for p in ps), default=0.0) for w, ps in zip(want, parts)], dtype=float)


def best_piece_similarity(want: Column, heard: Column) -> Column:
    return best_ratio(normalise(want), F.transform(pieces(heard), normalise))


def acceptable(want: Column, heard: Column, score: Column, *, rescue: bool = False) -> Column:
    """Base rule: equal; or the word with at most as much again around it; or similar enough."""
    a, b = normalise(want), normalise(heard)
    close = (~rambles(want, heard) & (score >= RESCUE)) if rescue else score >= ACCEPT
    return F.when(b == "", False).when(a == b, True).when((a != "") & F.contains(b, a), F.length(b) <= F.length(a) * 2).otherwise(close)


def is_filler_word(word: Column) -> Column:
    """Whether a word is a hesitation itself, however many letters it is spelled with."""
    return F.regexp_replace(F.coalesce(word, F.lit("")), r"(.)\1+", "$1").rlike(FILLER)


def has_filler(want: Column, heard: Column) -> Column:
    return F.coalesce(heard, F.lit("")).rlike(FILLER) & ~is_filler_word(want)


def acceptable_settled(want: Column, heard: Column, score: Column) -> Column:
    return acceptable(want, heard, score) & ~has_filler(want, heard)


def still_clipped(want: Column, heard: Column) -> Column:
    a, b = fold_edges(want), fold_edges(heard)
    return (b != "") & (a != b) & F.contains(a, b)


def still_false_start(want: Column, heard: Column) -> Column:
    a, b = fold_edges(want), fold_edges(heard)
    return (a != "") & (a != b) & F.endswith(b, a)


def still_trailing(want: Column, heard: Column) -> Column:
    a, b = fold_edges(want), fold_edges(heard)
    return (a != "") & F.startswith(b, a) & (F.length(b) - F.length(a) >= TRAILING_MIN)


def edge_fault(want: Column, heard: Column) -> Column:
    """The first fault in the order clipped, false start, filler, trailing; null without one."""
    return F.when(still_clipped(want, heard), "clipped").when(still_false_start(want, heard), "false start").when(has_filler(want, heard), "filler").when(still_trailing(want, heard), "trailing")


def acceptable_edges(want: Column, heard: Column, score: Column) -> Column:
    return F.isnull(edge_fault(want, heard)) & acceptable(want, heard, score)


def acceptable_sound(want: Column, heard: Column, score: Column, sound: Column) -> Column:
    """Clipping counts only if it can be heard; then letters or sound suffice."""
    clipped = still_clipped(want, heard) & (sound < 1.0)
    faulty = clipped | still_false_start(want, heard) | still_trailing(want, heard) | has_filler(want, heard)
    return ~faulty & ~rambles(want, heard) & ((score >= ACCEPT) | (sound >= SOUND_BAR))


def acceptable_initial(want: Column, heard: Column, score: Column) -> Column:
    """For words whose first sound is the question: it must be j, y or i."""
    first = F.regexp_replace(F.coalesce(heard, F.lit("")), r"(?U)^[^\w]+", "").rlike("(?i)^[jyi]")
    return first & ~rambles(want, heard) & (score >= INITIAL)


def spoken_case(word: Column) -> Column:
    """A shouted word as a word; short ones, ones without a vowel, and spelled-out ones stay."""
    shouted = (F.length(word) >= 4) & (F.upper(word) == word) & (F.lower(word) != word) & word.rlike("[AEIOUÄÖÜY]") & ~word.rlike(r"(?U)^(\w-)+\w$")
    return F.when(shouted, F.concat(F.substring(word, 1, 1), F.lower(F.substring(word, 2, 1 << 30)))).otherwise(word)


def survival(want: Column, heard: Column) -> Column:
    """Share of the wanted letters that are heard, for worst-first order."""
    return F.length(fold_edges(heard)) / F.greatest(F.length(fold_edges(want)), F.lit(1))


@F.pandas_udf(T.StringType())
def _unaccented(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield batch.map(lambda t: "".join(c for c in unicodedata.normalize("NFD", t) if not unicodedata.combining(c)))


def sound_letters(text: Column, *, ascii_only: bool = False) -> Column:
    """A-Z of a text: upper-cased, sharp s as SS, accents dropped, everything else gone.

    ascii_only: for text known to have no letters but German ones, all native.
    """
    up = F.upper(F.replace(F.coalesce(text, F.lit("")), F.lit("ẞ"), F.lit("ss")))
    if ascii_only:
        plain = F.translate(up, "ÄÖÜ", "AOU")
    else:
        plain = F.when(up.rlike(r"[^\x00-\x7f]"), _unaccented(up)).otherwise(up)
    return F.regexp_replace(plain, "[^A-Z]", "")


#: The Cologne phonetics table, letters that have one code everywhere.
SINGLE_CODES = {"0": "AEIJOUY", "1": "B", "3": "FVW", "4": "GKQ", "5": "L", "6": "MN", "7": "R", "8": "SZ"}
#: Letters before which an initial C, and any other C, is hard.
HARD_INITIAL, HARD_INNER = "AHKLOQRUX", "AHKOQUX"


def sound_code(text: Column, *, ascii_only: bool = False) -> Column:
    """Cologne phonetics: runs of a code become one, zeros go but for a first one."""

    def coded(own: Column) -> Column:
        n = F.length(own)

        def one(i: Column) -> Column:
            c, before, after = F.substring(own, i, F.lit(1)), F.when(i > 1, F.substring(own, i - 1, F.lit(1))).otherwise(""), F.substring(own, i + 1, F.lit(1))
            among = lambda x, letters: x.isin(*letters)
            code = F.when(c == "H", "")
            for digit, letters in SINGLE_CODES.items():
                code = code.when(among(c, letters), digit)
            code = code.when(c == "P", F.when(after == "H", "3").otherwise("1"))
            code = code.when(among(c, "DT"), F.when(among(after, "CSZ"), "8").otherwise("2"))
            code = code.when(c == "X", F.when(among(before, "CKQ"), "8").otherwise("48"))
            soft = F.when(i == 1, F.when(among(after, HARD_INITIAL), "4").otherwise("8"))
            return code.otherwise(soft.when(among(before, "SZ"), "8").when(among(after, HARD_INNER), "4").otherwise("8"))

        letters = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
        return F.array_join(F.transform(letters, one), "")

    runs = F.regexp_replace(let(sound_letters(text, ascii_only=ascii_only), coded), r"(.)\1+", "$1")
    return F.concat(F.substring(runs, 1, 1), F.replace(F.substring(runs, 2, 1 << 30), F.lit("0"), F.lit("")))


def sound_similarity(a: Column, b: Column) -> Column:
    """Matching blocks of two sound codes; 0 where either is empty."""
    return F.when((a == "") | (b == ""), 0.0).otherwise(block_ratio(a, b))


@F.pandas_udf(T.StructType([T.StructField("agreement", T.DoubleType()), T.StructField("medoid", T.IntegerType())]))
def _agreement(lists: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in lists:
        out = []
        for items in batch:
            n = 0 if items is None else len(items)
            if n < 2:
                out.append((0.0, 0))
                continue
            score = {(i, j): SequenceMatcher(None, items[i], items[j]).ratio() if items[i] or items[j] else 0.0 for i in range(n) for j in range(n) if i != j}
            pairs = [score[i, j] for i in range(n) for j in range(i + 1, n)]
            means = [sum(score[i, j] for j in range(n) if j != i) / (n - 1) for i in range(n)]
            out.append((sum(pairs) / len(pairs), max(range(n), key=lambda i: (means[i], -i))))
        yield pd.DataFrame(out, columns=["agreement", "medoid"])


def agreement(items: Column) -> Column:
    """struct(agreement, medoid) of an array of normalised takes or sound codes: mean similarity of
    the pairs i < j, and the first index with the greatest mean to the others; (0, 0) below two."""
    return _agreement(items)
