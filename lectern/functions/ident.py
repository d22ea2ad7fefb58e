"""Content-derived identity: digests, hashes and the paths that follow from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Parameters of 32-bit FNV-1a.
FNV_OFFSET, FNV_PRIME = 2166136261, 16777619
MASK = 0xFFFFFFFF
#: Letters of the three passage fields in paths.
FIELD_LETTERS = {"description": "o", "progress": "p", "completion": "c"}
#: Shape of a clip path.
CLIP_PATH = r"^sounds/(?:q/\d{2}/\d+_[opc]\d+|w/[0-9a-f]{2}/[0-9a-f]{16})\.(?:ogg|mp3)$"


def fnv1a32(data: Column, ahead: bytes = b"") -> Column:
    """FNV-1a over the UTF-8 bytes of a string, behind the bytes `ahead`; a non-negative long.

    An XOR below 2^32 times the prime stays below 2^57, so ANSI arithmetic never overflows.
    """
    start = FNV_OFFSET
    for b in ahead:
        start = (start ^ b) * FNV_PRIME & MASK
    hexed = F.hex(data.cast("binary"))
    n = F.length(hexed)
    places = F.when(n > 0, F.sequence(F.lit(1), n - 1, F.lit(2))).otherwise(F.array().cast("array<int>"))
    byte = lambda i: F.conv(F.substring(hexed, i, F.lit(2)), 16, 10).cast("long")
    return F.aggregate(places, F.lit(start).cast("long"), lambda h, i: (h.bitwiseXOR(byte(i)) * FNV_PRIME).bitwiseAND(MASK))


def word_digest(word: Column) -> Column:
    """Sixteen hex digits: two FNV passes, the second behind a byte 1."""
    text = F.coalesce(word, F.lit(""))
    half = lambda h: F.lpad(F.lower(F.hex(h)), 8, "0")
    return F.concat(half(fnv1a32(text)), half(fnv1a32(text, b"\x01")))


def text_hash(text: Column) -> Column:
    """Version of a text: the first sixteen hex digits of its SHA-1."""
    return F.substring(F.sha1(F.coalesce(text, F.lit("")).cast("binary")), 1, 16)


def word_path(word: Column, ext: str = "ogg") -> Column:
    digest = word_digest(word)
    return F.concat(F.lit("sounds/w/"), F.substring(digest, 1, 2), F.lit("/"), digest, F.lit("." + ext))


def quest_path(quest: Column, field: Column, sentence: Column, ext: str = "ogg") -> Column:
    letter = F.element_at(F.create_map(*[F.lit(x) for kv in FIELD_LETTERS.items() for x in kv]), field)
    return F.concat(F.lit("sounds/q/"), F.lpad(F.pmod(quest, F.lit(100)).cast("string"), 2, "0"), F.lit("/"), quest.cast("string"), F.lit("_"), letter, sentence.cast("string"), F.lit("." + ext))


def valid_path(path: Column) -> Column:
    """Relative, below one of the two roots, without a step up."""
    return F.coalesce(path.rlike(r"^sounds/[qw]/") & ~path.rlike(r"(^|/)\.\.(/|$)"), F.lit(False))


def clip_path_shape(path: Column) -> Column:
    return F.coalesce(path.rlike(CLIP_PATH), F.lit(False))


def stem_parts(stem: Column) -> Column:
    """quest, letter, idx of a clip's file stem like 25152_o1, cut at its last underscore; null for other stems."""
    shape = r"^(\d+)_(.)(\d+)$"
    part = lambda k: F.regexp_extract(stem, shape, k)
    return F.when(stem.rlike(shape), F.struct(part(1).cast("bigint").alias("quest"), part(2).alias("letter"), part(3).cast("int").alias("idx")))
