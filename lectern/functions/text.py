r"""Normalisation, cleaning and segmentation of passages, as column expressions.

Missing and empty text are one: every function coalesces null to "" at entry. Java's `\s` and `\w` are
ASCII by default, so patterns over text carry `(?U)`.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_CHARS = 420
MIN_CHARS = 30

#: Tokens that end in a full stop without ending a sentence.
ABBREVIATIONS = ("dr.", "mr.", "mrs.", "ms.", "z.b.", "d.h.", "bzw.", "e.g.", "i.e.")
#: Quotes and brackets that may follow a sentence's last mark.
CLOSERS = "\"'>)]“”’»"
#: Stand-ins of seven, seven and six characters for a reader's name, trade and people.
STAND_INS = ("Wandrer", "Gewerbe", "Mensch")

#: White space beyond Latin-1; a letter leaves the class at its first, wide range.
_FAR = r"[\u1680-\u3000&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]"
#: White space of a line as Python's text patterns see it, spelled out: Java's Unicode classes cost far more. Characters of
#: Latin-1 stand one by one, as those are looked up in one table; each range is a test of its own.
_BLANKS = r" \t\x0b\f\r\x1c\x1d\x1e\x1f\x85\u00a0" + _FAR
SPACES = r"\n" + _BLANKS
#: The same characters, to be trimmed.
_SPACE_CHARS = "\n \t\x0b\f\r\x1c\x1d\x1e\x1f\x85\u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def _run(chars: str) -> str:
    """A pattern for a whole run of characters of a class: it is tried at the run's first one only, so a long run isn't read again from each of its places."""
    return rf"[{chars}](?<![{chars}][{chars}])[{chars}]*+"


#: The rewriting steps of `clean`, in order; each is one pattern and what replaces it.
CLEANING = (
    ("reward header to the end", r"(?sU)(?:Ihr\s+(?:bekommt|erhaltet)|Zur\s+Auswahl\s+stehen)\s*:?\s*.*$", ""),
    ("colour opens", r"\|c[0-9A-Fa-f]{8}", ""),
    ("colour closes", r"\|r", ""),
    ("icon", r"\|[AaTt]:?[^|]*\|[aAtT]?", " "),
    ("declension", r"\|3-\d+\(([^)]*)\)", "$1"),
    ("plural takes its second form", r"\|4([^:;]*):([^;]*);", "$2"),
    ("gender takes its first form", r"(?U)\$[Gg]\s*([^:;]*):([^;]*);", "$1"),
    ("line break token", r"\$[Bb]", "\n"),
    ("angled pair takes its first word", r"<([^<>/]*)/([^<>]*)>", "$1"),
    ("player and stage tokens", r"(?U)\s*,?\s*(?:<[A-Za-z][A-Za-z ]*>|\{[A-Za-z][A-Za-z ]*\})\s*", " "),
    ("angled prose loses its brackets", r"(?s)<([^<>]{1,800})>", "$1"),
    ("numbered token", r"\$\d+[A-Za-z]?", ""),
    ("bare token", r"\$[A-Za-z]", ""),
    ("carriage returns", r"\r\n?", "\n"),
    ("runs of blanks", r"[ \t]{2,}|\t", " "),
    ("doubled punctuation keeps the second", rf"[,;:][{SPACES}]*+([,.;:!?])", "$1"),
    ("no space before punctuation", rf"{_run(SPACES)}([,.;:!?])", "$1"),
    ("at most one empty line", r"\n{3,}", "\n\n"),
    ("blanks at line ends", rf"(?:{_run(_BLANKS)})?\n[{_BLANKS}]*+", "\n"),
)
#: Beginnings of passages that are placeholders, not text.
PLACEHOLDER = r"(?iU)^\s*(?:\[PH\]|\[DNT\]|\[DEPRECATED\]|PH\b|TEST\b)"


def _present(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


#: Texts that are composed at once; a batch from Spark has 10,000 rows, however long.
_COMPOSED = 100


@F.arrow_udf(T.StringType())
def _nfc(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in texts:
        for at in range(0, len(batch), _COMPOSED):
            part = batch.slice(at, _COMPOSED).to_pylist()
            yield pa.array([t if t is None else unicodedata.normalize("NFC", t) for t in part], pa.string())


def nfc(text: Column) -> Column:
    """Canonical composition. Spark has no such function; texts that have nothing to compose aren't sent to Python."""
    # All rows go through the function, whatever stands around it: where it isn't needed, with null for the text.
    return F.coalesce(_nfc(F.when(text.rlike(r"[^\u0000-˿]"), text)), text)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(_SPACE_CHARS))


def clean(text: Column, *, compose: bool = True) -> Column:
    """A passage as it is to be read; "" where it is not to be read at all.

    compose: whether to bring the text into NFC first; leave it out for text known to be composed.
    """
    own = _present(text)
    own = nfc(own) if compose else own
    done = own
    for _, pattern, instead in CLEANING:
        done = F.regexp_replace(done, pattern, instead)
    return F.when(strip(own).eqNullSafe("") | own.rlike(PLACEHOLDER), F.lit("")).otherwise(strip(done))


def tidy(text: Column) -> Column:
    """The white-space and punctuation steps of `clean` alone; all native."""
    done = _present(text)
    for _, pattern, instead in CLEANING[-6:]:
        done = F.regexp_replace(done, pattern, instead)
    return strip(done)


#: A mark between sentences while a text is cut; texts that hold it go word by word.
_CUT_HERE = "\ue00a"
#: What `(?U)\s` means, spelled out: within a line, and to be trimmed.
_WHITE_OF_LINE = r" \t\x0b\f\x85\u00a0" + _FAR
_WHITE = r"[\r\n" + _WHITE_OF_LINE + "]"
_WHITE_CHARS = "".join(c for c in _SPACE_CHARS if c not in "\x1c\x1d\x1e\x1f")


def sentences(text: Column) -> Column:
    """The passage's sentences.

    A sentence ends with a word that has, before any closing quotes and brackets, one of . ! ? … and
    isn't a known abbreviation; a line break between two words ends it too. Inner space stays.
    """
    any_case = lambda word: "".join(f"[{c.upper()}{c}]" if c.isalpha() else "\\" + c for c in word)
    abbreviated = "|".join(rf"(?<={_WHITE}|^){any_case(a)}" for a in ABBREVIATIONS)
    closers = "".join("\\" + c for c in CLOSERS)
    ended = rf"([.!?…])(?<!{abbreviated})([{closers}]*+){_WHITE}++"
    broken = rf"(?:{_run(_WHITE_OF_LINE)})?[\r\n]{_WHITE}*+"

    def at_once(trimmed: Column) -> Column:
        # White space is a run behind a sentence's end or one with a line break; of both, the end's pattern begins before it.
        marked = F.regexp_replace(trimmed, f"{ended}|{broken}", "$1$2" + _CUT_HERE)
        return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.transform(F.split(marked, _CUT_HERE), strip))

    def cut(own: Column) -> Column:
        return F.when(F.contains(own, F.lit(_CUT_HERE)), sentences_by_word(own)).otherwise(let(F.btrim(own, F.lit(_WHITE_CHARS)), at_once))

    # Bound once each: what stands in an expression twice is worked out twice.
    return let(_present(text), cut)


def sentences_by_word(text: Column) -> Column:
    """As `sentences`, word by word: the rule itself, at many times the cost."""
    tokens = F.regexp_extract_all(_present(text), F.lit(r"(?U)\s*\S+"), F.lit(0))
    bare = lambda t: F.regexp_replace(t, r"(?U)^\s+|[\"'>)\]“”’»]+$", "")

    def ends(t: Column) -> Column:
        """The last mark is looked at first; most words have none."""
        closed = F.substring(t, -1, 1).isin(*".!?…", *CLOSERS)
        return closed & let(bare(t), lambda b: b.rlike(r"[.!?…]$") & ~F.lower(b).isin(*ABBREVIATIONS))

    def cut(own: Column) -> Column:
        n = F.size(own)
        last = F.filter(F.sequence(F.lit(1), n), lambda i: (i == n) | ends(F.get(own, i - 1)) | (F.substring(F.get(own, i), 1, 1).isin("\n", "\r") | F.get(own, i).rlike(r"^(?U)\s+[\r\n]")))
        join = lambda ends: F.transform(ends, lambda e, k: strip(F.array_join(F.slice(own, F.when(k == 0, 1).otherwise(F.get(ends, k - 1) + 1), e - F.when(k == 0, 0).otherwise(F.get(ends, k - 1))), "")))
        return F.when(n > 0, let(last, join)).otherwise(F.array().cast("array<string>"))

    return let(tokens, cut)


def let(value: Column, body) -> Column:
    """`body` with `value` bound once, however often it is used."""
    return F.get(F.transform(F.array(value), body), 0)


def grouped(sentence_list: Column) -> Column:
    """Clips of one paragraph's or passage's sentences: array of (text, first, last), numbered from 1.

    Sentences are joined with a space while the sum stays within MAX_CHARS; a clip is closed as soon
    as it has MIN_CHARS. What is left over joins the clip before it if that stays within the limit.
    """
    return F.filter(_folded(F.array(sentence_list)), lambda c: c["text"].rlike(r"\p{L}"))


def clips(text: Column) -> Column:
    """Clips of a passage: paragraphs are grouped one by one, sentence numbers run through."""
    return clips_of(paragraphs(text))


def paragraphs(text: Column) -> Column:
    """The sentences of each paragraph."""
    return F.transform(F.split(_present(text), "\n\n"), sentences)


def clips_of(paragraph_list: Column) -> Column:
    return F.filter(_folded(paragraph_list), lambda c: c["text"].rlike(r"\p{L}"))


def client_clips(text: Column) -> Column:
    """As the client groups: anything beyond ASCII counts as a letter, so clips of dashes and quotes stay."""
    return F.filter(_folded(paragraphs(text)), lambda c: c["text"].rlike(r"[A-Za-z]|[^\x00-\x7f]"))


_CUT = "struct<first:int,last:int>"


def _folded(paragraphs: Column) -> Column:
    """The fold runs over lengths alone and gives first and last numbers; texts are joined once at the end."""
    cut = lambda first, last: F.struct(first.cast("int").alias("first"), last.cast("int").alias("last"))

    def state(done: Column, size: Column, first: Column, n: Column, before: Column) -> Column:
        """Cuts so far; length and first number of the open clip; sentences so far; length of the last cut."""
        return F.struct(done.alias("done"), size.cast("int").alias("size"), first.cast("int").alias("first"), n.cast("int").alias("n"), before.cast("int").alias("before"))

    def take(s: Column, size: Column) -> Column:
        n = s["n"] + 1
        sum_ = s["size"] + 1 + size

        def go(own: Column) -> Column:
            over, size_, first = own["over"], own["size"], own["first"]
            full = size_ >= MIN_CHARS
            closed = F.when(over, F.array_append(s["done"], cut(s["first"], n - 1))).otherwise(s["done"])
            done = F.when(full, F.array_append(closed, cut(first, n))).otherwise(closed)
            return state(done, F.when(full, 0).otherwise(size_), first, n, F.when(full, size_).when(over, s["size"]).otherwise(s["before"]))

        fresh = (s["size"] == 0) | (sum_ > MAX_CHARS)
        return let(F.struct(((s["size"] > 0) & (sum_ > MAX_CHARS)).alias("over"), F.when(fresh, size).otherwise(sum_).alias("size"), F.when(fresh, n).otherwise(s["first"]).alias("first")), go)

    def close(s: Column) -> Column:
        """At the end of a paragraph: what is left joins the clip before, across paragraphs too, or stands alone."""
        k = F.size(s["done"])
        fits = (k > 0) & (s["before"] + 1 + s["size"] <= MAX_CHARS)
        joined = F.array_append(F.slice(s["done"], F.lit(1), F.greatest(k - 1, F.lit(0))), cut(F.get(s["done"], k - 1)["first"], s["n"]))
        alone = F.array_append(s["done"], cut(s["first"], s["n"]))
        left = s["size"] > 0
        done = F.when(~left, s["done"]).when(fits, joined).otherwise(alone)
        return state(done, F.lit(0), F.lit(0), s["n"], F.when(~left, s["before"]).when(fits, s["before"] + 1 + s["size"]).otherwise(s["size"]))

    start = state(F.array().cast(f"array<{_CUT}>"), F.lit(0), F.lit(0), F.lit(0), F.lit(0))

    def made(own: Column) -> Column:
        cuts = F.aggregate(own, start, lambda s, p: let(F.aggregate(F.transform(p, F.length), s, take), close), lambda s: s["done"])
        joined = lambda every: F.transform(cuts, lambda c: F.struct(F.array_join(F.slice(every, c["first"], c["last"] - c["first"] + 1), " ").alias("text"), c["first"].alias("first"), c["last"].alias("last")))
        return let(F.flatten(own), joined)

    return let(paragraphs, made)


def is_plain(clip_list: Column, n_sentences: Column) -> Column:
    """Whether the clips are simply one for each sentence."""
    return F.transform(clip_list, lambda c: c["first"]).eqNullSafe(F.when(n_sentences > 0, F.sequence(F.lit(1), n_sentences)).otherwise(F.array().cast("array<int>")))


def split_long(text: Column, limit: int = MAX_CHARS) -> Column:
    """Texts beyond the limit cut at ", " and packed again up to it; a longer piece stays whole."""
    pieces = F.split(_present(text), ", ")

    def take(s: Column, piece: Column) -> Column:
        joined = F.concat(s["text"], F.lit(", "), piece)
        fits = F.length(joined) <= limit
        done = F.when(F.isnull(s["text"]) | fits, s["done"]).otherwise(F.array_append(s["done"], s["text"]))
        return F.struct(done.alias("done"), F.when(F.isnull(s["text"]), piece).when(fits, joined).otherwise(piece).alias("text"))

    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit(None).cast("string").alias("text"))
    packed = F.aggregate(pieces, start, take, lambda s: F.array_append(s["done"], s["text"]))
    return F.when(F.length(_present(text)) <= limit, F.array(_present(text))).otherwise(packed)


def render(text: Column, stand_ins: tuple[str, str, str] = STAND_INS) -> Column:
    """The passage with its reader tokens filled in."""
    done = _present(text)
    for pattern, value in zip((r"\{name\}|<[Nn]ame>|\$[Nn]", r"\{class\}|<[Kk]lasse>|\$[Cc]", r"\{race\}|<[Vv]olk>|\$[Rr]"), stand_ins):
        done = F.regexp_replace(done, pattern, value)
    return done


def normalise(text: Column) -> Column:
    """Letters, digits and underscores, case-folded: what two transcripts are compared by."""
    return F.replace(F.lower(F.regexp_replace(_present(text), r"(?U)[^\w]+", "")), F.lit("ß"), F.lit("ss"))


def fold_edges(text: Column) -> Column:
    """Lower-cased, without punctuation, separators and control characters; symbols stay."""
    return F.regexp_replace(F.lower(_present(text)), r"[\p{P}\p{Z}\p{C}]", "")


def fold_case(text: Column) -> Column:
    return F.lower(_present(text))


def word_key(text: Column) -> Column:
    """Fallback key of a dictionary word: sharp s as ss, the three capital umlauts and A-Z lowered."""
    done = F.replace(F.replace(_present(text), F.lit("ß"), F.lit("ss")), F.lit("ẞ"), F.lit("ss"))
    return F.translate(done, "ABCDEFGHIJKLMNOPQRSTUVWXYZÄÖÜ", "abcdefghijklmnopqrstuvwxyzäöü")


def pieces(text: Column) -> Column:
    """Runs of word characters, apostrophes and hyphens."""
    return F.filter(F.split(_present(text), r"(?U)[^\w'’-]+"), lambda p: p != "")


def word_tokens(text: Column) -> Column:
    """Runs of at least two letters."""
    return F.filter(F.regexp_extract_all(_present(text), F.lit(r"\p{L}+"), F.lit(0)), lambda w: F.length(w) > 1)


def unescape(text: Column) -> Column:
    r"""\" then \n then \\, in this order."""
    done = F.replace(_present(text), F.lit('\\"'), F.lit('"'))
    done = F.replace(done, F.lit("\\n"), F.lit("\n"))
    return F.replace(done, F.lit("\\\\"), F.lit("\\"))
