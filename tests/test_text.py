"""Passage functions against hand-made cases that the tables never exercise."""

import time
import unicodedata

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lectern.functions import text


def one(spark, value, make):
    return spark.createDataFrame([(value,)], "t string").select(make(F.col("t")).alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("given", "wanted"),
    [
        ("Geht nun, {name}.", "Geht nun."),
        ("$g Bruder:Schwester; kam.", "Bruder kam."),
        ("Drei |4Tag:Tage; lang.", "Drei Tage lang."),
        ("<Held/Heldin>, kommt!", "Held, kommt!"),
        ("<Er nickt Euch zu.>", "Er nickt Euch zu."),
        ("[PH] Text", ""),
        ("  \n ", ""),
        (None, ""),
        ("Danke.Ihr bekommt: Gold\nund mehr", "Danke."),
        ("|cFF00FF00Rot|r und $2063w Gold$B$BEnde $N", "Rot und Gold\n\nEnde"),
        ("a\r\nb\rc", "a\nb\nc"),
        ("gut ,, sehr  gut !", "gut, sehr gut!"),
        ("a\n\n\n\nb", "a\n\nb"),
        ("über", "über"),
        ("|3-6(Ausdruck) hier", "Ausdruck hier"),
    ],
)
def test_clean(spark, given, wanted):
    assert one(spark, given, text.clean) == wanted


@pytest.mark.parametrize(
    ("given", "wanted"),
    [
        ("Das ist z.B. gut. Ja.", ["Das ist z.B. gut.", "Ja."]),
        ("erste Zeile\nzweite", ["erste Zeile", "zweite"]),
        ("„Halt!“ rief er. Dann… nichts", ["„Halt!“", "rief er.", "Dann…", "nichts"]),
        ("", []),
        (None, []),
    ],
)
def test_sentences(spark, given, wanted):
    assert one(spark, given, text.sentences) == wanted


def plain_clips(passage):
    """The grouping rule step by step."""
    done, n = [], 0
    for paragraph in passage:
        cur, first = "", 0
        for s in paragraph:
            n += 1
            if cur and len(cur) + 1 + len(s) > 420:
                done.append([cur, first, n - 1])
                cur = ""
            cur, first = (cur + " " + s, first) if cur else (s, n)
            if len(cur) >= 30:
                done.append([cur, first, n])
                cur = ""
        if cur and done and len(done[-1][0]) + 1 + len(cur) <= 420:
            done[-1] = [done[-1][0] + " " + cur, done[-1][1], n]
        elif cur:
            done.append([cur, first, n])
    return [tuple(c) for c in done if any(ch.isalpha() for ch in c[0])]


@pytest.mark.parametrize(
    "passage",
    [
        [["Kurz.", "Auch kurz."]],
        [["Ja.", "x" * 418 + ".", "Nein."]],
        [["Ein Satz von mehr als dreißig Zeichen steht hier."], ["Rest."]],
        [["Rest."], ["1, 2, 3."]],
        [["123."]],
        [["a" * 400 + "."], ["b" * 25 + "."]],
        [["a" * 25 + ".", "b" * 415 + ".", "c."]],
    ],
)
def test_clips(spark, passage):
    joined = "\n\n".join(" ".join(p) for p in passage)
    got = [(c["text"], c["first"], c["last"]) for c in one(spark, joined, text.clips)]
    assert got == plain_clips(passage)


def test_two_sentences_in_one_clip_are_not_plain(spark):
    df = spark.createDataFrame([("Kurz. Auch kurz.",)], "t string")
    plain = text.is_plain(text.clips(F.col("t")), F.size(text.sentences(F.col("t"))))
    assert df.select(plain).first()[0] is False


def test_split_long_repacks(spark):
    given = ", ".join(["wort" * 25] * 9)
    parts = one(spark, given, text.split_long)
    assert ", ".join(parts) == given and all(len(p) <= 420 for p in parts)
    assert one(spark, "kurz", text.split_long) == ["kurz"]


def test_small_text_functions(spark):
    assert one(spark, 'a\\"b\\nc\\\\d', text.unescape) == 'a"b\nc\\d'
    assert one(spark, "Straße, Öl_1!", text.normalise) == "strasseöl_1"
    assert one(spark, "Ab-c + d!", text.fold_edges) == "abc+d"
    assert one(spark, "GROẞE Äpfel", text.word_key) == "grosse äpfel"
    assert one(spark, "{name} der $C", text.render) == "Wandrer der Gewerbe"
    assert one(spark, "it's a well-known x", text.pieces) == ["it's", "a", "well-known", "x"]
    assert one(spark, "ein Öl x 12ab", text.word_tokens) == ["ein", "Öl", "ab"]


def test_sentences_at_once_are_those_word_by_word(spark):
    import random

    from pyspark.sql import functions as F

    from lectern.functions import text

    r = random.Random(5)
    bits = ["a", "Dr.", "dr.", "z.B.", "(d.h.", "e.g.)", "end.", "end!”", "why?\")", "…", ".", "..", "bzw.»", "xdr.", "\n", "\n\n", "\r\n", " ", "  ", "\t", "\u00a0", "\u2028", "\x1c", "\u3000", "ſ", "Mrſ.", "", "3.5", "\ue00a"]
    rows = [("".join(r.choice(bits) + r.choice(["", " ", " "]) for _ in range(r.randint(0, 25))),) for _ in range(1500)] + [(None,), ("",), (" \n ",)]
    got = spark.createDataFrame(rows, "t string").select("t", text.sentences(F.col("t")).alias("a"), text.sentences_by_word(F.col("t")).alias("b")).collect()
    assert [x["t"] for x in got if x["a"] != x["b"]] == []


def test_paragraphs_number_their_sentences_on(spark):
    """Clips never cross a blank line but at its end, and sentence numbers run through all paragraphs."""
    from pyspark.sql import functions as F

    from lectern.functions import text

    long = "This is a sentence that is long enough to stand alone."
    rows = [(f"{long} {long}\n\n{long}\n\nNo. {long}",), (f"Short.\n\n{long}",), (f"{long}\n\nShort.",), ("One.\n\nTwo.",)]
    got = spark.createDataFrame(rows, "t string").select(text.clips(F.col("t")).alias("c")).collect()
    assert [[(c["first"], c["last"]) for c in x["c"]] for x in got] == [[(1, 1), (2, 2), (3, 3), (4, 5)], [(1, 1), (2, 2)], [(1, 2)], [(1, 2)]]
    assert got[2]["c"][0]["text"] == f"{long} Short."


def test_long_runs_of_white_space_are_read_once(spark):
    """A run of n characters took about n * n / 2 steps wherever a pattern was tried at each of its places."""
    n = 150_000
    rows = [("a" + " " * n + "b. \x85" + "\n\x1f" * n + "c",), ("a" + "\n" * n + "b",), (" " * n,)]
    t = F.col("text")
    df = spark.createDataFrame(rows, "text string")
    began = time.monotonic()
    got = df.select(text.tidy(t), F.length(text.strip(t)), text.sentences(t)).collect()
    assert time.monotonic() - began < 30
    assert [r[0] for r in got] == ["a b." + "\n" * n + "c", "a\n\nb", ""]
    assert [r[1] for r in got] == [len(rows[0][0]), n + 2, 0]
    assert [len(r[2]) for r in got] == [n + 1, 2, 0]


def test_composition_goes_by_small_parts(spark):
    """a batch of 10,000 texts, needed or not, stood in a worker's memory several times over."""
    given = [None, "", "plain \u00e9"] * 1000 + ["e\u0301 \u4e00"] * 250
    parts = list(text._nfc.func(iter([pa.array(given)])))
    assert max(map(len, parts)) <= 100 and sum(map(len, parts)) == len(given)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(given)], "i int, t string")
    got = [r["x"] for r in df.select("i", text.nfc(F.col("t")).alias("x")).orderBy("i").collect()]
    assert got == [t and unicodedata.normalize("NFC", t) for t in given]
