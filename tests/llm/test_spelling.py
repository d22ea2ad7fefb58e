"""Spelling variants against all pairs of words, compared one by one."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from lectern.llm import spelling

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def plain_words(rows, damaged=97):
    count = Counter()
    for doc, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if damaged and h % damaged == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    return count


def plain(rows, damaged=97):
    """(word, form, root, n, n_near, form_n): neighbours share a deletion, or one is the other's."""
    n = {w: k for w, k in plain_words(rows, damaged).items() if len(w) >= 5 and k >= 3}
    shapes = defaultdict(set)
    for w in n:
        for i in range(len(w)):
            shapes[i, w[:i] + w[i + 1 :]].add(w)
    near = defaultdict(set)
    for own in shapes.values():
        for w in own:
            near[w] |= own - {w}
    for w in n:
        for i in range(len(w)):
            if (less := w[:i] + w[i + 1 :]) in n:
                near[w].add(less)
                near[less].add(w)
    form = {}
    for w, own in near.items():
        best = min(own, key=lambda o: (-n[o], o), default=None)
        if best and n[best] >= 2 * n[w]:
            form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return sorted(out)


def got(df, **how):
    return sorted(tuple(r) for r in spelling.variants(df, **how).select("word", "form", "root", "n", "n_near", "form_n").collect())


def corpus(seed, letters, size, n=400):
    """Documents of words and of what one, two or three edits make of them, frequent and rare."""
    r = random.Random(seed)
    base = ["".join(r.choice(letters) for _ in range(r.randint(4, 9))) for _ in range(size)]

    def worn(w):
        for _ in range(r.choice((0, 0, 0, 1, 1, 2, 3))):
            i = r.randrange(len(w) + 1)
            w = r.choice((w[:i] + r.choice(letters) + w[i:], w[:i] + w[i + 1 :], w[:i] + r.choice(letters) + w[i + 1 :])) or "x"
        return w.upper() if r.random() < 0.1 else w

    return [(k, r.choice((" ", ", ", "\n", "7")).join(worn(base[int(size * r.random() ** 3)]) for _ in range(60))) for k in range(n)]


@pytest.mark.parametrize(("letters", "dense"), [("abc", 256), ("abc", 2), ("aabbcdefghÄäéß", 256), ("aabbcdefghÄäéß", 3), ("ab", 1), ("aaab", 40)])
def test_variants_are_those_of_all_pairs(spark, letters, dense):
    rows = corpus(len(letters) + dense, letters, 60)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = plain(rows)
    assert sum(w[4] for w in want) > 20 and any(w[2] != w[0] for w in want)
    assert got(df, dense=dense) == want


def test_chains_lead_to_their_end(spark):
    words = {"aaaaa" + "b" * k: 3 * 2**k for k in range(6)} | {"zzzzz": 7, "zzzzzy": 7}
    rows = [(k, " ".join([w] * n)) for k, (w, n) in enumerate(words.items())]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df, damaged=0) == plain(rows, 0)
    assert {r[2] for r in got(df, damaged=0)} == {"aaaaabbbbb", "zzzzz", "zzzzzy"}


def test_odd_tables(spark):
    long = "q" * 40_000
    texts = [None, "", "-- 12 ×÷", "hello hellp hello Hello hellp hellp", f"{long} {long}x " * 3, "Über über ÜBER Über Über über"]
    rows = [(k, t, "en", "s", 1) for k, t in enumerate(texts)] + [(None, "hello hello " * 9, None, None, None)] * 2
    clash = [(*r, "w", 1, 2, "r", 3) for r in rows]
    df = spark.createDataFrame(clash, SCHEMA + ", word string, n int, h int, run string, key int")
    assert got(df) == plain([r[:2] for r in rows])
    assert spelling.variants(spark.createDataFrame([], SCHEMA)).collect() == []


def test_letters_go_where_the_hash_says(spark):
    rows = [(k, "letters wander through words") for k in range(2_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["word"]: r["n"] for r in spelling.words(df).collect()} == dict(plain_words(rows))
