"""Encoding and decoding against the tiktoken library."""

import base64
import hashlib
import random

import numpy as np
import pytest

from lectern.llm import byte_bpe

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(byte_bpe.RANKS), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def voc():
    return byte_bpe.vocabulary(byte_bpe.RANKS)


def scraps(seed, n):
    """Texts of letters of all kinds, marks, numbers, spaces and what the library's special tokens look like."""
    r = random.Random(seed)
    kinds = ["abcdefghijklmnopqrstuvwxyz", "ABC  ", " \t\n\r\x0b\x1c\x85  　", "éüßñÀ", "0123456789²Ⅷ٣", "'s't're've'm'll'd", ".,;:!?-_/#", "日本語中文", "привет", "שלום", "\U0001F600‍́", "aaaa", "<|endoftext|>"]
    return ["".join(r.choice(r.choice(kinds)) for _ in range(r.randint(0, 60))) for _ in range(n)]


def test_words_are_encoded_as_by_the_library(voc, library):
    words = sorted({w for t in scraps(1, 3_000) for w in voc.cut.findall(t)}) + ["a" * 5_000, " " * 3_000, "ab" * 999, "=" * 77]
    got = byte_bpe.encode_words([w.encode() for w in words], voc)
    assert [g.tolist() for g in got] == [library.encode_ordinary(w) for w in words]


def test_every_code_point_is_cut_as_by_the_library(voc, library):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 4_096):
        text = "x".join(points[at : at + 4_096]) + " " + " ".join(points[at : at + 4_096])
        words = voc.cut.findall(text)
        assert "".join(words) == text
        ids = np.concatenate(byte_bpe.encode_words([w.encode() for w in words], voc))
        assert ids.tolist() == library.encode_ordinary(text), hex(ord(points[at]))


def test_merges_that_make_sooner_ones_possible():
    """A vocabulary whose ranks aren't those of training: a merge may open one of lower rank."""
    import tiktoken

    r = random.Random(5)
    for _ in range(60):
        tokens = list({"".join(r.choice("ab") for _ in range(r.randint(2, 5))).encode() for _ in range(12)})
        r.shuffle(tokens)
        ranks = {bytes([b]): b for b in range(256)} | {t: 256 + k for k, t in enumerate(tokens)}
        voc = byte_bpe.Vocabulary.__new__(byte_bpe.Vocabulary)
        voc.ranks, voc.tokens, voc.single, voc.rank_of = ranks, {v: k for k, v in ranks.items()}, list(range(256)), {}
        own = tiktoken.Encoding("own", pat_str=r"[ab]+", mergeable_ranks=ranks, special_tokens={})
        words = ["".join(r.choice("ab") for _ in range(r.randint(1, 40))) for _ in range(80)]
        assert [g.tolist() for g in byte_bpe.encode_words([w.encode() for w in words], voc)] == [own.encode_ordinary(w) for w in words]


def want(library, rows):
    out = []
    for doc, text in rows:
        ids = np.asarray(library.encode_ordinary(text or ""), "<u4")
        out.append((doc, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("how", [{}, {"REMEMBERED": 20}, {"PART": 9}])
def test_blocks(library, monkeypatch, how):
    """Whatever is remembered, and in whatever parts a text is looked at."""
    for name, value in how.items():
        monkeypatch.setattr(byte_bpe, name, value)
    own = byte_bpe.Encoder(byte_bpe.RANKS)
    for seed in range(5):
        texts = scraps(seed, 150)
        assert list(own.encode(texts)) == [np.asarray(library.encode_ordinary(t), "<u4").tobytes() for t in texts]


def test_documents(spark, library):
    texts = scraps(2, 300) + [None, "", " ", "same text", "same text"]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted((tuple(r) for r in byte_bpe.encode(df, digests=True).collect()), key=str) == want(library, rows)


def test_ids_and_their_decoding(spark, library):
    rows = list(enumerate(scraps(3, 100)))
    done = byte_bpe.encode(spark.createDataFrame(rows, "doc_id long, text string"))
    for r in byte_bpe.decode(done, out_col="decoded").collect():
        assert np.frombuffer(r["ids"], "<u4").tolist() == library.encode_ordinary(rows[r["doc_id"]][1])
        assert r["decoded"].decode() == r["_decoded"].decode() == rows[r["doc_id"]][1]


def test_odd_tables(spark, library):
    rows = [(None, "no id"), (None, None), (5, "twice twice"), (5, "twice twice"), ((1 << 60) + 1, "x" * 2_000_000 + " y" * 300_000)]
    clash = [(*r, "en", "s", 1, 2, "w", b"i", 3) for r in rows]
    df = spark.createDataFrame(clash, SCHEMA + ", block int, words string, ids binary, own_id int")
    assert sorted((tuple(r) for r in byte_bpe.encode(df, digests=True).collect()), key=str) == want(library, rows)
    assert byte_bpe.encode(spark.createDataFrame([], SCHEMA)).collect() == []
