"""Operators on small tables: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import math
import os
import random
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lectern.llm import decontamination, language_id, line_dedup, near_dedup, packing, quality, secret_scan, sharding, suffix_dedup, toxicity

from . import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = "doc_id long, text string, lang string, source string, n_chars long, key string, rank int, row long, doc string, tie int, label string, n int, shard int, length int, words string, _salt int"


def prose(r, n):
    return " ".join("".join(r.choice(["th", "er", "on", "an", "re", "he", "in", "ed"]) for _ in range(r.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(7)
    base = [prose(r, r.randint(1, 120)) for _ in range(60)]
    passage, line = prose(r, 140), "A line that many of the documents here share, " + prose(r, 6) + "."
    texts = [*base, None, "", " \n ", "x", base[3], base[3], base[4] + " and a tail", passage, base[5] + passage + base[6], "Ä" + passage[50:], passage + passage]
    texts += [f"{b}\n  {line} \n{b[::-1]}" for b in base[:7]] + [base[8] + " changed " + base[9], prose(r, 9000), "a" * 3000, "same words " * 300]
    texts += [base[10].upper(), 'password: hunter22 AKIA' + "A1" * 9 + ' token = "' + "0f" * 20 + '"', "secret: x password=abcdefg", 'ſecret: abcdefgh API_KEY:"Zz9+/' + "Qq7" * 8 + '"']
    texts += [base[20] + "\n" + base[20], "| a | b |\n| c | d |", base[11] + " 12 km " + base[12]]
    ids = list(range(len(texts)))
    return [(i, t, "en" if i % 2 else "de", f"s{i % 5}", len(t or "")) for i, t in zip(ids, texts)]


@pytest.fixture(scope="module")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids, repeated rows, and columns named like the operators' own."""
    rows = [(None, "a text without an id", None, None, None), (5, "one two three four five six", "en", "s", 1), (5, "one two three four five six", "en", "s", 1), (6, None, None, None, None)]
    return spark.createDataFrame([(*r, "k", 1, 2, "d", 3, "l", 4, 5, 6, "w", 7) for r in rows], CLASHING)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_packing(spark, docs, corpus):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path("word_bpe_49k.json"))
    rows = packing.pack(docs).collect()
    pieces = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
    for doc, text, *_ in corpus:
        ids = t.encode(text or "", add_special_tokens=False).ids + [1]
        cut = [ids[a : a + 4096] for a in range(0, len(ids), 4096)]
        own = sorted(pieces[doc], key=lambda r: r["piece"])
        assert [(r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in own] == [(k, 4096 * k, len(c), zlib.crc32(struct.pack(f"<{len(c)}I", *c))) for k, c in enumerate(cut)]
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(places) <= -(-sum(r["length"] for r in rows) // 4096) + 1


def test_packing_plans_hold_the_histogram():
    r = random.Random(1)
    for _ in range(10):
        have = {r.randint(1, 4096): r.randint(1, 40) for _ in range(r.randint(1, 60))}
        used = {}
        for config, n in packing.plan(have, rounds=20):
            assert sum(l * k for l, k in config.items()) <= 4096 and n > 0
            for l, k in config.items():
                used[l] = used.get(l, 0) + k * n
        assert used == have


def test_plans_of_many_lengths_meet_the_bound_by_tokens():
    r = random.Random(4)
    have = {}
    for _ in range(10_000):
        l = min(4096, int(r.paretovariate(0.7) * 25))
        have[l] = have.get(l, 0) + 1
    got = packing.plan(have)
    used = {}
    for config, n in got:
        for l, k in config.items():
            used[l] = used.get(l, 0) + k * n
    bound = -(-sum(l * n for l, n in have.items()) // 4096)
    assert used == have and sum(n for _, n in got) <= bound + 1


def test_program_and_its_bound():
    columns, bound = packing.fractional_cover(np.array([3, 4, 5]), np.array([30, 20, 10]), 10)
    assert 21.9 <= bound <= sum(x for _, x in columns) * 1.03


def test_ids_that_no_float_holds(spark):
    big = (1 << 53) + 1
    rows = spark.createDataFrame([(big, "one two"), (None, "three"), (big + 2, None)], "doc_id long, text string").coalesce(1)
    assert {r["doc_id"] for r in packing.pack(rows).collect()} == {big, None, big + 2}


def test_knapsack():
    lengths, prices = np.array([3, 5, 7]), np.array([1.0, 2.0, 2.9])
    assert packing.best_configuration(prices, lengths, 10) == {5: 2}


def test_words_with_capital_sigma_and_odd_spaces():
    from public_tokenizers import path
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path("word_bpe_49k.json"))
    for text in ("ΟΔΟΣ Σ ΑΣ. x", "a\x1cb c d e", "it's we'll 12.5, end. end.. , .", "é ́x", "<|endoftext|> a<|startoftext|>b", "İI Ǆ"):
        assert packing.coder(packing.TOKENIZER).encode(pa.array([None, "x", text])[1:])[1] == struct.pack(f"<{len(i := t.encode(text, add_special_tokens=False).ids)}I", *i)


def test_sharding(docs, corpus):
    got = by_id(sharding.shard(docs))
    assert len(got) == len(corpus)
    for doc, text, *_ in corpus:
        raw = (text or "").encode()
        assert (got[doc]["size"], got[doc]["text_crc32"]) == (len(raw) + 16, zlib.crc32(raw))
        assert got[doc]["grown_shard"] in (got[doc]["shard"], 40)
    slots = {}
    for r in got.values():
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    again = by_id(sharding.shard(docs, shards=41))
    assert all(again[d]["shard"] == r["grown_shard"] for d, r in got.items())


@pytest.mark.parametrize("weights", [[1.0] * 40, [0.5, 2.0, 1.0, 7.0]])
def test_shards_are_those_of_the_greatest_score(spark, docs, corpus, weights):
    """Every record against every shard, one score at a time in plain Python; only the hash is Spark's."""
    ids = [r[0] for r in corpus]
    pairs = spark.createDataFrame([(i, "" if i is None else f"k{i}", s) for i in ids for s in range(len(weights) + 1)], "doc_id long, key string, shard int")
    hashes = {(r[0], r[1]): r[2] for r in pairs.select("doc_id", "shard", F.xxhash64("key", "shard")).collect()}
    got = by_id(sharding.shard(docs, weights=weights, new_weight=1.5))

    def score(doc, shard, weight):
        return -weight / math.log(((hashes[doc, shard] & (1 << 53) - 1) + 0.5) / float(1 << 53))

    for doc in ids:
        own = [score(doc, s, w) for s, w in enumerate(weights)]
        best = max(range(len(weights)), key=lambda s: (own[s], s))
        grown = len(weights) if score(doc, len(weights), 1.5) > own[best] else best
        assert (got[doc]["shard"], got[doc]["grown_shard"]) == (best, grown)


def test_weights(spark):
    many = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    n = {r["shard"]: r["count"] for r in sharding.shard(many, shards=2, weights=[1.0, 3.0]).groupBy("shard").count().collect()}
    assert abs(n[1] / 20_000 - 0.75) < 0.02


def test_secrets(docs, corpus):
    got = by_id(secret_scan.find_secrets(docs))
    for doc, text, *_ in corpus:
        *counts, digest, spans = brute.secrets(text)
        r = got[doc]
        assert [r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]] == [*counts, digest]
        assert set(spans.split(",")) - {""} <= set(r["spans"].split(","))


def test_copied_examples_add_no_span(spark):
    token = "aB3dE5fG7hJ9kL1mN2pQ4rS6tU8"
    text = f"see {token} here"
    rows = [(i, text, None, f"repo{i}", 0) for i in range(4)] + [(9, f"mine {token[::-1]} only", None, "repo0", 0)]
    got = by_id(secret_scan.find_secrets(spark.createDataFrame(rows, SCHEMA)))
    assert got[0]["spans"] == "" and got[9]["spans"].startswith("entropy:5:")


def secrets_brute(rows):
    """spans, n_live, n_example of every (id, text, source): tokens cut and judged one by one, values counted in dictionaries."""
    values, each = {}, {}
    chars = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")
    for doc, text, source in rows:
        text = text or ""
        _, _, _, _, base = brute.secrets(text)
        spans = [(int(s), ("assign", "access", "hex").index(k), int(e)) for k, s, e in (x.split(":") for x in base.split(",") if x)]
        found = [(s, k, e, brute.ASSIGN.match(text, s)[2] if k == 0 else text[s:e]) for s, k, e in spans]
        at = 0
        while at < len(text):
            end = at
            while end < len(text) and text[end] in chars:
                end += 1
            token = text[at:end]
            shares = [token.count(c) / len(token) for c in set(token)]
            if len(token) >= 20 and any(c.isdigit() for c in token) and token.lower() != token != token.upper() and -sum(p * math.log2(p) for p in shares) >= 3.5:
                if not any(s < end and at < e for s, _, e in spans):
                    found.append((at, 3, end, token))
            at = max(end, at + 1)
        each[doc] = sorted(found)
        for *_, value in found:
            repos, owners = values.setdefault(value, (set(), set()))
            repos.add(source or ""), owners.add(doc)
    out = {}
    for doc, found in each.items():
        example = {v: len(values[v][0]) >= 3 or len(values[v][1]) >= 20 for *_, v in found}
        told = [x for x in found if x[1] < 3 or not example[x[3]]]
        out[doc] = (",".join(f"{secret_scan.KINDS[k]}:{s}:{e}" for s, k, e, _ in told), sum(not example[x[3]] for x in told), sum(example[x[3]] for x in told))
    return out


@pytest.mark.parametrize("hot", [1, 3, 1000])
def test_added_spans_are_those_of_a_plain_count(spark, monkeypatch, hot):
    """Tokens that few or many hold, beside and inside base spans, one of them in a third of all rows; broadcast or shuffled."""
    monkeypatch.setattr(secret_scan, "HOT", hot)
    r = random.Random(5)
    token = lambda: "".join(r.choices("abcdefXYZ0123456789+/_=-", k=r.randint(15, 40)))
    shared, rows = [token() for _ in range(30)], []
    for i in range(150):
        parts = [r.choice(("x", "password=" + token(), "AKIA" + "Q7" * 10, "0a" * 14, token(), shared[int(30 * r.random() ** 3)])) for _ in range(r.randint(0, 12))]
        rows.append((i, " ".join(parts + (["Zz9" * 8 + "abcdEFGH123"] if i % 3 == 0 else [])), f"s{r.randint(0, 6)}" if i % 9 else None))
    rows += [(200, None, "s1"), (201, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {x["doc_id"]: (x["spans"], x["n_live"], x["n_example"]) for x in secret_scan.find_secrets(df).collect()}
    assert got == secrets_brute(rows)
    assert any("entropy" in v[0] for v in got.values()) and sum(v[2] for v in got.values()) > 0


def test_quality(docs, corpus):
    got = by_id(quality.judge(docs))
    for doc, text, *_ in corpus:
        r = got[doc]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == brute.quality(text), text
        assert (r["kept"], r["clean_text"]) == brute.kept(text), text


def test_quality_keeps_prose_and_drops_tables(spark):
    r = random.Random(3)
    clean = "\n".join(prose(r, 20) + "." for _ in range(6))
    menu = "\n".join(" | ".join(prose(r, 1) for _ in range(10)) for _ in range(10))
    got = by_id(quality.judge(spark.createDataFrame([(1, clean, "", "", 0), (2, menu, "", "", 0), (3, clean + "\nAll rights reserved.", "", "", 0)], SCHEMA)))
    assert [got[k]["kept"] for k in (1, 2, 3)] == [True, False, True]
    assert got[3]["clean_text"] == clean


def test_lines_with_blanks_at_their_end(spark):
    r = random.Random(8)
    make = lambda: r.choice([prose(r, 20) + "." + " " * r.randint(0, 30), prose(r, 8), "READ THIS NOW OR NEVER AGAIN.", "a | b | c.", "Read more. Sign in.", prose(r, 60) + " and click here for it.", "#1 *2 $3.", " \t ", "„" + prose(r, 9) + "”\r"])
    rows = [(i, "\n".join(make() for _ in range(r.randint(1, 12))), "", "", 0) for i in range(150)]
    rows += [(500, prose(r, 25_000) + ".", "", "", 0), (501, "\n".join(["One and the same line of prose stands here again."] * 3000), "", "", 0)]
    got = by_id(quality.judge(spark.createDataFrame(rows, SCHEMA)))
    assert {i: (got[i]["kept"], got[i]["clean_text"]) for i, *_ in rows} == {i: brute.kept(t) for i, t, *_ in rows}
    assert 20 < sum(x["kept"] for x in got.values()) < 130


def line_rows(df):
    out = df.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("h"))
    return sorted(tuple(r) for r in out.collect())


def test_lines(docs, corpus):
    assert line_rows(line_dedup.dedup_lines(docs)) == sorted(brute.line_dedup([c[:2] for c in corpus]))


def test_lines_in_batches_and_back(spark, docs, corpus):
    index = line_dedup.LineIndex.empty(spark).insert(docs.where("doc_id % 3 = 0")).insert(docs.where("doc_id % 3 = 1")).insert(docs.where("doc_id % 3 = 2"))
    assert line_rows(line_dedup.clean(docs, index.to_drop())) == sorted(brute.line_dedup([c[:2] for c in corpus]))
    gone = [c for c in corpus if c[0] % 4 != 1]
    less = index.delete(docs.where("doc_id % 4 = 1").select("doc_id"))
    rest = docs.where("doc_id % 4 <> 1")
    assert line_rows(line_dedup.clean(rest, less.to_drop())) == sorted(brute.line_dedup([c[:2] for c in gone]))
    back = less.insert(docs.where("doc_id % 4 = 1"))
    assert line_rows(line_dedup.clean(docs, back.to_drop())) == sorted(brute.line_dedup([c[:2] for c in corpus]))


def test_lines_of_growing_batches(spark, monkeypatch):
    """Small first batches, then larger ones, repeats, and deletions: filters overflow and shards are dealt anew."""
    monkeypatch.setattr(line_dedup, "KEYS_PER_SHARD", 100)
    line = lambda k: f"line number {k:06d} of a text that is long enough"
    rows, batches = [], []
    for n in (3, 30, 300, 300, 20, 300):
        at = len(rows)
        rows += [(at + i, "\n".join(line(k) for k in range(i, n, 4)), "", "", 0) for i in range(4)]
        batches.append(rows[at:])
    index = line_dedup.LineIndex.empty(spark)
    for batch in batches:
        index = index.insert(spark.createDataFrame(batch, SCHEMA))
        held = index.counts.collect()
        assert len(held) == len({bytes(r["key"]) for r in held}) == index.n_keys
        for f in index.filters.collect():
            own = [bytes(r["key"]) for r in index.counts.select(index._shard(index.shards), "key").where(F.col("shard") == f["shard"]).collect()]
            table = np.frombuffer(f["cuckoo"], np.uint16).reshape(-1, 4)
            assert line_dedup.Cuckoo(f["buckets"], table).contains(line_dedup.Cuckoo.words(own)).all() and (table != 0).sum() == len(own)
    docs = spark.createDataFrame(rows, SCHEMA)
    want = sorted(brute.line_dedup([x[:2] for x in rows], 3))
    assert line_rows(line_dedup.clean(docs, index.to_drop(3))) == want and sum(x[2] for x in want) > 100
    less = index.delete(docs.where("doc_id < 16").select("doc_id"))
    rest = [x for x in rows if x[0] >= 16]
    assert line_rows(line_dedup.clean(docs.where("doc_id >= 16"), less.to_drop(2))) == sorted(brute.line_dedup([x[:2] for x in rest], 2))
    back = less.insert(docs.where("doc_id < 16"))
    assert line_rows(line_dedup.clean(docs, back.to_drop(3))) == want


def test_lines_beside_columns_of_the_same_names(spark):
    rows = spark.createDataFrame([(1, "a\nb", 7, 8)], "doc_id long, text string, n_lines int, n_dropped int")
    assert [r.asDict() for r in line_dedup.dedup_lines(rows).collect()] == [{"doc_id": 1, "text": "a\nb", "n_lines": 2, "n_dropped": 0}]


def test_cuckoo():
    keys = np.random.default_rng(1).integers(0, 1 << 63, (20_000, 2), np.uint64) * np.uint64(2)
    f = line_dedup.Cuckoo.for_keys(len(keys))
    assert f.add(keys) and f.contains(keys).all()
    other = np.random.default_rng(2).integers(0, 1 << 63, (20_000, 2), np.uint64)
    assert f.contains(other).mean() < 0.01
    f.remove(keys[:500])
    assert f.contains(keys[500:]).all() and f.contains(keys[:500]).mean() < 0.05


def test_near_duplicates(docs, corpus):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_duplicates(docs).collect()}
    assert got == brute.components([c[:2] for c in corpus])


@pytest.mark.parametrize("edits", [1, 4])
def test_a_group_of_near_copies(spark, monkeypatch, edits):
    """Chains and stars of copies in one bucket, larger than a block."""
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    r = random.Random(edits)
    copies = [prose(r, 150).split()]
    for _ in range(70):
        own = list(r.choice(copies))
        for _ in range(edits):
            own[r.randrange(len(own))] = prose(r, 1) + "x"
        copies.append(own)
    rows = [(i, " ".join(c), "", "", 0) for i, c in enumerate(copies)]
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in near_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == brute.components([x[:2] for x in rows])


def test_sketches_merge_and_estimate():
    h = np.unique(np.random.default_rng(5).integers(0, 1 << 63, 4000, np.uint64))
    a, b = h[:3000], h[1000:]
    s = near_dedup.sketches([a, b, np.union1d(a, b)])
    assert (np.maximum(s[0], s[1]) == s[2]).all()
    e = near_dedup.estimates((s[0] > s[1]).sum()[None], (s[0] < s[1]).sum()[None], np.array([3000.0]), np.array([3000.0]))
    assert abs(e[0] - 0.5) < 0.2


def passage_rows(df):
    return sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["h"]) for r in df.withColumn("h", F.sha2("kept", 256)).collect())


def test_passages(docs, corpus):
    assert passage_rows(suffix_dedup.dedup_passages(docs)) == sorted(brute.suffix_dedup([c[:2] for c in corpus]))


def test_passages_in_batches_and_large_groups(docs, corpus):
    index = suffix_dedup.SuffixIndex.empty(120, 30, group=2)
    for k in range(5):
        index = index.add(docs.where(f"doc_id % 5 = {k}"))
    assert len(index.levels) <= 3
    assert passage_rows(index.cut(docs)) == sorted(brute.suffix_dedup([c[:2] for c in corpus], 120))


def test_parts_of_a_long_text(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PART", 1000)
    raw = random.Random(1).randbytes(20_000)
    found = suffix_dedup.anchors_of(raw, 100, 30)
    served = np.concatenate([np.arange(lo, hi + 1) for _, lo, hi, *_ in found])
    assert sorted(served) == list(range(len(raw) - 99))


def test_distances_at_which_windows_repeat():
    r = random.Random(11)
    for _ in range(60):
        k, length = r.choice([2, 3, 5, 12]), 20
        raws = ["".join(r.choice("ab") for _ in range(14)) + "anchored" + "".join(r.choice("ab") for _ in range(14)) for _ in range(k)]
        if r.random() < 0.7:
            raws[1] = raws[0][: r.randint(0, 20)] + raws[1][-14:] if r.random() < 0.3 else raws[1][:10] + raws[0][10:26] + raws[1][26:]
        cut = [(raw.index("anchored"), raw) for raw in raws if "anchored" in raw and len(raw) > raw.index("anchored") + length]
        ends = [(raw[max(0, x - r.randint(0, 12)) : x].encode(), raw[x : x + length - r.randint(0, 4)].encode()) for x, raw in cut]
        if len(ends) < 2:
            continue
        windows = {}
        for i, (before, behind) in enumerate(ends):
            for d in range(len(before) + 1):
                if len(behind) >= length - d:
                    windows.setdefault((d, (before[len(before) - d :] + behind)[:length]), []).append(i)
        want = {(i, d) for (d, _), own in windows.items() if len(own) > 1 for i in own}
        got = {(i, d) for i, a, z in suffix_dedup.repeated_distances([e[0] for e in ends], [e[1] for e in ends], length) for d in range(a, z + 1)}
        assert got == want


def test_a_text_of_one_letter(spark):
    rows = [(1, "a" * 2_000_000, "", "", 0), (2, "b" + "a" * 400 + "c", "", "", 0), (3, "a" * 399, "", "", 0), (4, "xyz" * 300, "", "", 0)]
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in suffix_dedup.dedup_passages(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: (2_000_000, 2_000_000, 1, b""), 2: (402, 400, 1, b"bc"), 3: (399, 0, 0, b"a" * 399), 4: (900, 900, 1, b"")}


@pytest.mark.parametrize("size", [399, 400, 460])
def test_a_passage_of_over_50_words(spark, size):
    """Of passages that repeat across documents those of 400 bytes go, however many words they have."""
    r = random.Random(size)
    passage = prose(r, 90)[: size - 1] + "z"
    assert len(passage) == size and len(passage.split()) > 50
    # Nothing beside the passage is alike, not even the letter before or behind it.
    rows = [(i, f"{prose(r, 60)} {a}{passage}{b} {prose(r, 60)}", "", "", 0) for i, (a, b) in enumerate(zip("ABC", "DEF"))] + [(9, prose(r, 300), "", "", 0)]
    got = {x["doc_id"]: (x["n_removed"], x["n_spans"], bytes(x["kept"]).decode()) for x in suffix_dedup.dedup_passages(spark.createDataFrame(rows, SCHEMA)).collect()}
    cut = size >= 400
    assert got == {i: (size * cut * (i != 9), int(cut and i != 9), t.replace(passage, "") if cut else t) for i, t, *_ in rows}


def test_decontamination(spark):
    r = random.Random(4)
    item = "On friday the farmer Anna sold 12 kg of apples to her neighbour Boris and then walked 3 km home with Anna"
    other = item.replace("Anna", "Clara").replace("Boris", "David").replace("12 kg", "9 kg").replace("3 km", "5 km")
    mixed = item.replace("friday the farmer Anna", "friday the farmer Clara").replace("Boris", "David")
    plain = prose(r, 300)
    rows = [(1, plain + " " + item, "", "", 0), (2, other + ", " + plain, "", "", 0), (3, plain, "", "", 0), (4, None, "", "", 0), (5, "", "", "", 0), (6, "one short item", "", "", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    items = spark.createDataFrame([(10, item), (11, None), (12, "one short item here now"), (13, "a b")], "item_id long, text string")
    got = sorted((x["doc_id"], x["item_id"]) for x in decontamination.hits(docs, items).collect())
    assert got == [(1, 10), (2, 10)], mixed
    assert sorted(x["doc_id"] for x in decontamination.without_hits(docs, items).collect()) == [3, 4, 5, 6]
    assert decontamination.hits(docs, items.limit(0)).count() == 0


def test_inconsistent_slots_are_no_hit(spark):
    names = ["Anna", "Bert", "Carl", "Dora", "Emil", "Fred"]
    item = ", ".join("then came Anna with bread and salt again" for _ in names)
    scattered = ", ".join(f"then came {n} with bread and salt again" for n in names)
    docs = spark.createDataFrame([(1, item, "", "", 0), (2, scattered, "", "", 0)], SCHEMA)
    items = spark.createDataFrame([(10, item)], "item_id long, text string")
    assert [x["doc_id"] for x in decontamination.hits(docs, items).collect()] == [1]


def test_several_occurrences_in_one_document(spark):
    item = "On friday the farmer Anna sold 12 kg of apples to her neighbour Boris and then walked 3 km home with Anna"
    other = item.replace("Anna", "Clara").replace("Boris", "David").replace("12 kg", "9 kg").replace("3 km", "5 km")
    third = item.replace("Anna", "Emil").replace("Boris", "Fred").replace("12 kg", "7 kg").replace("3 km", "8 km")
    docs = spark.createDataFrame([(1, ". ".join([item, other, third]), "", "", 0), (2, f"{item}. {other}", "", "", 0), (3, f"{other} {third}", "", "", 0)], SCHEMA)
    items = spark.createDataFrame([(10, item), (11, other)], "item_id long, text string")
    got = sorted((x["doc_id"], x["item_id"], x["class_id"], x["verbatim"]) for x in decontamination.hits(docs, items).collect())
    assert got == [(1, 10, 10, [10, 11]), (2, 10, 10, [10, 11]), (3, 11, 10, [11])]
    assert decontamination.without_hits(docs, items).count() == 0


def test_three_hundred_items_of_one_template(spark):
    """One hit for the template: a copy names its item, other numbers none; values that become one are no hit; other relations are another class."""
    item = lambda a, b, c, d: f"a farmer who keeps {a} hens and {b} ducks and sells {c} eggs and {d} loaves every morning at the market"
    items = [(k, item(1000 + k, 3000 + k, 5000 + k, 7000 + k)) for k in range(300)] + [(300, item(77, 77, 78, 79))]
    rows = [(1, item(9, 8, 7, 6)), (2, item(1042, 3042, 5042, 7042)), (3, item(6, 6, 6, 6)), (4, item(5, 5, 4, 3)), (5, item(1042, 3043, 5042, 7042)), (6, item(77, 77, 78, 79))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((x["doc_id"], x["class_id"], x["item_id"], x["verbatim"]) for x in decontamination.hits(docs, spark.createDataFrame(items, "item_id long, text string")).collect())
    assert [x for x in got if x[1] == 0] == [(1, 0, 0, []), (2, 0, 42, [42]), (4, 0, 0, []), (5, 0, 0, []), (6, 0, 0, [])]
    assert [x for x in got if x[1] == 300 and x[0] in (4, 6)] == [(4, 300, 300, []), (6, 300, 300, [300])] and len(got) == 11


def test_copies_of_items_full_of_slots(spark):
    table = "12 kg 15 kg 18 kg 21 kg 33 kg 36 kg 39 kg 41 kg total 215 kg"
    sums = "17 plus 25 is 42 and 18 plus 36 is 54 and 11 plus 19 is 30"
    names = "we met Anna, Boris, Clara, David, Emil, Fred, Gerd, Hans, Ines"
    r = random.Random(5)
    rows = [(k, f"{prose(r, 60)} {t} {prose(r, 60)}", "", "", 0) for k, t in enumerate([table, sums, names, table.replace("1", "4"), names.replace("a", "e").replace("e", "i")])]
    items = spark.createDataFrame([(0, table), (1, sums), (2, names)], "item_id long, text string")
    assert sorted((x["doc_id"], x["item_id"]) for x in decontamination.hits(spark.createDataFrame(rows, SCHEMA), items).collect()) == [(0, 0), (1, 1), (2, 2)]


def test_language(spark):
    r = random.Random(2)
    parts = {"en": ["th", "er", "on", "an"], "de": ["sch", "ein", "ung", "ü"]}
    make = lambda lang, n: " ".join("".join(r.choice(parts[lang]) for _ in range(r.randint(1, 4))) for _ in range(n))
    rows = [(i, make(lang := ("en", "de")[i % 2], r.randint(3, 60)), lang, "s", 0) for i in range(400)] + [(900, None, "en", "s", 0), (901, "123 ...", "de", "s", 0), (902, "語" * 300, None, "s", 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = by_id(language_id.identify(df, df.where("doc_id % 4 <> 2")))
    assert sum(got[i]["lang_pred"] == ("en", "de")[i % 2] for i in range(400)) >= 396
    assert got[900]["lang_pred"] == got[901]["lang_pred"] == "und" and got[901]["score"] == 0
    assert got[902]["rejected"] and not any(got[i]["rejected"] for i in range(400))
    assert all(0 <= x["score"] <= 1 for x in got.values())
    kept = language_id.keep_identified(df, df)
    assert kept.columns == df.columns and kept.count() == 400
    none = by_id(language_id.identify(df, df.limit(0)))
    assert {x["lang_pred"] for x in none.values()} == {"und"}


def test_languages_in_several_parts(spark):
    r = random.Random(3)
    parts = {"en": ["th", "er", "on", "an"], "de": ["sch", "ein", "ung", "ü"], "fr": ["eau", "ais", "é", "ou"]}
    make = lambda lang, n: " ".join("".join(r.choice(parts[lang]) for _ in range(r.randint(1, 4))) for _ in range(n))
    rows = [(i, make(lang := ("en", "de", "fr")[i % 3], r.randint(3, 60)), lang, "s", 0) for i in range(150)] + [(900, None, "en", "s", 0), (901, "12", "de", "s", 0)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("told", F.lit(1)).withColumn("row", F.lit(2)).withColumn("_judged", F.lit(3))
    one = language_id.fit(df.select("text", "lang"))
    three = language_id.fit(df.select("text", "lang"), languages=1)
    assert (len(one.parts), len(three.parts)) == (1, 3) and one.limits == pytest.approx(three.limits)
    a, b = (sorted(m.told(df, "text", "x").select("doc_id", "x.*").collect(), key=lambda x: x["doc_id"]) for m in (one, three))
    for x, y in zip(a, b, strict=True):
        assert (x["lang_pred"], x["rejected"], x["n"]) == (y["lang_pred"], y["rejected"], y["n"]) and x["score"] == pytest.approx(y["score"])
    kept = language_id.keep_identified(df, df)
    assert kept.columns == df.columns and kept.count() == 150


def test_a_language_of_copies_is_learnt(spark):
    """All rows of a language fall into the fold that calibrates."""
    df = spark.createDataFrame([(k,) for k in range(200)], "k int").select(F.concat(F.lit("eins zwei drei vier "), F.col("k").cast("string")).alias("text")).where(F.pmod(F.xxhash64("text", F.lit(8)), F.lit(8)) == 0).limit(1)
    text = df.first()["text"]
    rows = spark.createDataFrame([(text, "de")] * 5 + [(f"one two three four {'abcdefgh'[k % 8]} {k}", "en") for k in range(40)], "text string, lang string")
    assert language_id.fit(rows).langs == ["de", "en"]


def test_kneser_ney_by_hand(spark):
    """Cross-entropies of whole texts against dictionaries of counts, short and long texts, ties of counts."""
    r = random.Random(12)
    rows = [(prose(r, r.randint(1, 40)), "aa") for _ in range(60)] + [(prose(r, r.randint(1, 40)).translate(str.maketrans("tnd", "kzü")), "bb") for _ in range(60)]
    df = spark.createDataFrame(rows, "text string, lang string")
    fold = {x["text"] for x in df.where(F.pmod(F.xxhash64("text", F.lit(8)), F.lit(language_id.CALIBRATION_FOLD)) == 0).collect()}
    models = {lang: brute.KneserNey([t for t, own in rows if own == lang and t not in fold]) for lang in ("aa", "bb")}
    letters = len(set().union(*(m.letters for m in models.values())))
    tests = [rows[0][0], rows[70][0], "q", "zzz then", "Then THE end. 12 " * 40, "x" * 600_000]
    made = language_id.fit(df)
    got = made.told(spark.createDataFrame([(i, t) for i, t in enumerate(tests)], "i int, text string"), "text", "x").orderBy("i").collect()
    for row, text in zip(got, tests):
        nats = {lang: m.nats(text, letters) for lang, m in models.items()}
        n = len(brute.letters_of(text))
        assert row["x"]["n"] == n and row["x"]["cross_entropy"] == pytest.approx(min(nats.values()) / n, rel=1e-4)
        assert row["x"]["lang_pred"] == min(nats, key=lambda k: (nats[k], k))


def test_all_rows_of_the_fold_calibrate(spark):
    """More rows than any sample: the limits are quantiles of all of them, however rare the odd ones are."""
    values = np.array([1.0, 1.5, 2.0, 9.0])
    n = np.array([30_000, 20_000, 10_000, 40])
    for q in (0.0, 0.5, 0.9, 0.9995, 1.0):
        assert language_id.counted_quantile(values, n, q) == pytest.approx(np.quantile(np.repeat(values, n), q))
    r = random.Random(6)
    rows = [(prose(r, r.randint(3, 30)), "aa") for _ in range(600)]
    df = spark.createDataFrame(rows, "text string, lang string")
    made = language_id.fit(df)
    fold = df.where(F.pmod(F.xxhash64("text", F.lit(8)), F.lit(language_id.CALIBRATION_FOLD)) == 0)
    seen = made.told(fold, "text", "x").select("x.cross_entropy", "x.n").toPandas()
    own_class = np.floor(np.log2(seen["n"]))
    k = int(own_class.mode()[0])
    own = seen["cross_entropy"][np.abs(own_class - k) <= 1]
    limit = own.median() + language_id.SPREAD * (own.quantile(language_id.QUANTILE) - own.median())
    assert len(own) >= 20 and made.limits[k] >= limit - 0.01
    import inspect

    assert "sample" not in inspect.signature(language_id.identify).parameters


def test_language_models_sum_to_one():
    text = language_id.normal("the then there them than that " * 20)
    n, grams = language_id.counted_grams(*next(language_id.blocks([text])))
    letters = sorted({chr(c) for c in text})
    model = language_id.Model.fit(["en"], np.zeros(len(n), int), grams, n, len(letters))
    for context in (" the", "then", "zzzz"):
        p = [np.exp(model.log_probabilities(np.array([ord(c) for c in context + x], np.uint64))[0, 0]) for x in letters]
        assert 0.85 < sum(p) <= 1.001


def segments_brute(scores):
    """Maximal segments by their definition: the best segment, then both sides of it."""
    best = None
    for a in range(len(scores)):
        total = 0.0
        for b in range(a, len(scores)):
            total += scores[b]
            if total > 0 and (best is None or total > best[2] + 1e-9 or abs(total - best[2]) <= 1e-9 and b - a < best[1] - best[0] - 1):
                best = (a, b + 1, total)
    if best is None:
        return []
    a, b, s = best
    left = segments_brute(scores[:a])
    right = [(x + b, y + b, t) for x, y, t in segments_brute(scores[b:])]
    return [*left, (a, b, s), *right]


def test_maximal_segments():
    r = random.Random(9)
    for _ in range(200):
        scores = [r.choice([-3.1, -1.7, -0.9, 1.3, 2.2, 4.05]) + r.random() / 100 for _ in range(r.randint(0, 14))]
        got = [(a, b, round(s, 6)) for a, b, s in toxicity.maximal_segments(scores)]
        assert got == [(a, b, round(s, 6)) for a, b, s in segments_brute(scores)]


def test_segments_of_many_scores_in_linear_time():
    import time

    took = {}
    for n in (20_000, 200_000):
        scores = [1.0 if i % 2 == 0 else -0.9 - (i % 7) / 1000 for i in range(n)] + [1.0, -1.2] * n
        began = time.perf_counter()
        toxicity.maximal_segments(scores)
        took[n] = time.perf_counter() - began
    assert took[200_000] < 40 * took[20_000] + 0.5


def test_passages_are_the_significant_segments():
    m = toxicity.Model({"bad": 3.0, "worse": 5.0}, rate=1.0, size=0.1, link=(-3.0, 1.0, 0.5))
    score, told = m.judge("fine " * 30 + "bad " + "fine " * 60 + "worse worse worse " + "fine " * 200 + "bad bad bad bad")
    assert [(a, b) for a, b, _ in told] == [(91, 94), (294, 298)] and score > 0.9
    assert m.judge("fine bad fine")[1] == [] and m.judge("")[1] == []


def test_toxicity(spark):
    r = random.Random(6)
    bad = ["scumlike", "scumly", "idiotic", "moronish"]
    rows, labels = [], []
    for i in range(600):
        words = prose(r, r.randint(20, 80)).split()
        toxic = i % 5 == 0
        for _ in range(4 * toxic):
            words.insert(r.randrange(len(words)), r.choice(bad))
        rows.append((i, " ".join(words), "en", "s", 0))
        labels.append((i, 1, int(toxic)))
    rows += [(900, None, "", "", 0), (901, "", "", "", 0)]
    df, lab = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = by_id(toxicity.score_documents(df, df.where("doc_id % 4 <> 2"), lab))
    right = sum((got[i]["score"] >= 0.3) == (i % 5 == 0) for i in range(2, 600, 4))
    assert right >= 145
    assert got[900]["score"] == got[901]["score"] < 0.3
    assert toxicity.fit(df, lab.limit(0)).link is None


def test_odd_tables(spark, odd, empty):
    n = odd.count()
    assert packing.pack(odd).count() == n and packing.pack(empty).count() == 0
    assert sharding.shard(odd).count() == n and sharding.shard(empty).count() == 0
    assert secret_scan.find_secrets(odd).count() == n and secret_scan.find_secrets(empty).count() == 0
    assert quality.judge(odd).count() == n and quality.judge(empty).count() == 0
    lines = line_dedup.dedup_lines(odd)
    assert lines.count() == n and lines.columns == [*odd.columns, "n_lines", "n_dropped"] and line_dedup.dedup_lines(empty).count() == 0
    near = near_dedup.near_duplicates(odd).collect()
    assert sorted((r["doc_id"] is None, r["component_id"]) for r in near if r["doc_id"] == 5) == [(False, 5)] * 2 and len(near) == n
    assert near_dedup.near_duplicates(empty).count() == 0 and near_dedup.keep_first(odd).columns == odd.columns
    assert suffix_dedup.dedup_passages(odd).count() == n and suffix_dedup.dedup_passages(empty).count() == 0
    items = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    assert decontamination.without_hits(odd, items).count() == n - 2 and decontamination.hits(empty, items).count() == 0
    assert language_id.identify(odd, odd).count() == n and language_id.identify(empty, odd).count() == 0
    lab = spark.createDataFrame([(5, 1, None), (6, 1, 1)], "doc_id long, quality int, toxic int")
    assert toxicity.score_documents(odd, odd, lab).count() == n and toxicity.score_documents(empty, empty, lab).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no tables")
def test_decontamination_is_that_of_plain_windows(spark):
    read = lambda name: spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
    items = [(r["item_id"], r["text"]) for r in read("benchmark").collect()]
    items += [(9000 + k, f"The coach leaves Bern at {k}:15 with {40 + k} people and arrives after {k + 2} hours in Rome with 12 of them") for k in range(10, 14)]
    items += [(9001, "The train leaves Bern at 9:15 with 40 people and arrives after 3 hours in Rome with 12 of them"), (9002, "3 kg 4 kg 5 kg 6 kg 7 kg"), (9003, "so few words 7"), (9004, "")]
    docs = [(r["doc_id"], r["text"]) for r in read("documents").collect()]
    r, n = random.Random(5), 10_000
    for _, text in items:
        words = text.split()
        shift = "".join(str((int(c) + 3) % 10) if c.isdigit() else c for c in text)
        loose = "".join(str(r.randrange(10)) if c.isdigit() else c for c in text)
        put = words[: len(words) // 2] + ["indeed"] + words[len(words) // 2 :]
        for made in (text, shift, loose, f"Well, {text} and again {shift}", " ".join(put), " ".join(words[: len(words) // 2]), text.upper(), " ".join(reversed(words))):
            docs.append((n, made))
            n += 1
    docs.append((n, None))
    marks = (decontamination.NUMBER, decontamination.UNIT, decontamination.NAME)
    want = brute.decontamination(docs, items, decontamination.UNITS, marks)
    hits = decontamination.hits(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = {(x["doc_id"], x["class_id"]): (x["matched"], x["total"], x["agreement"], x["verbatim"]) for x in hits.collect()}
    assert set(got) == set(want) and len(want) > len(items)
    assert all(got[k][:2] == want[k][:2] and abs(got[k][2] - want[k][2]) < 1e-9 and got[k][3] == want[k][3] for k in want)
