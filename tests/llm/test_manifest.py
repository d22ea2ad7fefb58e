"""The Merkle manifest against a tree built row by row."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from lectern.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
H = lambda parts: hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r, more=0):
    n = None if r["n_chars"] is None else r["n_chars"] + more
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return H([part(r["doc_id"]), part(r["source"]), part(r["lang"]), part(n), part(r["text"])])


def plain_tree(nodes, f):
    """Root, and for each node its siblings and (place, run) on the way."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(levels[-1][k : k + f]) for k in range(0, len(levels[-1]), f)])
    proofs = []
    for i in range(len(nodes)):
        proof, path = [], []
        for level in levels[:-1]:
            run = level[i - i % f : i - i % f + f]
            proof += run[: i % f] + run[i % f + 1 :]
            path.append((i % f, len(run) - 1))
            i //= f
        proofs.append((proof, path))
    return levels[-1][0], proofs


def plain(rows, f=2):
    """(doc_id, leaf, subroot, root, proof, folded_root, verified) of all rows."""
    langs = sorted({r["lang"] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    groups = [sorted((r for r in rows if r["lang"] == g), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r))) for g in langs]
    lower = [plain_tree([leaf(r) for r in g], f) for g in groups]
    root, upper = plain_tree([top for top, _ in lower], f)
    out = []
    for g, (top, proofs), (rest, way) in zip(groups, lower, upper):
        for r, (proof, path) in zip(g, proofs):
            bad = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            node, used, whole = leaf(r, int(bad)), 0, proof + rest
            for at, others in path + way:
                run = whole[used : used + others]
                node, used = H([*run[:at], node, *run[at:]]), used + others
            out.append((r["doc_id"], leaf(r), top, root, "".join(whole), node, node == root))
    return sorted(out, key=str)


def got(df, **how):
    tampered = F.pmod(F.crc32(F.col("own_id").cast("string").cast("binary")), F.lit(7)) == 0
    return sorted((tuple(r) for r in merkle.manifest(df, tampered=tampered, **how).collect()), key=str)


def corpus(n):
    return [(7 * k % 1009, None if k % 11 == 0 else "Grüße " * (k % 5), (None, "", "de", "en", "Ä", "z\U0001F600")[k % 17 % 6], None if k % 13 == 0 else f"s{k % 3}", None if k % 5 == 0 else k) for k in range(n)]


@pytest.mark.parametrize(("fanout", "levels"), [(2, 1), (2, 3), (3, 2), (2, 10)])
def test_manifest_is_that_of_a_plain_tree(spark, fanout, levels):
    df = spark.createDataFrame(corpus(333), SCHEMA).repartition(3)
    assert got(df, fanout=fanout, levels=levels) == plain([r.asDict() for r in df.collect()], fanout)


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_few_rows(spark, n):
    df = spark.createDataFrame(corpus(n), SCHEMA)
    assert got(df) == plain([r.asDict() for r in df.collect()])


def test_odd_tables(spark):
    rows = [(None, "no id", None, None, None), (None, "no id either", None, "s", 1), (5, "twice", "en", "s", 1), (5, "twice", "en", "s", 1), (5, "other", "en", "s", 1), (6, None, "en", None, None), (8, "x" * 3_000_000, "en", "s", 3)]
    clash = [(*r, 1, "t", b"n", 2, 3) for r in rows]
    df = spark.createDataFrame(clash, SCHEMA + ", i int, tree string, node binary, n int, own_id int")
    assert got(df) == plain([r.asDict() for r in df.collect()])
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_a_row_that_was_changed_is_the_only_one_to_fail(spark):
    df = spark.createDataFrame(corpus(100), SCHEMA).where("n_chars is not null")
    done = merkle.manifest(df, tampered=F.col("own_id") == 14)
    assert [r["doc_id"] for r in done.where("not verified").collect()] == [14]


def test_ids_that_no_float_holds(spark):
    df = spark.createDataFrame([((1 << 60) + k, "t", "en", "s", 1) for k in range(3)] + [(None, "t", "en", "s", 1)], SCHEMA)
    assert {r["doc_id"] for r in merkle.manifest(df).collect()} == {None, *((1 << 60) + k for k in range(3))}
