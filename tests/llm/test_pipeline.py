"""Every stage of the pipeline against a plain version, on what the stage before kept."""

import random

import pytest

import corpus_pipeline
from lectern.llm import language_id
from lectern.llm._store import in_training, staged

from . import brute
from .test_operators import prose

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_lines int, n_dropped int, told string, row int, kept_id int"
NAMES = [name for name, _ in corpus_pipeline.STAGES]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """sf_dir, and the rows before and after each stage."""
    r = random.Random(21)
    texts = [prose(r, r.randint(30, 120)) for _ in range(420)]
    line = "This line stands in far more of the documents than it should, ümläut included."
    item = "On friday the farmer Anna sold 12 kg of apples to her neighbour Boris and then walked 3 km home with Anna"
    texts += [f"{t}\n{line}" for t in texts[:9]] + [line, line, None, "", "123 456", "語" * 200, texts[20], texts[21] + " tail", prose(r, 80) + " " + item + " " + prose(r, 80), prose(r, 9000)]
    rows = [(i, t, None if t and t[0] == "語" else "en", f"s{i % 3}", None if t is None else len(t), 1, 2, "x", 3, 4) for i, t in enumerate(texts)] + [(None, prose(r, 50), None, None, None, 1, 2, "x", 3, 4)]
    rows.append(rows[30])
    where = f"file://{tmp_path_factory.mktemp('pipe')}"
    docs = spark.createDataFrame(rows, SCHEMA)
    docs.write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{where}/benchmark.parquet")
    out, docs = {}, spark.read.parquet(f"{where}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        after = staged(stage(spark, docs, where), "stage")
        out[name] = (docs, after)
        docs = after
    return where, item, out


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_columns_pass_through(stages):
    for name in NAMES[:-1]:
        before, after = stages[2][name]
        assert after.columns == before.columns and after.count() > 0


def test_language(spark, stages):
    before, after = stages[2]["language ID"]
    told = language_id.fit(before.where(in_training(before["doc_id"])).select("text", "lang")).told(before.select("doc_id", "text"), "text", "x").collect()
    limits = language_id.fit(before.where(in_training(before["doc_id"])).select("text", "lang")).limits
    keep = {r["text"] for r in told if r["x"]["n"] and r["x"]["cross_entropy"] <= limits[min(12, r["x"]["n"].bit_length() - 1)]}
    assert rows_of(after) == sorted((tuple(r) for r in before.collect() if r["text"] in keep), key=repr)
    gone = {r["text"] for r in before.collect()} - keep
    assert {None, "", "123 456", "語" * 200} <= gone and len(gone) <= 6


def test_lines(stages):
    before, after = stages[2]["line dedup"]
    rows = [tuple(r) for r in before.collect()]
    want = []
    for r, cut in zip(rows, brute.line_texts([(-(1 << 63) if r[0] is None else r[0], r[1]) for r in rows])):
        if cut == r[1]:
            want.append(r)
        elif brute.WORD.search(cut):
            want.append((r[0], cut, r[2], r[3], len(cut), *r[5:]))
    assert rows_of(after) == sorted(want, key=repr) and want != rows


def test_near_duplicates(stages):
    before, after = stages[2]["near dedup"]
    rows = [tuple(r) for r in before.collect()]
    of = brute.components([r[:2] for r in rows if r[0] is not None], 80)
    assert rows_of(after) == sorted((r for r in rows if r[0] is None or of[r[0]][1] == r[0]), key=repr)
    assert len(after.collect()) < len(rows)


def test_decontamination(stages):
    before, after = stages[2]["decontamination"]
    rows = [tuple(r) for r in before.collect()]
    assert rows_of(after) == sorted((r for r in rows if stages[1] not in r[1]), key=repr) and any(stages[1] in r[1] for r in rows)


def test_packing(stages):
    before, after = stages[2]["packing"]
    texts = {r["doc_id"]: r["text"] for r in before.collect()}
    pieces, places = {}, {}
    for r in after.collect():
        pieces.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(pieces) == set(texts)
    for doc, own in pieces.items():
        assert sorted(set(own)) == brute.pieces(texts[doc])
    for own in places.values():
        own.sort()
        assert [o for o, _ in own] == [sum(l for _, l in own[:k]) for k in range(len(own))] and sum(l for _, l in own) <= 4096


def test_empty_table(spark, stages, tmp_path):
    where = f"file://{tmp_path}"
    spark.createDataFrame([], SCHEMA).write.parquet(f"{where}/documents.parquet")
    spark.read.parquet(f"{stages[0]}/benchmark.parquet").write.parquet(f"{where}/benchmark.parquet")
    assert corpus_pipeline.run(spark, where).count() == 0
