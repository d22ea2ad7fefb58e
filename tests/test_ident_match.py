"""Digests, sound codes, verdicts and decisions against published and hand-made values."""

import pytest
from pyspark.sql import functions as F

from lectern.functions import ident, match, small, text
from lectern.operators import consensus
from lectern.plans import texts


def fnv(data: bytes) -> int:
    h = 2166136261
    for b in data:
        h = (h ^ b) * 16777619 % 2**32
    return h


@pytest.mark.parametrize("word", ["", "a", "Zuflucht", "straße", "Öl", "ÄÖÜ"])
def test_word_digest(spark, word):
    got = spark.createDataFrame([(word,)], "w string").select(ident.word_digest(F.col("w"))).first()[0]
    raw = word.encode()
    assert got == f"{fnv(raw):08x}{fnv(bytes([1]) + raw):08x}"


def test_known_digests(spark):
    rows = spark.createDataFrame([("",), ("Zuflucht",), ("straße",), ("Öl",)], "w string").select(ident.word_digest(F.col("w"))).collect()
    assert [r[0] for r in rows] == ["811c9dc5040c5b8c", "c5c3b06e7b5a166b", "2626f8180f908bb7", "ddab0b80bf824047"]


def test_paths(spark):
    df = spark.createDataFrame([(25107, "progress", 3)], "q long, f string, s int")
    path = df.select(ident.quest_path(F.col("q"), F.col("f"), F.col("s")).alias("p"))
    assert path.first()["p"] == "sounds/q/07/25107_p3.ogg"
    bad = spark.createDataFrame([("sounds/q/../x",), ("/etc/passwd",), (None,)], "p string")
    assert path.select(ident.valid_path(F.col("p")), ident.clip_path_shape(F.col("p"))).first() == (True, True)
    assert not any(r[0] for r in bad.select(ident.valid_path(F.col("p"))).collect())


CODES = {
    "Wikipedia": "3412", "Meier": "67", "Mayr": "67", "Breschnew": "17863", "Müller-Lüdenscheidt": "65752682", "Heinz": "068", "Müller": "657", "Männer": "667", "Cent": "862", "Zent": "862",
    "Fischer": "387", "Cacao": "44", "Kakao": "44", "Blut": "152", "Phase": "38", "Axel": "0485", "Scx": "8", "Szx": "848", "Faxe": "348", "Lale": "55", "Ohm": "06", "300": "", "": "", "STRAẞE": "8278", "café": "43",
}


def test_sound_codes(spark):
    words = spark.createDataFrame([(w,) for w in CODES], "w string").select("w", match.sound_code(F.col("w")).alias("c"))
    assert {r["w"]: r["c"] for r in words.collect()} == CODES


VERDICTS = [
    ("rechten", "Rechten, Rechten", "rambled"), ("habe", "Ja, hat er.", "many"), ("Regenbogenflosse", "Regenbogen Flosse.", "ok"), ("Wort", "", "silent"), ("Wort", "Wort.", "ok"),
    ("Wort", "ein Wort", "ok-ish"), ("Wortlaut", "Wort", "clipped"), ("Haus", "Maus", "different"),
]


def test_classify(spark):
    w, h = F.col("w"), F.col("h")
    df = spark.createDataFrame([v[:2] for v in VERDICTS], "w string, h string").select("w", "h", text.normalise(w).alias("a"), text.normalise(h).alias("b"), F.transform(text.pieces(h), text.normalise).alias("p")).distinct()
    scored = df.withColumn("s", match.block_ratio(F.col("a"), F.col("b"))).withColumn("best", match.best_ratio(F.col("a"), F.col("p")))
    got = {(r["w"], r["h"]): r["v"] for r in scored.select("w", "h", match.classify(w, h, F.col("s"), F.col("best")).alias("v")).collect()}
    assert got == {v[:2]: v[2] for v in VERDICTS}


def test_a_word_heard_twice_is_rambled_and_yet_acceptable(spark):
    df = spark.createDataFrame([("rechten", "rechten rechten", 0.1)], "w string, h string, s double")
    got = df.select(match.classify(F.col("w"), F.col("h")), match.acceptable(F.col("w"), F.col("h"), F.col("s"))).first()
    assert got == ("rambled", True)


def test_similarity_depends_on_order(spark):
    df = spark.createDataFrame([("tide", "diet")], "a string, b string")
    got = df.select(match.similarity(F.col("a"), F.col("b")).alias("x"), match.similarity(F.col("b"), F.col("a")).alias("y")).first()
    assert got == (0.25, 0.5)


def test_edges_and_fillers(spark):
    rows = [("Wort", "Wortabc", None), ("Wort", "Wortabcd", "trailing"), ("Wort", "Wor", "clipped"), ("Wort", "ein Wort", "false start"), ("hat", "hat, ähm", "filler"), ("ääh", "ähm", None)]
    df = spark.createDataFrame([r[:2] for r in rows], "w string, h string")
    assert [r[0] for r in df.select(match.edge_fault(F.col("w"), F.col("h"))).collect()] == [r[2] for r in rows]


def test_spoken_case(spark):
    words = {"KRABUMMS": "Krabumms", "KI": "KI", "BFFT": "BFFT", "A-K-I-D-A": "A-K-I-D-A", "Haus": "Haus", "ÄRGER": "Ärger"}
    df = spark.createDataFrame([(w,) for w in words], "w string").select("w", match.spoken_case(F.col("w")).alias("s"))
    assert {r["w"]: r["s"] for r in df.collect()} == words


def test_agreement(spark):
    lists = [([],), (["a"],), (["ab"] * 4,), (["", ""],), (["abcd", "abce", "xyz"],)]
    got = [tuple(r["x"]) for r in spark.createDataFrame(lists, "l array<string>").select(match.agreement(F.col("l")).alias("x")).collect()]
    assert got[:4] == [(0.0, 0), (0.0, 0), (1.0, 0), (0.0, 0)]
    assert got[4][1] == 0 and 0 < got[4][0] < 1


def test_agreement_of_whole_groups(spark, monkeypatch):
    monkeypatch.setattr(consensus, "BLOCK", 4)  # several blocks a group
    groups = {"many": sorted(f"w{k % 19:02d}{'xyz'[k % 3]}{'ab' * (k % 4)}" for k in range(40)), "same": ["ab"] * 9, "one": ["a"], "empty": ["", ""], None: ["abcd", "abce", "xyz"]}
    rows = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, v string")
    got = {r["g"]: (r["agreement"], r["medoid"]) for r in consensus.group_agreement(rows, ["g"], "v").collect()}
    plain = spark.createDataFrame(list(groups.items()), "g string, l array<string>").select("g", match.agreement(F.col("l")).alias("x")).collect()
    assert {r["g"] for r in plain} == set(got)
    for r in plain:
        assert got[r["g"]] == (pytest.approx(r["x"]["agreement"]), r["x"]["medoid"])


def test_the_query_compares_all_names_of_a_group(spark, tmp_path):
    names = [f"aa{k}" for k in range(8)] + ["zzzz"] * 12
    spark.createDataFrame([("b", "t", n) for n in names], "p_brand string, p_type string, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    got = texts.sound_agreement(spark, str(tmp_path)).collect()
    want = spark.createDataFrame([(sorted(names),)], "l array<string>").select(match.agreement(F.col("l")).alias("x")).first()["x"]
    assert [(r["letters"], r["medoid"]) for r in got] == [(pytest.approx(want["agreement"]), want["medoid"])]


def test_transcripts_are_whole_and_meet_all_names(spark, tmp_path):
    said = "the road went on over the hill and down " * 12
    spark.createDataFrame([(c, 5, f"{said}{c}") for c in range(300)], "conv_id long, turn int, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    spark.createDataFrame([(k, f"name {k}") for k in range(301)], "p_partkey long, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    got = texts.classify_full(spark, str(tmp_path)).collect()
    assert sorted(r["heard"] for r in got) == sorted(f"{said}{c}" for c in range(300))
    assert len({r["want"] for r in got}) == 300


def test_small(spark):
    row = spark.range(1).select(
        small.clock(F.lit(59.0)), small.clock(F.lit(60.2)), small.version_newer(F.lit("2.10.0"), F.lit("2.9.0")), small.version_newer(F.lit("2.1"), F.lit("2.1.0")),
        small.range_label(F.lit(1), F.lit(9665)), small.range_label(F.lit(74001), F.lit(10**9)), small.number_word(F.lit(12)), small.number_word(F.lit(13)), small.folder_suffix(F.lit("Pack-Voice-DE")),
        small.position_label(F.lit(9), F.lit(4)), small.progress(F.lit(9.0), F.lit(4.0)), small.joined_with_and(F.array(F.lit("a"), F.lit("b"), F.lit("c"))), small.speaker_label(F.lit(""), F.lit("q")), F.round(small.capped(1009.0), 6),
    ).first()
    assert tuple(row) == ("-0:59", "-1:01", True, False, "1–9,665", "74,001 and up", "twelve", "13", "DE", "4 of 4", 1.0, "a, b and c", "q", 1000.0)
    assert spark.createDataFrame([('ä"\\x',)], "t string").select(small.escape_literal("t")).first()[0] == "\\195\\164\\034\\092x"


def test_decisions_over_takes(spark):
    takes = "array<struct<n:int,heard:string,seconds:double,similarity:double,stumbles:int>>"
    df = spark.createDataFrame([([(1, "x", 0.2, 1.0, 0), (2, "a", 0.9, 0.9, 2), (3, "b", 0.5, 0.95, 0)],), ([],)], f"t {takes}")
    ok = lambda t: t["similarity"] >= 0.8
    first, none = df.select(consensus.first_acceptable(F.col("t"), ok).alias("d")).collect()
    assert first["d"]["take"]["n"] == 2 and none["d"]["outcome"] == "unsettled"
    d = df.select(consensus.settle(F.col("t"), ok, lambda t: t["seconds"] > 2, lambda t: F.lit(False), F.lit(0.0), F.lit(0.0), F.lit(False)).alias("d"), consensus.cleanest(F.col("t")).alias("c")).first()
    assert d["d"]["outcome"] == "fixed" and d["d"]["take"]["n"] == 3 and d["c"]["n"] == 1
