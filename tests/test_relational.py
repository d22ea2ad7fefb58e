"""Relational operators on small tables, streams against their batch twins, sources on files."""

import json
import random
import struct

import pytest
from pyspark.sql import functions as F

from lectern.functions import ident
from lectern.operators import packs, planner, reconcile
from lectern.sources import binary, text as sources
from lectern.streaming import monitor


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_islands_across_blocks(spark):
    ids = spark.createDataFrame([(i,) for i in (5, 6, 7, 9, 9, 10, 11, 12, 13)], "id long")
    for buckets in (2, 4, 1 << 16):
        assert rows(packs.islands(ids, buckets=buckets)) == [(5, 7), (9, 13)]


def test_ranges(spark):
    r = spark.createDataFrame([(1, 10), (20, 20)], "low long, high long")
    p = spark.createDataFrame([(5,), (20,), (99,)], "id long")
    assert rows(packs.without_points(r, p)) == [(1, 4), (6, 10)]
    assert rows(packs.merged(spark.createDataFrame([(1, 5), (6, 9), (20, 30), (2, 3)], "low long, high long"))) == [(1, 9), (20, 30)]
    dim = spark.createDataFrame([("a", 1, 10), ("b", 11, 20)], "name string, low long, high long")
    ids = spark.createDataFrame([(1,), (10,), (11,), (21,), (15,)], "id long")
    special = spark.createDataFrame([(15, "a")], "quest_id long, name string")
    assert rows(packs.assign(ids, dim, special)) == [(1, "a"), (10, "a"), (11, "b"), (15, "a"), (21, None)]
    assert packs.overlapping(dim).count() == 0


def test_ranges_in_order_are_those_by_hand(spark, monkeypatch):
    r = random.Random(3)
    cuts = sorted(r.sample(range(2000), 40))
    ranges = [(f"p{i}", cuts[i], cuts[i + 1] - 1 - r.choice([0, 3])) for i in range(0, 39, 2)]
    ranges = [x for x in ranges if x[1] <= x[2]]
    points = [r.randrange(-10, 2100) for _ in range(600)]
    left = set()
    for _, low, high in ranges:
        for p in sorted(set(points)):
            if low <= p <= high:
                left |= {(low, p - 1)} if low < p else set()
                low = p + 1
        left |= {(low, high)} if low <= high else set()
    dim = spark.createDataFrame(ranges, "name string, low long, high long")
    ids = spark.createDataFrame([(p,) for p in points] + [(None,)], "id long")
    assert rows(packs.without_points(dim.select("low", "high"), ids)) == sorted(left)
    by_broadcast = sorted(map(str, packs.assign(ids, dim).collect()))
    monkeypatch.setattr(packs, "BROADCAST_RANGES", 3)
    assert sorted(map(str, packs.assign(ids, dim).collect())) == by_broadcast


def test_side_car_files(spark, tmp_path):
    for k, stamp in ((1, "aa low\n"), (2, " bb high")):
        (tmp_path / f"w{k}").mkdir()
        (tmp_path / f"w{k}" / f"{k}.ogg").write_bytes(b"x" * k)
        (tmp_path / f"w{k}" / f"{k}.ogg.hash").write_text(stamp)
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    assert rows(sources.stamps(spark, str(tmp_path)).select(name, "stamp")) == [("1.ogg", "aa low"), ("2.ogg", "bb high")]
    assert rows(binary.listing(spark, str(tmp_path)).select(name, "size")) == [("1.ogg", 1), ("2.ogg", 2)]


def test_stems_and_ignored_paths(spark):
    stems = spark.createDataFrame([(s,) for s in ("25152_o1", "7_12", "a_o1", "7_o", "7o1", "1_2_o3", "")], "s string")
    assert [r[0] and tuple(r[0]) for r in stems.select(ident.stem_parts(F.col("s"))).collect()] == [(25152, "o", 1), (7, "1", 2), None, None, None, None, None]
    files = spark.createDataFrame([(p,) for p in ("a", "ab", "a/b", "a/b/c", "x/a", None)], "path string")
    ignored = spark.createDataFrame([("a",), ("x/a/b",)], "prefix string")
    assert sorted(map(str, (r[0] for r in reconcile.not_ignored(files, ignored).collect()))) == ["None", "ab", "x/a"]


def test_spans_overrun(spark):
    starts = spark.createDataFrame([(1, "o", [1, 3], 2)], "quest_id long, letter string, firsts array<int>, n_sentences int")
    assert rows(packs.spans(starts).select("first", "last")) == [(1, 2), (3, 3)]


def test_lengths_close_gaps(spark):
    d = spark.createDataFrame([(1, "o", 3, 30), (1, "o", 1, 10)], "quest_id long, letter string, idx int, centis int")
    assert packs.passage_lengths(d).first()["lengths"] == [10, 30] and packs.passage_lengths(d).first()["has_gap"]
    assert packs.parse_table(packs.as_table(packs.passage_lengths(d))).first()["lengths"] == [10, 30]


def brute_layout(sizes, cap):
    best = None
    n = len(sizes)
    for mask in range(1 << (n - 1)):
        groups, cur = [], [sizes[0]]
        for i in range(1, n):
            if mask >> (i - 1) & 1:
                groups.append(cur)
                cur = []
            cur.append(sizes[i])
        groups.append(cur)
        if all(sum(g) <= cap or len(g) == 1 for g in groups):
            key = (len(groups), max(map(sum, groups)))
            best = min(best, key) if best else key
    return best


@pytest.mark.parametrize("cap", [10, 12, 20])
def test_bin_layout(spark, cap):
    sizes = [4, 7, 3, 2, 8, 5, 1]
    got = packs.bin_layout(spark.createDataFrame([(str(i), i, float(s)) for i, s in enumerate(sizes)], "name string, pos int, size double"), cap * 1.009).collect()
    parts = {}
    for r in got:
        parts[r["part"]] = parts.get(r["part"], 0) + sizes[r["pos"]]
    assert (len(parts), max(parts.values())) == brute_layout(sizes, cap)


def test_outcomes(spark):
    log = spark.createDataFrame([("a", 1, "fixed"), ("a", 2, "unsettled"), ("b", 1, "unsettled"), ("b", 2, "silent")], "path string, seq int, outcome string")
    assert rows(reconcile.absorbing(log, "path", ("seq",))) == [("b", 2, "silent")]
    assert rows(reconcile.last_wins(log, "path", ("seq",))) == [("a", 2, "unsettled"), ("b", 2, "silent")]
    assert rows(reconcile.first_wins(log, "path", ("seq",))) == [("a", 1, "fixed"), ("b", 1, "unsettled")]


def test_row_numbers_are_global(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k")).repartition(7)
    got = planner.with_row_number(df, ("k",)).collect()
    assert all(r["k"] == r["row_number"] for r in got) and len(got) == 1000


def test_quest_plan(spark):
    corpus = spark.createDataFrame([("25152", "Ein langer Satz, der für sich allein stehen kann.", None, ""), ("-7", "x", "x", "x"), ("classic-2", "x", "x", "x")], "id string, description string, progress string, completion string")
    got = planner.quest_plan(corpus).collect()
    assert [(r["path"], r["field"]) for r in got] == [("sounds/q/52/25152_o1.ogg", "description")]


def test_supervisor_stream_equals_batch(spark, tmp_path):
    beats = [("r", float(60 * i), 10 * i, i == 29) for i in range(30)] + [("s", float(60 * i), 100 * i, False) for i in range(10)]
    df = spark.createDataFrame(beats, "run string, at double, spoken long, done boolean")
    df.repartition(1).sortWithinPartitions("at").write.parquet(str(tmp_path / "in"))
    stream = monitor.supervise_stream(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")))
    run = stream.writeStream.format("memory").queryName("supervised").outputMode("append").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    run.awaitTermination()
    batch = rows(monitor.supervise(df).fillna(-1))
    assert rows(spark.table("supervised").fillna(-1)) == batch
    assert {r[5] for r in batch if r[0] == "r"} >= {"restart", "settle", "end"} and {r[5] for r in batch if r[0] == "s"} == {"watch"}


def test_json_lines(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    path.write_text('{"word": "a"}\n\n{broken\n{"word": "ö"}\n')
    assert rows(sources.jsonl(spark, str(path), "word string", tolerant=True)) == [("a",), ("ö",)]
    with pytest.raises(Exception):
        sources.jsonl(spark, str(path), "word string").collect()
    assert sources.jsonl(spark, str(tmp_path / "none"), "word string", missing_ok=True).count() == 0
    sources.write_jsonl(spark.createDataFrame([("ü",)], "w string"), str(tmp_path / "out"))
    assert [json.loads(t) for p in (tmp_path / "out").glob("part-*") if (t := p.read_text())] == [{"w": "ü"}]


def test_text_scans(spark):
    one = lambda s: spark.createDataFrame([(s,)], "value string")
    d = sources.dictionary(one('  ["haus"] = { word = "Haus", n = 1 },').union(one("no")))
    assert rows(d.select("key", "word")) == [("haus", "Haus")]
    blocks = sources.brace_blocks(one('{ ["kind"] = "title", ["id"] = 7, ["text"] = "sagt \\"ja\\"", }, { ["kind"] = "x" }'))
    assert rows(blocks) == [("title", 7, 'sagt "ja"', None)]
    assert rows(sources.segments(one("q(5,{1, 2},{3}) q(6, {}, {9})")).select("quest_id", "npcs")) == [(5, [1, 2]), (6, [9])]
    assert rows(sources.inserted_triples(one("INSERT INTO `m` VALUES (1,2,3),(4,5,6)").union(one("other (7,8,9)")), "m", ("a", "b", "c"))) == [(1, 2, 3), (4, 5, 6)]
    assert rows(sources.id_list(one("[5, 3]"))) == [(0, 5), (1, 3)]
    assert rows(sources.median_table(one('{"2": 0.64}'))) == [(2, 0.64)]
    assert rows(sources.blob(one("x lengths = [[\n1 o 5\n2 p 6\n]] y"), "lengths")) == [("1 o 5",), ("2 p 6",)]
    assert rows(sources.manifest(one("## T: x").union(one("a\\b.lua")))) == [("a/b.lua",)]


def test_ogg_ends(spark):
    mark = lambda n: b"OggS\0\0" + n.to_bytes(8, "little", signed=n < 0)
    cases = [(b"x" * 10 + mark(48_000) + b"rest", 2.0, 2.0), (b"", 0.0, None), (None, 0.0, None), (mark(-1), (2**64 - 1) / 24_000, None), (mark(24_000) + mark(48_000)[:-1], 0.0, None),
             (mark(24_000) + b"\xff" * 70_000, 0.0, None), (b"\xff" * 70_000 + mark(24_000) + b"\xc3\xa4" * 9, 1.0, 1.0), (mark(0), 0.0, None), (b"OggSOggS" + mark(72_000), 3.0, 3.0)]
    df = spark.createDataFrame([(i, None if c is None else bytearray(c)) for i, (c, _, _) in enumerate(cases)], "i int, c binary")
    assert rows(df.select("i", binary.ogg_seconds(F.col("c")), binary.ogg_seconds(F.col("c"), signed=True))) == [(i, u, s) for i, (_, u, s) in enumerate(cases)]


def test_wav_with_much_before_its_samples(spark):
    head = b"fmt " + struct.pack("<I2H2I2H", 16, 1, 1, 8_000, 16_000, 2, 16)
    chunk = lambda name, size, n: name + struct.pack("<I", size) + b"x" * n
    whole = lambda *parts: b"RIFF\0\0\0\0WAVE" + b"".join(parts)
    cases = [(whole(head, chunk(b"data", 16_000, 9)), 1.0), (whole(chunk(b"LIST", 501, 502), head, chunk(b"data", 32_000, 0)), 2.0), (whole(head, chunk(b"LIST", 9_000, 9_000)), None), (whole(), None), (b"RIFX", None), (None, None)]
    df = spark.createDataFrame([(i, None if c is None else bytearray(c)) for i, (c, _) in enumerate(cases)], "i int, c binary")
    for head_bytes in (16, 40, 64, 1 << 16):
        assert rows(df.select("i", binary.wav_seconds(F.col("c"), head=head_bytes))) == [(i, w) for i, (_, w) in enumerate(cases)]


def packed_file():
    """Two records of a byte id, a signed nibble, an indexed nibble, and a common field; one copy; one encrypted section."""
    fields = [(0, 8, 0, 0, 0, 0, 0), (8, 4, 0, 5, 0, 0, 0), (12, 4, 8, 3, 0, 0, 0), (0, 0, 8, 2, 77, 8, 0)]
    pallet, common = struct.pack("<2I", 500, 600), struct.pack("<Ii", 2, 99)
    head = b"WDC5" + b"\0" * 132
    records = bytes([1, 0x1F, 2, 0x07])
    sections = 2
    size = 136 + 68 + sections * 40 + 4 * 4 + len(fields) * 24 + len(pallet) + len(common)
    header = struct.pack("<9I2HI6I", 2, 4, 2, 0, 0, 0, 0, 0, 0, 0, 0, 4, 0, 0, 96, len(common), len(pallet), sections)
    body = struct.pack("<Q8I", 0, size, 2, 0, 0, 0, 0, 0, 8) + struct.pack("<Q8I", 5, 0, 9, 0, 0, 0, 0, 0, 0)
    return head + header + body + b"\0" * 16 + b"".join(struct.pack("<2H5I", *f) for f in fields) + pallet + common + records + struct.pack("<2I", 3, 1)


def test_bit_fields():
    import random

    import numpy as np

    r = random.Random(1)
    raw = [r.randbytes(13) for _ in range(50)]
    for first, size in ((0, 8), (3, 5), (7, 31), (40, 64), (99, 5), (12, 0), (8, 80)):
        want = [int.from_bytes(x, "little") >> first & (1 << min(size, 64)) - 1 for x in raw]
        assert binary.bit_field(np.frombuffer(b"".join(raw), "u1").reshape(-1, 13), first, size).tolist() == want


def test_packed_table(spark, tmp_path):
    want = [(1, [1, -1, 600, 77]), (2, [2, 7, 500, 99]), (3, [1, -1, 600, 77])]
    path = tmp_path / "t.db2"
    path.write_bytes(packed_file())
    files = spark.read.format("binaryFile").load(str(path))
    spark.dataSource.register(binary.PackedTableSource)
    for n in (1, 2, 65_536):
        assert rows(binary.packed_rows(files, rows=n).select("id", "vals")) == want
        for place in (str(path), f"file://{path}"):
            read = spark.read.format("packed_table").option("rows", n).load(place)
            assert rows(read) == want and read.rdd.getNumPartitions() == max(1, 2 // n)
    with pytest.raises(Exception, match="not a packed client table"):
        binary.packed_rows(files.withColumn("content", F.lit(b"WDC4" + b"0" * 300))).collect()
    assert binary.packed_rows(files.withColumn("content", F.lit(None).cast("binary"))).collect() == []


def test_first_word_of_files_of_other_sizes_and_in_parts(spark, tmp_path):
    """Spark reads the largest parts first; a later file's word must not win for that."""
    from lectern.sources import text as sources

    n = {"a.lua": 300, "b.lua": 20_000, "c.lua": 3_000}
    for name, count in n.items():
        (tmp_path / name).write_text("".join(f'["k{i}"] = {{ word = "{name}-{i}-{again}" }},\n' for again in range(2) for i in range(count)))
    own = {"spark.sql.files.maxPartitionBytes": "40000", "spark.sql.files.openCostInBytes": "0"}
    try:
        for k, v in own.items():
            spark.conf.set(k, v)
        read = sources.lines(spark, str(tmp_path))
        assert read.rdd.getNumPartitions() > 8
        first = planner.word_plan(sources.dictionary(read))
        got = {r["key"]: r["text"] for r in first.collect()}
        listed = sources.path_list(read).select("path", "pos.*")
        numbered = planner.with_row_number(listed, sources.LINE_PLACE).orderBy("row_number").collect()
    finally:
        for k in own:
            spark.conf.unset(k)
    assert got == {f"k{i}": f"{next(f for f, c in n.items() if i < c)}-{i}-0" for i in range(20_000)}
    assert [r["path"] for r in numbered] == [line.strip() for name in sorted(n) for line in (tmp_path / name).read_text().splitlines()]


def test_layout_of_nothing_and_of_what_is_too_large(spark):
    none = spark.createDataFrame([], "name string, pos int, size double")
    assert packs.bin_layout(none, 10.0).collect() == []
    large = spark.createDataFrame([("a", 1, 99.0), ("b", 2, 1.0), ("c", 3, 1.0), ("d", 4, 99.0)], "name string, pos int, size double")
    assert [(r["name"], r["part"]) for r in packs.bin_layout(large, 10.0).collect()] == [("a", 0), ("b", 1), ("c", 1), ("d", 2)]


def test_medians_of_few_null_and_equal_values(spark):
    from lectern.operators import durations

    clips = [("aa", None)] * 19 + [("aa", 3.0)] + [("bbb", float(k)) for k in range(20)] + [("cccc", 7.5)] * 30 + [("d", 1.0)] * 19 + [(None, 1.0)] * 40 + [("eeeee", None)] * 25
    got = {r["len"]: r["median"] for r in durations.medians(spark.createDataFrame(clips, "word string, seconds double")).collect()}
    assert got == {2: 3.0, 3: 9.5, 4: 7.5}
