"""Packs, copies and logs that something goes wrong with."""

from pathlib import Path

import pytest

from lectern.sources import publish

ENTRIES = [(f"Pack/w/{k}.ogg", bytes([k % 251]) * (k % 90)) for k in range(500)]


def entries(spark, rows=ENTRIES):
    return spark.createDataFrame(rows, "path string, content binary").repartition(3)


def held(spark, target):
    return {r["path"]: bytes(r["content"]) for r in spark.read.parquet(target).collect()}


def spoilt(how):
    def write(rows, path):
        publish.write_pack(rows, path)
        parts = sorted(Path(path).glob("part-*.parquet"))
        how(parts)

    return write


def flip(parts):
    """One bit, in the middle of a file; Hadoop's own checksum file goes, as it would after a copy."""
    raw = bytearray(parts[1].read_bytes())
    raw[len(raw) // 3] ^= 4
    parts[1].write_bytes(bytes(raw))
    parts[1].with_name(f".{parts[1].name}.crc").unlink()


def test_a_pack_is_published_and_replaced(spark, tmp_path):
    target = str(tmp_path / "pack")
    assert publish.publish(entries(spark), target, folder="Pack").collect() == []
    assert held(spark, target) == dict(ENTRIES)
    assert publish.publish(entries(spark, ENTRIES[:9]), target, folder="Pack").collect() == []
    assert held(spark, target) == dict(ENTRIES[:9]) and not Path(target + ".partial").exists()


@pytest.mark.parametrize("how", [flip, lambda parts: parts[0].unlink(), lambda parts: parts[2].write_bytes(parts[2].read_bytes()[:-20])])
def test_a_spoilt_pack_is_refused(spark, tmp_path, how):
    target = str(tmp_path / "pack")
    publish.publish(entries(spark, ENTRIES[:9]), target, folder="Pack")
    told = publish.publish(entries(spark), target, folder="Pack", write=spoilt(how)).collect()
    assert {r["problem"] for r in told} <= {"missing", "content differs", "size differs", "unreadable", "extra"} and told
    assert held(spark, target) == dict(ENTRIES[:9])


def test_other_problems(spark, tmp_path):
    own = [*ENTRIES[:20], ("Else/x.lua", b"x"), ("Packs/y.lua", b"y")]
    loads = spark.createDataFrame([("Pack/w/3.ogg",), ("Pack/z.lua",), ("Pack/z.lua",), ("Pack/a.lua",)], "path string")
    told = publish.publish(entries(spark, own), str(tmp_path / "pack"), folder="Pack", loads=loads, limit=100).collect()
    size = sum(len(c) for _, c in own)
    assert sorted(map(tuple, told), key=str) == [("loaded but absent", 2, "Pack/a.lua"), ("outside the folder", 2, "Else/x.lua"), ("over the limit", size, None)]
    assert not (tmp_path / "pack").exists()
    assert publish.publish(entries(spark, []), str(tmp_path / "none"), folder="Pack").collect() == []


def test_copies(spark, tmp_path):
    for side in ("a", "b"):
        (tmp_path / side / "sub").mkdir(parents=True)
        for k in range(5):
            (tmp_path / side / "sub" / f"{k}.ogg").write_bytes(b"OggS" * (k + 1))
    (tmp_path / "b" / "sub" / "1.ogg").write_bytes(b"OggSOggT")
    (tmp_path / "b" / "sub" / "2.ogg").unlink()
    (tmp_path / "b" / "new.ogg").write_bytes(b"x")
    got = {r["path"]: r["status"] for r in publish.compared(spark, str(tmp_path / "a"), str(tmp_path / "b")).collect()}
    assert got == {"sub/0.ogg": "same", "sub/1.ogg": "content differs", "sub/2.ogg": "missing", "sub/3.ogg": "same", "sub/4.ogg": "same", "new.ogg": "extra"}


def test_a_repeated_batch_adds_nothing(spark, tmp_path):
    write = publish.report_batch(str(tmp_path / "log"))
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id int, outcome string")
    for batch in (0, 1, 1, 0):
        write(rows.where(f"id = {batch + 1}"), batch)
    assert sorted(map(tuple, publish.reported(spark, str(tmp_path / "log"), "id int, outcome string").collect())) == [(1, "a"), (2, "b")]
