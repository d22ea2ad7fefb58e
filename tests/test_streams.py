"""Players and timers: batch and stream against a plain version, event by event; streams in several
micro-batches, out of order, with late rows, and restarted."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lectern.streaming import monitor, player

SCHEMA = "user_id long, seq long, ts timestamp, kind string, lengths array<int>"
DAY = dt.datetime(2024, 1, 1)


@pytest.fixture(autouse=True)
def store(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield
    spark.conf.unset(name)


class Plain:
    """A player as the client has it: a chain number that whatever cancels the reading bumps, and a sentence."""

    def __init__(self):
        self.own, self.sentence, self.paused, self.shown = None, None, False, 0

    def event(self, kind, lengths):
        if kind == "open":
            self.own, self.paused = list(lengths), False
            self.sentence = self.shown = 1
        elif kind == "close":
            self.own, self.sentence, self.paused, self.shown = None, None, False, 0
        elif self.own is None:
            pass
        elif kind == "clip_end" and self.sentence and not self.paused:
            if self.sentence == len(self.own):
                self.sentence = None
            else:
                self.sentence = self.shown = self.sentence + 1
        elif kind in ("pause", "missing") and self.sentence:
            self.paused = True
        elif kind == "resume":
            self.sentence = self.shown = self.sentence if self.paused else 1
            self.paused = False
        if self.own is None:
            return 0, "idle", None, None
        state = "finished" if self.sentence is None else "paused" if self.paused else "playing"
        total = sum(self.own) + 25 * (len(self.own) - 1)
        at = total if state == "finished" else sum(x + 25 for x in self.own[: self.shown - 1])
        return self.shown, state, at, total


def plain(rows):
    players, out = {}, []
    for user, seq, _, kind, lengths in sorted(rows, key=lambda r: (r[0], r[2], r[1])):
        out.append((user, seq, kind, *players.setdefault(user, Plain()).event(kind, lengths)))
    return sorted(out)


def events(seed, n=400, users=5):
    r = random.Random(seed)
    kinds = ["open", "clip_end", "clip_end", "clip_end", "pause", "resume", "missing", "close"]
    rows = []
    for seq in range(n):
        kind = r.choice(kinds)
        rows.append((r.randrange(users), seq, DAY + dt.timedelta(seconds=r.choice((seq * 3, seq * 3, seq * 3 - 40)) + r.random()), kind, [r.randint(1, 300) for _ in range(r.randint(1, 4))] if kind == "open" else None))
    return rows


def test_players(spark):
    rows = events(1) + [(9, 1_000, DAY, "resume", None), (9, 1_001, DAY, "clip_end", None)]
    got = player.playback(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert sorted(tuple(r) for r in got) == plain(rows)


def test_a_finished_passage_is_read_again(spark):
    kinds = ["open", "clip_end", "clip_end", "resume", "clip_end", "pause", "clip_end", "resume", "resume", "missing", "pause", "close", "resume"]
    rows = [(1, k, DAY, kind, [100, 50] if kind == "open" else None) for k, kind in enumerate(kinds)]
    got = [(r["clip"], r["state"], r["at"]) for r in player.playback(spark.createDataFrame(rows, SCHEMA)).orderBy("seq").collect()]
    assert got == [(1, "playing", 0), (2, "playing", 125), (2, "finished", 175), (1, "playing", 0), (2, "playing", 125), (2, "paused", 125), (2, "paused", 125), (2, "playing", 125), (1, "playing", 0), (1, "paused", 0), (1, "paused", 0), (0, "idle", None), (0, "idle", None)]


def streamed(spark, tmp_path, parts, make, schema=SCHEMA, restart_after=None):
    """Feed the parts as files, a micro-batch each; with a restart from the checkpoint after some of them."""
    rounds = [parts] if restart_after is None else [parts[:restart_after], parts[restart_after:]]
    path = str(tmp_path / "in")
    for own in rounds:
        for rows in own:
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        made = make(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path))
        made.writeStream.format("parquet").outputMode("append").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "log")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(made.schema).parquet(str(tmp_path / "out"))


END = (-1, 0, DAY + dt.timedelta(days=900), "close", None)


@pytest.mark.parametrize("restart", [None, 2])
def test_players_as_a_stream(spark, tmp_path, restart):
    rows = events(2)
    arriving = sorted(rows, key=lambda r: r[1])  # up to forty seconds out of order
    parts = [arriving[k : k + 120] for k in range(0, len(arriving), 120)] + [[END]]
    got = streamed(spark, tmp_path, parts, lambda e: player.playback_stream(e, late="2 minutes"), restart_after=restart)
    assert sorted(tuple(r) for r in got.where("user_id >= 0").collect()) == plain(rows)


def test_rows_later_than_the_watermark_are_dropped(spark, tmp_path):
    at = lambda s: DAY + dt.timedelta(seconds=s)
    first = [(1, 1, at(0), "open", [10, 10, 10]), (1, 2, at(100), "clip_end", None), (2, 3, at(500), "open", [5])]
    # A batch takes what isn't later than the watermark of the batch before it, which is at 440 from the third on.
    second = [(2, 7, at(501), "pause", None)]
    third = [(1, 4, at(50), "pause", None), (1, 5, at(600), "clip_end", None)]
    fourth = [(1, 6, at(590), "pause", None), END]
    got = streamed(spark, tmp_path, [first, second, third, fourth], lambda e: player.playback_stream(e, late="60 seconds"))
    assert sorted((r["seq"], r["clip"], r["state"]) for r in got.where("user_id = 1").collect()) == [(1, 1, "playing"), (2, 2, "playing"), (5, 2, "paused"), (6, 2, "paused")]


@pytest.mark.parametrize("restart", [None, 1])
def test_timers_of_opens(spark, tmp_path, restart):
    """Out of order within the watermark, ties at the due time, cancelled and lasting opens."""
    r = random.Random(4)
    rows = [(r.randrange(4), k, DAY + dt.timedelta(seconds=k * 2 + r.choice((0, 0, 0, -30)), milliseconds=r.choice((0, 500))), r.choice(("open", "open", "close")), None) for k in range(300)]
    want = monitor.open_passages(spark.createDataFrame(rows, SCHEMA), delay_seconds=1.5).select("user_id", "seq", "starts")
    parts = [rows[k : k + 100] for k in range(0, 300, 100)] + [[END]]
    got = streamed(spark, tmp_path, parts, lambda e: player.open_passages_stream(e, late="1 minute"), restart_after=restart)
    assert sorted(tuple(x) for x in got.where("user_id >= 0").collect()) == sorted(tuple(x) for x in want.collect())
    assert {x["starts"] for x in got.collect()} == {True, False}


def test_sessions_and_rates_as_streams(spark, tmp_path):
    r = random.Random(5)
    rows = [(r.randrange(3), k, DAY + dt.timedelta(minutes=k * 7 + r.choice((0, -20))), r.choice(("a", "b")), None) for k in range(240)]
    events_ = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("kind", "event_type")
    parts = [rows[k : k + 80] for k in range(0, 240, 80)] + [[END]]
    for k, make in enumerate((lambda e: monitor.sessions(e, gap="15 minutes"), lambda e: monitor.windowed_rate(e, "1 hour"))):
        got = streamed(spark, tmp_path / str(k), parts, lambda e: make(e.withColumnRenamed("kind", "event_type").withWatermark("ts", "30 minutes")), restart_after=2)
        assert sorted(map(str, got.where(F.col("opened") < "2026-01-01").collect())) == sorted(map(str, make(events_).collect()))
