"""Reading passages aloud: what begins after its delay, and where a player stands after each event.

Events are rows of user_id, seq, ts, kind and what a kind needs. Both machines go through a user's
events by (ts, seq), one at a time, and keep a few numbers. In batch the rows are sorted within tasks
and pass through in Arrow batches, so that no task holds a user's or a session's rows at once. As
streams the rows wait in the state until the watermark has passed them and are then taken in order;
timers that fall due in between fire before the next row. So both give the same rows, whatever the
order of arrival; a row later than the watermark is dropped, as Spark does with late rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lectern.operators.planner import running

#: A player's place: the clip from 1 (0: none), its state, the clips' lengths in hundredths of a second.
Place = tuple[int, str, list[int]]
NOTHING: Place = (0, "idle", [])
#: Pause between clips, in hundredths of a second.
GAP = 25


def step(place: Place, kind: str, lengths: list[int] | None) -> Place:
    """The place after an event.

    open begins a passage, close forgets it. clip_end goes on to the next clip, after the last one the
    passage has finished; it means nothing while nothing plays, as a pause kills the timer. pause keeps
    the clip, to be begun anew, and so does missing, a clip that isn't there; a finished passage can't
    be paused. resume carries on from a pause, and otherwise reads the passage again from its first clip.
    """
    clip, state, own = place
    if kind == "open":
        return (1, "playing", list(lengths)) if lengths is not None and len(lengths) else (0, "finished", [])
    if kind == "close":
        return NOTHING
    if kind == "clip_end" and state == "playing":
        return (clip + 1, "playing", own) if clip < len(own) else (clip, "finished", own)
    if kind in ("pause", "missing") and state == "playing":
        return clip, "paused", own
    if kind == "resume" and state != "idle" and own:
        return (clip if state == "paused" else 1), "playing", own
    return place


def progress(place: Place, gap: int = GAP) -> tuple[int | None, int | None]:
    """How far the bar stands and how far it goes: at the clip's begin, at the end of a finished passage; a pause holds it."""
    clip, state, own = place
    if state == "idle":
        return None, None
    total = sum(own) + gap * max(0, len(own) - 1)
    return (total if state == "finished" else sum(own[: clip - 1]) + gap * (clip - 1)), total


PLAYED = "user_id long, seq long, kind string, clip int, state string, at long, total long"


def _shown(user: int, seq: int, kind: str, place: Place) -> tuple:
    return (user, seq, kind, place[0], place[1], *progress(place))


def _played(rows: list[tuple]) -> pd.DataFrame:
    made = pd.DataFrame(rows, columns=[c.split()[0] for c in PLAYED.split(", ")])
    return made.astype({"at": "Int64", "total": "Int64"})


def playback(events: DataFrame) -> DataFrame:
    """user_id, seq, kind, clip, state, at, total: where each player (user_id) stands after each event.

    events: user_id, seq, ts, kind (open, clip_end, pause, missing, resume, close), lengths (of an open).
    An open or a close settles everything, so a task gets stretches from one to the next, not users.
    """
    own = events.select("user_id", "seq", "ts", "kind", "lengths")
    begins = F.col("kind").isin("open", "close").cast("long")
    stretches = running(own, ("user_id", "ts", "seq"), "_stretch", F.sum, begins)
    dealt = stretches.repartition("user_id", "_stretch").sortWithinPartitions("user_id", "_stretch", "ts", "seq")

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, place = None, NOTHING
        for batch in batches:
            out = []
            for user, stretch, seq, kind, lengths in batch[["user_id", "_stretch", "seq", "kind", "lengths"]].itertuples(index=False):
                if (user, stretch) != last:
                    last, place = (user, stretch), NOTHING
                place = step(place, kind, lengths)
                out.append(_shown(user, seq, kind, place))
            yield _played(out)

    return dealt.mapInPandas(fold, PLAYED)


class InOrder(StatefulProcessor):
    """Takes a key's rows by (ts, seq) once the watermark has passed them.

    A subclass says what a row does (`take`), and when it wants to be called without one (`due`, `ring`).
    """

    #: Columns of a waiting row behind at (microseconds) and seq, and of what is kept, as DDL.
    waiting: str
    kept: str
    made: str

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", "at long, seq long, " + self.waiting)
        self.state = handle.getValueState("state", self.kept)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for batch in rows:
            for row in batch[["at", "seq", *(c.split()[0] for c in self.waiting.split(", "))]].itertuples(index=False):
                # The state takes Python's own values.
                self.rows.appendValue(tuple(v.tolist() if hasattr(v, "tolist") else v for v in row))
            # One timer for a batch, at its first row; the rest are woken from there.
            self._wake(batch["at"].min())
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        known = sorted((tuple(r) for r in self.rows.get()), key=lambda r: r[:2])
        ready, left = [r for r in known if r[0] <= passed], [r for r in known if r[0] > passed]
        kept = self.state.get() if self.state.exists() else None
        out: list[tuple] = []
        for row in [*ready, None]:
            # What falls due before the next row, or by the watermark.
            now = passed if row is None else row[0]
            while (at := self.due(kept)) is not None and at <= now:
                kept = self.ring(key[0], kept, out)
            if row is not None:
                kept = self.take(key[0], kept, row, out)
        if ready:
            self.rows.put(left) if left else self.rows.clear()
            if left:
                self._wake(left[0][0])
        if kept is None:
            self.state.clear()
        else:
            self.state.update(tuple(kept))
            if (at := self.due(kept)) is not None:
                self._wake(at)
        if out:
            yield self.shown(out)

    def _wake(self, at: int) -> None:
        """Timers count milliseconds; the first at or after the time."""
        self.handle.registerTimer(-(-int(at) // 1000))

    def close(self) -> None:
        pass

    def due(self, kept: tuple | None) -> int | None:
        return None

    def ring(self, key: int, kept: tuple, out: list[tuple]) -> tuple | None:
        return kept

    def take(self, key: int, kept: tuple | None, row: tuple, out: list[tuple]) -> tuple | None:
        raise NotImplementedError

    def shown(self, out: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(out, columns=[c.split()[0] for c in self.made.split(", ")])


class Player(InOrder):
    waiting, kept, made = "kind string, lengths array<int>", "clip int, state string, lengths array<int>", PLAYED

    def take(self, key, kept, row, out):
        clip, state, own = kept or NOTHING
        place = step((clip, state, list(own)), row[2], row[3])
        out.append(_shown(key, row[1], row[2], place))
        return None if place == NOTHING else place

    def shown(self, out):
        return _played(out)


OPENED = "user_id long, seq long, starts boolean"


class Opener(InOrder):
    """An open begins when its delay is over, unless another event of its user has come before that: the timer dies with its token."""

    waiting, kept, made = "kind string", "token long, due long", OPENED

    def __init__(self, delay_seconds: float):
        self.delay = round(delay_seconds * 1_000_000)

    def due(self, kept):
        return kept[1] if kept else None

    def ring(self, key, kept, out):
        out.append((key, kept[0], True))
        return None

    def take(self, key, kept, row, out):
        if kept:
            out.append((key, kept[0], False))
        return (row[1], row[0] + self.delay) if row[2] == "open" else None


def _run(events: DataFrame, columns: list[str], processor: Callable[[], InOrder], late: str) -> DataFrame:
    at = F.unix_micros("ts").alias("at")
    keyed = events.withWatermark("ts", late).select("user_id", "seq", "ts", at, *columns)
    made = processor()
    return keyed.groupBy("user_id").transformWithStateInPandas(made, made.made, "Append", "EventTime")


def playback_stream(events: DataFrame, *, late: str = "10 minutes") -> DataFrame:
    """As `playback`, over a stream (ts a timestamp); rows come when the watermark has passed them. Needs RocksDB as state store."""
    return _run(events, ["kind", "lengths"], Player, late)


def open_passages_stream(events: DataFrame, *, delay_seconds: float = 1.5, late: str = "10 minutes") -> DataFrame:
    """user_id, seq, starts of opens, over a stream: as `monitor.open_passages`, told when an open is cancelled or its time has come."""
    return _run(events, ["kind"], lambda: Opener(delay_seconds), late)
