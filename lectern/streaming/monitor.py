"""Production rates, alarms, sessions and settings over an event stream, in batch and as streams.

Heartbeats are rows of run, at (seconds), spoken, batch_seconds, done. Every windowed operator
partitions by run or user. The batch and streaming forms of the supervisor share one step function.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SLOW_BATCH = 60.0
FLOOR_RATE, PATIENCE, SETTLE, MOST_RESTARTS = 70, 3, 300, 3
SUPERVISED = "run string, at double, rate long, slow int, restarts int, action string"


def rates(beats: DataFrame, *, run: str = "run", at: str = "at", spoken: str = "spoken") -> DataFrame:
    """With rate: items a minute since the observation before, whole numbers, over at least one second."""
    w = W.partitionBy(run).orderBy(at, spoken)
    passed = F.greatest((F.col(at) - F.lag(at).over(w)).cast("long"), F.lit(1).cast("long"))
    return beats.withColumn("rate", F.floor((F.col(spoken) - F.lag(spoken).over(w)) * 60 / passed))


def streaks(rated: DataFrame, *, floor: int = FLOOR_RATE, patience: int = PATIENCE, run: str = "run", order: tuple[str, ...] = ("at", "spoken")) -> DataFrame:
    """With slow (length of the streak below the floor up to here) and alarm (the streak reaches a multiple of patience)."""
    w = W.partitionBy(run).orderBy(*order)
    low = F.coalesce(F.col("rate") < floor, F.lit(False))
    group = F.sum(F.when(low, 0).otherwise(1)).over(w.rowsBetween(W.unboundedPreceding, W.currentRow))
    grouped = rated.withColumn("_g", group).withColumn("_low", low)
    slow = F.sum(F.col("_low").cast("int")).over(W.partitionBy(run, "_g").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow))
    return grouped.withColumn("slow", slow).withColumn("alarm", F.col("_low") & (F.col("slow") % patience == 0)).drop("_g", "_low")


def slow_batches(beats: DataFrame, limit: float = SLOW_BATCH) -> DataFrame:
    return beats.where(F.col("batch_seconds") > limit)


def eta(beats: DataFrame, total: int, *, run: str = "run", at: str = "at", spoken: str = "spoken") -> DataFrame:
    """With overall rate a minute since the run began, and minutes left for `total` items."""
    w = W.partitionBy(run).orderBy(at, spoken).rowsBetween(W.unboundedPreceding, W.currentRow)
    passed = F.col(at) - F.first(at).over(w)
    rate = F.when(passed > 0, F.col(spoken) * 60 / passed)
    return beats.withColumn("overall", rate).withColumn("minutes_left", F.when(rate > 0, F.greatest(F.lit(total) - F.col(spoken), F.lit(0)) / rate))


def step(state: tuple, at: float, spoken: int, done: bool, *, floor: int = FLOOR_RATE, patience: int = PATIENCE, settle: float = SETTLE, most: int = MOST_RESTARTS) -> tuple[tuple, tuple]:
    """One observation of the supervisor: (new state, (rate, slow, restarts, action)).

    State: last spoken, last at, slow streak, restarts, settling until. Below the floor `patience`
    times running it restarts and then doesn't judge for `settle` seconds; a healthy rate forgets
    restarts; after `most` of them it raises an alarm instead; `done` ends.
    """
    last, since, slow, restarts, until = state
    if done:
        return (spoken, at, 0, restarts, until), (None, 0, restarts, "end")
    if last is None:
        return (spoken, at, 0, restarts, until), (None, 0, restarts, "watch")
    rate = int((spoken - last) * 60 // max(1, int(at - since)))
    action = "watch"
    if at < until:
        action = "settle"
    elif rate >= floor:
        slow, restarts = 0, 0
    else:
        slow += 1
        if slow >= patience:
            slow = 0
            if restarts >= most:
                action = "alarm"
            else:
                restarts, until, action = restarts + 1, at + settle, "restart"
    return (spoken, at, slow, restarts, until), (rate, slow, restarts, action)


_START = (None, 0.0, 0, 0, 0.0)


def _fold(state: tuple, run: str, rows: pd.DataFrame) -> tuple[tuple, pd.DataFrame]:
    out = []
    for at, spoken, done in rows.sort_values(["at", "spoken"])[["at", "spoken", "done"]].itertuples(index=False):
        state, (rate, slow, restarts, action) = step(state, float(at), int(spoken), bool(done))
        out.append((run, float(at), rate, slow, restarts, action))
    made = pd.DataFrame(out, columns=["run", "at", "rate", "slow", "restarts", "action"])
    made["rate"] = made["rate"].astype("Int64")
    return state, made


def supervise(beats: DataFrame) -> DataFrame:
    """What the supervisor does at each heartbeat; a run's heartbeats (one a minute) fold in order."""
    return beats.select(F.col("run").cast("string").alias("run"), "at", "spoken", "done").groupBy("run").applyInPandas(lambda key, rows: _fold(_START, key[0], rows)[1], SUPERVISED)


def supervise_stream(beats: DataFrame) -> DataFrame:
    """As `supervise` over a stream: the state of each run stays between micro-batches."""
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def fold(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches))
        have = state.get if state.exists else (None, 0.0, 0, 0, 0.0)
        new, made = _fold(tuple(have), key[0], rows)
        state.update(new)
        yield made

    return beats.select(F.col("run").cast("string").alias("run"), "at", "spoken", "done").groupBy("run").applyInPandasWithState(fold, SUPERVISED, "last long, since double, slow int, restarts int, until double", "append", GroupStateTimeout.NoTimeout)


def sessions(events: DataFrame, *, user: str = "user_id", gap: str = "30 minutes") -> DataFrame:
    """user, opened, closed, events: runs of a user's events less than the gap apart. Works on streams with a watermark."""
    return events.groupBy(user, F.session_window("ts", gap).alias("_w")).agg(F.count(F.lit(1)).alias("events")).select(user, F.col("_w.start").alias("opened"), F.col("_w.end").alias("closed"), "events")


def windowed_rate(events: DataFrame, width: str = "1 day") -> DataFrame:
    """Events of each type per tumbling window. Works on streams."""
    return events.groupBy(F.window("ts", width).alias("_w"), "event_type").agg(F.count(F.lit(1)).alias("events")).select(F.col("_w.start").alias("opened"), "event_type", "events")


def open_passages(events: DataFrame, *, user: str = "user_id", delay_seconds: float = 1.5) -> DataFrame:
    """Opens (kind 'open') with starts: whether the passage begins, as no other open or close of the user comes within the delay.

    A new open cancels the one before, as does a close; what was due later dies.
    """
    w = W.partitionBy(user).orderBy("ts", "seq")
    nxt = F.lead("ts").over(w)
    due = F.col("ts").cast("timestamp").cast("double") + delay_seconds
    return events.withColumn("starts", F.isnull(nxt) | (nxt.cast("timestamp").cast("double") >= due)).where("kind = 'open'")


def newest_settings(saved: DataFrame, *, key: str = "folder") -> DataFrame:
    """The settings saved last for each key: the greatest `saved` (missing is 0), of equal ones the later `seq`; rows without settings don't count."""
    return saved.where("settings is not null").groupBy(key).agg(F.max_by(F.struct("saved", "seq", "settings"), F.struct(F.coalesce("saved", F.lit(0)), "seq")).alias("_s")).select(key, "_s.*")
