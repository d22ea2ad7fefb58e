"""Queries over the event table as a stream of heartbeats, sessions and settings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.sources import staging
from lectern.streaming import monitor, player

from .registry import query, table

_SQL_BEATS = """beats as (select user_id as run, epoch(ts)::double as tm, sum(1 + event_id % 200) over (partition by user_id order by ts, event_id)::bigint as spoken, value as batch_seconds, event_id from events)"""


def _beats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in heartbeats: a user is a run, and every event adds to what it has spoken."""
    from pyspark.sql import Window as W

    e = table(spark, sf_dir, "events")
    w = W.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(W.unboundedPreceding, W.currentRow)
    return e.select(F.col("user_id").alias("run"), F.col("ts").cast("timestamp").cast("double").alias("at"), F.sum(1 + F.col("event_id") % 200).over(w).alias("spoken"), F.col("value").alias("batch_seconds"), "event_id")


_SQL_RATES = _SQL_BEATS + ", rates as (select *, floor((spoken - lag(spoken) over w) * 60 / greatest(floor(tm - lag(tm) over w), 1))::bigint as rate from beats window w as (partition by run order by tm, spoken))"


@query(f"with {_SQL_RATES} select event_id, run, spoken, rate from rates")
def heartbeat_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W7, T1."""
    return monitor.rates(_beats(spark, sf_dir)).select("event_id", "run", "spoken", "rate")


@query(
    f"""with {_SQL_RATES}, l as (select *, coalesce(rate < 2, false) as low from rates), g as (select *, sum(case when low then 0 else 1 end) over (partition by run order by tm, spoken rows between unbounded preceding and current row) as g from l),
s as (select *, sum(low::int) over (partition by run, g order by tm, spoken rows between unbounded preceding and current row)::bigint as slow from g) select event_id, run, slow, low and slow % 3 = 0 as alarm from s"""
)
def slow_streak(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W8, T2's judgement."""
    return monitor.streaks(monitor.rates(_beats(spark, sf_dir)), floor=2).select("event_id", "run", "slow", "alarm")


@query(
    f"""with {_SQL_BEATS}, o as (select *, case when tm > first(tm) over w then spoken * 60 / (tm - first(tm) over w) end as overall from beats window w as (partition by run order by tm, spoken rows between unbounded preceding and current row))
select event_id, overall::double as overall, (case when overall > 0 then greatest(1000000 - spoken, 0) / overall end)::double as minutes_left from o"""
)
def eta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W9."""
    return monitor.eta(_beats(spark, sf_dir), 1_000_000).select("event_id", "overall", "minutes_left")


@query("select event_id, value as batch_seconds from events where value > 60")
def slow_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3."""
    return monitor.slow_batches(_beats(spark, sf_dir)).select("event_id", "batch_seconds")


@query()
def supervisor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2 as a state machine; rows only, and equal to its streaming form by test."""
    beats = _beats(spark, sf_dir).withColumn("done", F.lit(False))
    return monitor.supervise(beats)


_SQL_SESSIONS = """e as (select user_id, ts, case when lag(ts) over w is null or ts >= lag(ts) over w + interval '6 hours' then 1 else 0 end as new from events window w as (partition by user_id order by ts)),
s as (select *, sum(new) over (partition by user_id order by ts rows between unbounded preceding and current row) as s from e)
select user_id, min(ts) as opened, max(ts) + interval '6 hours' as closed, count(*)::bigint as events from s group by user_id, s"""


@query("with " + _SQL_SESSIONS)
def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T6."""
    found = monitor.sessions(table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp")), gap="6 hours")
    return found.select("user_id", F.col("opened").cast("timestamp_ntz").alias("opened"), F.col("closed").cast("timestamp_ntz").alias("closed"), "events")


@query("select user_id, arg_max(event_id, (case when event_id % 10 = 0 then 0 else event_id % 97 end, event_id)) as seq, max(case when event_id % 10 = 0 then 0 else event_id % 97 end)::bigint as saved from events where event_type <> 'login' group by user_id")
def newest_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T9, D23."""
    e = table(spark, sf_dir, "events")
    rows = e.select("user_id", F.when(F.col("event_id") % 10 != 0, F.col("event_id") % 97).alias("saved"), F.col("event_id").alias("seq"), F.when(F.col("event_type") != "login", F.col("props")).alias("settings"))
    return monitor.newest_settings(rows, key="user_id").select("user_id", "seq", F.coalesce("saved", F.lit(0)).alias("saved"))


@query(
    """with e as (select user_id, event_id, ts, event_type, lead(ts) over (partition by user_id order by ts, event_id) as nxt from events)
select event_id, nxt is null or epoch(nxt) >= epoch(ts) + 3600 as starts from e where event_type in ('view', 'click')"""
)
def open_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which opens live to begin."""
    e = table(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("seq"), "ts", F.when(F.col("event_type").isin("view", "click"), "open").otherwise("close").alias("kind"))
    return monitor.open_passages(e, delay_seconds=3600).select(F.col("seq").alias("event_id"), "starts")


_KINDS = ("open", "open", "clip_end", "clip_end", "clip_end", "clip_end", "pause", "resume", "missing", "close")
_SQL_PLAYS = f"""p as (select user_id, event_id as seq, ts, ({list(_KINDS)})[(event_id * 7 + user_id) % 10 + 1] as kind, [(100 + event_id % 50)::int, (200 + event_id % 30)::int, (50 + event_id % 70)::int, 120::int][1:(1 + event_id % 4)] as lengths from events)"""
_SQL_PLAYBACK = f"""with recursive {_SQL_PLAYS}, e as (select *, row_number() over (partition by user_id order by ts, seq) as rn from p),
f as (select user_id, seq, rn, kind, case when kind = 'open' then 1 else 0 end as clip, case when kind = 'open' then 'playing' else 'idle' end as state, case when kind = 'open' then lengths else [] end as own from e where rn = 1
union all select e.user_id, e.seq, e.rn, e.kind,
 case when e.kind = 'open' then 1 when e.kind = 'close' then 0 when e.kind = 'clip_end' and state = 'playing' and clip < len(own) then clip + 1 when e.kind = 'resume' and state in ('playing', 'finished') then 1 else clip end,
 case when e.kind = 'open' then 'playing' when e.kind = 'close' then 'idle' when e.kind = 'clip_end' and state = 'playing' and clip = len(own) then 'finished' when e.kind in ('pause', 'missing') and state = 'playing' then 'paused' when e.kind = 'resume' and state <> 'idle' then 'playing' else state end,
 case when e.kind = 'open' then e.lengths when e.kind = 'close' then [] else own end
from f join e on e.user_id = f.user_id and e.rn = f.rn + 1)
select seq, kind, clip, state, case when state = 'idle' then null when state = 'finished' then list_sum(own) + 25 * (len(own) - 1) else coalesce(list_sum(own[1:clip - 1]), 0) + 25 * (clip - 1) end::bigint as at,
 case when state <> 'idle' then list_sum(own) + 25 * (len(own) - 1) end::bigint as total from f"""


def _plays(events: DataFrame) -> DataFrame:
    """Stand-in player events."""
    kind = F.element_at(F.array(*[F.lit(k) for k in _KINDS]), (F.pmod(F.col("event_id") * 7 + F.col("user_id"), F.lit(10)) + 1).cast("int"))
    e = F.col("event_id")
    lengths = F.slice(F.array((100 + e % 50).cast("int"), (200 + e % 30).cast("int"), (50 + e % 70).cast("int"), F.lit(120)), F.lit(1), (1 + e % 4).cast("int"))
    return events.select("user_id", F.col("event_id").alias("seq"), "ts", kind.alias("kind"), lengths.alias("lengths"))


@query(_SQL_PLAYBACK)
def playback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each player stands after each event, and its bar."""
    return player.playback(_plays(table(spark, sf_dir, "events"))).drop("user_id")


#: A user that no table has; its one row, a year after all others, lets the watermark pass them.
_NOBODY = -1


def _arriving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table as a stream: three files that follow one another in time, then the row of nobody."""
    e = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")
    path = staging.fresh(spark, "arriving")
    a, b, last = e.agg(F.percentile_approx(F.col("ts").cast("double"), [0.3, 0.7]).alias("q"), F.max("ts").alias("last")).select(F.col("q")[0], F.col("q")[1], "last").first() or (None, None, None)
    at = F.coalesce(F.col("ts").cast("double"), F.lit(0.0))
    for part in (at <= a, (at > a) & (at <= b), at > b):
        e.where(part).write.mode("append").parquet(path)
    later = F.lit(last) + F.expr("interval 365 days")
    spark.range(1).select(F.lit(0).cast(e.schema["event_id"].dataType).alias("event_id"), later.alias("ts"), F.lit(_NOBODY).cast(e.schema["user_id"].dataType).alias("user_id"), F.lit("none").alias("event_type")).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", max(1, e.rdd.getNumPartitions())).parquet(path)


def _landed(made: DataFrame, spark: SparkSession) -> DataFrame:
    """Run a stream in append mode to its end, into files, and read them."""
    path, own = staging.fresh(spark, "landed"), "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(own, None)
    spark.conf.set(own, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        run = made.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", path + "-log").trigger(availableNow=True).start()
        run.awaitTermination()
    finally:
        spark.conf.unset(own) if before is None else spark.conf.set(own, before)
    return spark.read.schema(made.schema).parquet(path)


@query("select date_trunc('day', ts)::timestamp as opened, event_type, count(*)::bigint as events from events group by 1, 2")
def stream_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 as a stream: events per day and type, each day written once the watermark has passed it."""
    held = _landed(monitor.windowed_rate(_arriving(spark, sf_dir).withWatermark("ts", "1 hour")), spark)
    return held.where("event_type <> 'none'").select(F.col("opened").cast("timestamp_ntz").alias("opened"), "event_type", "events")


@query("with " + _SQL_SESSIONS)
def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T6 as a stream: a session is written when it can't grow any more."""
    held = _landed(monitor.sessions(_arriving(spark, sf_dir).withWatermark("ts", "1 hour"), gap="6 hours"), spark)
    return held.where(F.col("user_id") != _NOBODY).select("user_id", F.col("opened").cast("timestamp_ntz").alias("opened"), F.col("closed").cast("timestamp_ntz").alias("closed"), "events")


@query(_SQL_PLAYBACK)
def stream_playback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T7, T8, T11 as a stream: a user's events in order, once the watermark has passed them."""
    return _landed(player.playback_stream(_plays(_arriving(spark, sf_dir))), spark).where(F.col("user_id") != _NOBODY).drop("user_id")


@query(
    """with e as (select user_id, event_id, ts, event_type, lead(ts) over (partition by user_id order by ts, event_id) as nxt from events)
select event_id, nxt is null or epoch(nxt) >= epoch(ts) + 3600 as starts from e where event_type in ('view', 'click')"""
)
def stream_open_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T6 as a stream: opens whose delay ends, by timers, or that another event cancels."""
    kind = F.when(F.col("event_type").isin("view", "click"), "open").otherwise("close")
    opens = _arriving(spark, sf_dir).select("user_id", F.col("event_id").alias("seq"), "ts", kind.alias("kind"))
    held = _landed(player.open_passages_stream(opens, delay_seconds=3600), spark)
    return held.where(F.col("user_id") != _NOBODY).select(F.col("seq").alias("event_id"), "starts")
