"""Queries over keys, packs, durations, takes, outcomes and entities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.functions import small
from lectern.operators import consensus, durations, entities, packs, planner, reconcile

from .registry import query, table

#: Stand-in packs over order keys: name, low, high, rank of release.
PACKS = (("first", 1, 9_665, 2), ("second", 9_666, 21_579, 3), ("third", 21_580, 44_620, 0), ("fourth", 44_621, 129_377, 1), ("fifth", 129_378, 10**9, 4))
_SQL_PACKS = "packs(name, low, high, rank) as (values " + ", ".join(f"('{n}', {a}, {b}, {r})" for n, a, b, r in PACKS) + ")"
#: Orders that belong to a pack other than that of their range.
SPECIAL = ((7, "third"), (33, "fifth"))
_SQL_SPECIAL = "special(quest_id, name) as (values " + ", ".join(f"({q}, '{n}')" for q, n in SPECIAL) + ")"
_SQL_ASSIGNED = f"with {_SQL_PACKS}, {_SQL_SPECIAL}, a as (select o.*, coalesce(s.name, p.name) as pack from orders o left join packs p on o_orderkey between low and high left join special s on s.quest_id = o_orderkey)"


def _packs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PACKS, "name string, low long, high long, rank int")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("id", F.col("o_orderkey"))


def _assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packs.assign(_orders(spark, sf_dir), _packs(spark), spark.createDataFrame(SPECIAL, "quest_id long, name string"))


def _durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in clips: a line item is a clip of its order, its quantity the seconds."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("quest_id"), F.when(F.col("l_returnflag") == "A", "o").when(F.col("l_returnflag") == "N", "p").otherwise("c").alias("letter"), F.col("l_linenumber").alias("idx"), (F.col("l_quantity") * 10).cast("int").alias("centis"))


_SQL_D = "d as (select l_orderkey as quest_id, case l_returnflag when 'A' then 'o' when 'N' then 'p' else 'c' end as letter, l_linenumber as idx, (l_quantity * 10)::int as centis from lineitem)"


@query(_SQL_ASSIGNED + " select pack, count(*)::bigint as orders, min(o_orderkey) as low, max(o_orderkey) as high from a group by pack")
def pack_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6."""
    return _assigned(spark, sf_dir).groupBy("pack").agg(F.count(F.lit(1)).alias("orders"), F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high"))


@query(
    f"with {_SQL_PACKS}, {_SQL_D} select p.name as pack, count(*)::bigint as clips, round(sum(centis) / 100.0 / 3600, 6)::double as hours from d left join packs p on quest_id between low and high group by 1"
)
def pack_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5, A21."""
    lengths = packs.assign(packs.passage_lengths(_durations(spark, sf_dir)), _packs(spark), key="quest_id")
    return packs.totals(lengths, "pack").select("pack", "clips", F.round("hours", 6).alias("hours"))


@query(
    f"""with {_SQL_PACKS}, layout(name, pack) as (values ('first', 'A'), ('second', 'A'), ('third', 'B')),
c as (select case when name in ('first', 'second') then 'A' when name = 'third' then 'B' end as pack, count(*)::bigint as clips from orders join packs on o_orderkey between low and high group by 1)
select name, low::bigint as low, high::bigint as high, coalesce(l.pack, 'not recorded') as pack, coalesce(clips, 0) as clips from packs left join layout l using (name) left join c on c.pack = l.pack"""
)
def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J18."""
    layout = spark.createDataFrame([("first", "A"), ("second", "A"), ("third", "B")], "name string, pack string")
    counts = packs.assign(_orders(spark, sf_dir), _packs(spark)).join(layout.withColumnRenamed("pack", "own"), F.col("pack") == F.col("name")).groupBy(F.col("own").alias("pack")).agg(F.count(F.lit(1)).alias("clips"))
    return packs.coverage(_packs(spark).drop("rank"), layout, counts)


@query(
    f"""with {_SQL_D}, p as (select quest_id, letter, array_agg(centis order by idx, centis) as ls, max(idx) as top, count(*) as n from d group by 1, 2)
select quest_id, letter, quest_id || ' ' || letter || ' ' || array_to_string(ls, ',') as value, top <> n as has_gap, list_sum(ls)::bigint as total from p"""
)
def passage_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table is written out and parsed again."""
    lengths = packs.passage_lengths(_durations(spark, sf_dir))
    lines = packs.as_table(lengths)
    back = packs.parse_table(lines).select("quest_id", "letter", F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x).alias("total"))
    return lines.join(lengths.select("quest_id", "letter", "has_gap"), ["quest_id", "letter"]).join(back, ["quest_id", "letter"])


@query(
    f"""with {_SQL_D} select quest_id, letter, idx, (coalesce(sum(centis) over (partition by quest_id, letter order by idx, centis rows between unbounded preceding and 1 preceding), 0) + 25 * (row_number() over (partition by quest_id, letter order by idx, centis) - 1))::bigint as start,
(sum(centis) over (partition by quest_id, letter) + 25 * (count(*) over (partition by quest_id, letter) - 1))::bigint as total from d"""
)
def timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W3, T7."""
    return packs.timeline(_durations(spark, sf_dir)).select("quest_id", "letter", "idx", F.col("start").cast("bigint").alias("start"), F.col("total").cast("bigint").alias("total"))


@query(
    f"""with {_SQL_D}, s as (select quest_id, letter, array_agg(distinct idx order by idx) as firsts, max(idx) + (quest_id % 3)::int as total from d group by quest_id, letter),
e as (select quest_id, letter, total, firsts, unnest(range(1, len(firsts) + 1)) as idx from s)
select quest_id, letter, idx::int as idx, firsts[idx] as first, greatest(coalesce(firsts[idx + 1], total + 1) - 1, firsts[idx])::int as last from e"""
)
def start_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W4, D8."""
    starts = _durations(spark, sf_dir).groupBy("quest_id", "letter").agg(F.array_sort(F.collect_set("idx")).alias("firsts"), F.max("idx").alias("top"))
    return packs.spans(starts.withColumn("n_sentences", (F.col("top") + F.col("quest_id") % 3).cast("int")).drop("top"))


@query(
    """with k as (select distinct o_orderstatus, o_orderkey as v from orders), g as (select o_orderstatus, v, v - row_number() over (partition by o_orderstatus order by v) as g from k)
select o_orderstatus, min(v) as low, max(v) as high from g group by o_orderstatus, g"""
)
def islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of orders of one status."""
    return packs.islands(_orders(spark, sf_dir), "id", "o_orderstatus")


@query(
    f"""with {_SQL_PACKS}, pts as (select distinct o_orderkey as id from orders where o_orderkey % 1000 = 0),
b as (select low, high, list_sort(array_agg(id)) as cs from packs join pts on id between low and high group by low, high union all select low, high, []::bigint[] from packs p where not exists (select 1 from pts where id between p.low and p.high))
select low, high from (select unnest(list_concat([low::bigint], list_transform(cs, lambda c: c + 1))) as low, unnest(list_concat(list_transform(cs, lambda c: c - 1), [high::bigint])) as high from b) where low <= high"""
)
def range_subtract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A16."""
    points = _orders(spark, sf_dir).where("id % 1000 = 0").select("id")
    return packs.without_points(_packs(spark).select("low", "high"), points)


_SQL_STRETCHES = """r as (select distinct l_orderkey * 9 + l_linenumber as low, l_orderkey * 9 + l_linenumber + (case when l_partkey % 50 = 0 then l_quantity * 3 else l_quantity % 3 end)::bigint as high from lineitem)"""


def _stretches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in id ranges, one per line item: most of one to three ids, some far longer."""
    li = table(spark, sf_dir, "lineitem")
    low = F.col("l_orderkey") * 9 + F.col("l_linenumber")
    return li.select(low.alias("low"), (low + F.when(F.col("l_partkey") % 50 == 0, F.col("l_quantity") * 3).otherwise(F.col("l_quantity") % 3).cast("long")).alias("high"))


@query(
    f"""with {_SQL_STRETCHES}, t as (select *, max(high) over (order by low, high rows between unbounded preceding and 1 preceding) as top from r),
g as (select *, sum(case when low <= top + 1 then 0 else 1 end) over (order by low, high rows between unbounded preceding and current row) as g from t) select min(low) as low, max(high) as high from g group by g"""
)
def range_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges that touch or overlap join."""
    return packs.merged(_stretches(spark, sf_dir))


#: Ranges of parts that don't overlap, of lengths from 1 to 60 in steps of 60 ids; every ninetieth covers 240.
_SQL_SHELVES = "s as (select p_partkey as name, p_partkey * 60 as low, p_partkey * 60 + case when p_partkey % 90 = 0 then 239 else p_size end as high from part where p_partkey % 90 not in (1, 2, 3))"


def _shelves(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("p_partkey")
    long = table(spark, sf_dir, "part").where("p_partkey % 90 not in (1, 2, 3)")
    return long.select(p.alias("name"), (p * 60).alias("low"), (p * 60 + F.when(p % 90 == 0, 239).otherwise(F.col("p_size"))).alias("high"))


@query(f"with {_SQL_SHELVES} select l_orderkey, l_linenumber, name as shelf from lineitem left join s on l_orderkey * 2 + l_linenumber between low and high")
def shelf_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6 with as many ranges as there are parts."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_orderkey") * 2 + F.col("l_linenumber")).alias("id"))
    return packs.assign(rows, _shelves(spark, sf_dir)).select("l_orderkey", "l_linenumber", F.col("pack").alias("shelf"))


@query(
    f"""with {_SQL_SHELVES}, pts as (select distinct o_orderkey as id from orders), b as (select s.low, s.high, list_sort(array_agg(id) filter (id is not null)) as cs from s left join pts on id between low and high group by s.low, s.high)
select low, high from (select unnest(list_concat([low], list_transform(coalesce(cs, []::bigint[]), lambda c: c + 1))) as low, unnest(list_concat(list_transform(coalesce(cs, []::bigint[]), lambda c: c - 1), [high])) as high from b) where low <= high"""
)
def shelves_without(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A16 with many ranges and many ids."""
    return packs.without_points(_shelves(spark, sf_dir), _orders(spark, sf_dir).select("id"))


@query(f"with {_SQL_STRETCHES}, n as (select low, max(high) as high from r group by low) select a.low as one, b.low as other from n a join n b on a.low < b.low and b.low <= a.high")
def overlapping_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6's condition: which ranges overlap."""
    named = _stretches(spark, sf_dir).groupBy("low").agg(F.max("high").alias("high"))
    return packs.overlapping(named.select(F.col("low").alias("name"), "low", "high"))


@query(
    """with recursive m as (select strftime(o_orderdate, '%Y-%m') as name, count(*)::double as size from orders group by 1),
a as (select list(name order by name) as names, list(size order by name) as ns, 12 * max(size) / 1.009 as cap from m),
d(i, best) as (select len(ns)::int, [{'n': 0, 'big': 0.0::double, 'cut': len(ns)::int}] from a
  union all select i - 1, list_concat([list_min(list_transform(list_filter(range(i, len(ns) + 1), lambda j: j = i or list_sum(ns[i:j]) <= cap),
    lambda j: {'n': best[j - i + 1].n + 1, 'big': greatest(list_sum(ns[i:j]), best[j - i + 1].big), 'cut': j::int}))], best) from d, a where i > 0),
w(part, k0) as (select 0, 0 union all select part + 1, best[k0 + 1].cut from w, d where d.i = 0 and k0 < len(best) - 1),
cuts as (select part, k0, lead(k0) over (order by part) as upto from w)
select names[k] as name, k::int as pos, part::int as part from (select names, unnest(range(1, len(names) + 1)) as k from a) join cuts on k > k0 and k <= upto"""
)
def bin_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months of orders packed in order."""
    months = _orders(spark, sf_dir).groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("name")).agg(F.count(F.lit(1)).cast("double").alias("size"))
    # A row per month.
    whole = W.partitionBy()
    sized = months.select("name", "size", F.row_number().over(W.orderBy("name")).alias("pos"), (12 * F.max("size").over(whole)).alias("cap"))
    return packs.bin_layout(sized, F.max("cap"))


_SQL_CLIPS_OF_PARTS = "c as (select p_partkey, p_name as word, p_size::double / (1 + p_partkey % 3) as seconds from part)"
_SQL_MEDIANS = "m as (select length(word)::int as len, median(seconds)::double as median from c group by 1 having count(*) >= 20)"


def _word_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("word"), (F.col("p_size").cast("double") / (1 + F.col("p_partkey") % 3)).alias("seconds"))


@query(f"with {_SQL_CLIPS_OF_PARTS}, {_SQL_MEDIANS} select p_partkey, word, seconds, median, round(seconds / median, 9)::double as ratio from c join m on len = length(word) where seconds > 3.0 * median")
def median_by_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4, P6."""
    clips = _word_clips(spark, sf_dir)
    return durations.suspicious(clips, durations.medians(clips)).select("p_partkey", "word", "seconds", "median", F.round("ratio", 9).alias("ratio"))


@query("""with c as (select case when l_orderkey % 2 = 0 then 5 else 1 + l_partkey % 12 end::int as len, l_extendedprice / 100 as seconds from lineitem) select len, median(seconds)::double as median from c group by 1 having count(*) >= 20""")
def hot_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 where one length has more than half of all clips."""
    letters = F.when(F.col("l_orderkey") % 2 == 0, 5).otherwise(1 + F.col("l_partkey") % 12).cast("int")
    clips = table(spark, sf_dir, "lineitem").select(F.repeat(F.lit("x"), letters).alias("word"), (F.col("l_extendedprice") / 100).alias("seconds"))
    return durations.medians(clips)


@query(
    f"""with {_SQL_CLIPS_OF_PARTS}, w as (select p_partkey, replace(word, ' ', '') as word, seconds from c), t as (select length(word)::int as len, median(seconds)::double as median from w where length(word) <= 10 group by 1 having count(*) >= 20),
x as (select max(len) as longest, arg_max(median, len) as top, max(median) filter (len = 10) as ten from t),
due as (select w.*, coalesce(t.median, case when length(word) > longest then top + (top - ten) / nullif(longest - 10, 0) * (length(word) - longest) end) as due from w cross join x left join t on t.len = length(word))
select p_partkey, word, seconds, due from due where seconds >= 1.8 * due and regexp_matches(word, '^\\p{{L}}{{3,}}$') and lower(word) in (select lower(replace(p_name, ' ', '')) from part where p_size > 10)"""
)
def long_for_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P7, H30."""
    clips = _word_clips(spark, sf_dir).withColumn("word", F.replace(F.col("word"), F.lit(" "), F.lit("")))
    medians = durations.medians(clips.where(F.length("word") <= 10))
    heads = table(spark, sf_dir, "part").where("p_size > 10").select(F.replace(F.col("p_name"), F.lit(" "), F.lit("")).alias("key"))
    return durations.long_for_length(clips, medians, heads).select("p_partkey", "word", "seconds", "due")


_SQL_TAKES = """t as (select l_orderkey as path, l_linenumber as n, l_quantity / 20 as seconds, l_discount * 10 as similarity, l_returnflag as heard from lineitem)"""


def _takes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in takes: line items of an order."""
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("path"), F.col("l_linenumber").alias("n"), (F.col("l_quantity") / 20).alias("seconds"), (F.col("l_discount") * 10).alias("similarity"), F.col("l_returnflag").alias("heard"))
    by = F.array_sort(F.collect_list(F.struct("n", "seconds", "similarity", "heard")))
    return li.groupBy("path").agg(by.alias("takes"))


@query(
    f"""with {_SQL_TAKES}, u as (select * from t where seconds >= 0.25 and seconds <= 2.0), ok as (select path, min(n) as n from u where similarity >= 0.8 group by path), b as (select path, max(similarity) as best from u group by path)
select p.path, case when ok.n is null then 'unsettled' else 'fixed' end as outcome, ok.n as take, best from (select distinct path from t) p left join ok using (path) left join b using (path)"""
)
def respeak_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first acceptable take."""
    d = consensus.first_acceptable(F.col("takes"), lambda t: t["similarity"] >= 0.8, F.lit(2.0))
    return _takes(spark, sf_dir).select("path", d.alias("d")).select("path", "d.outcome", F.col("d.take.n").alias("take"), "d.best")


@query(
    f"""with {_SQL_TAKES}, h as (select * from t where seconds >= 0.25),
ok as (select path, arg_min(n, (seconds, n)) as n from h where similarity >= 0.9 and seconds <= 1.5 group by path),
st as (select path, arg_min(n, (seconds, n)) as n, count(*)::int as steady from h where heard <> 'N' and seconds <= 1.5 and length(heard) > 0 group by path),
f as (select p.path, ok.n as okn, coalesce(steady, 0) as steady, st.n as stn, (p.path % 10) / 10.0 as agreement, (p.path % 3) / 2.0 as confirms, p.path % 4 = 0 as was from (select distinct path from t) p left join ok using (path) left join st using (path)),
o as (select *, case when okn is not null then 'fixed' when steady >= 3 and agreement >= 0.6 and confirms >= 0.7 then 'confirmed' when steady >= 3 and agreement >= 0.6 then 'replaced' when steady > 0 and was then 'forced' else 'unstable' end as outcome from f)
select path, outcome, coalesce(okn, case when outcome in ('replaced', 'forced') then stn end) as take, steady from o"""
)
def settle_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With numeric stand-ins for the judgements."""
    p = F.col("path")
    d = consensus.settle(F.col("takes"), lambda t: t["similarity"] >= 0.9, lambda t: t["seconds"] > 1.5, lambda t: t["heard"] == "N", (p % 10) / 10.0, (p % 3) / 2.0, p % 4 == 0)
    return _takes(spark, sf_dir).select("path", d.alias("d")).select("path", "d.outcome", F.col("d.take.n").alias("take"), "d.steady")


_OUTCOMES = "o as (select user_id as path, event_id as seq, ts, case event_type when 'purchase' then 'fixed' when 'click' then 'unsettled' else event_type end as outcome, value from events)"


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in report: events of a user are reports on one clip."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").alias("path"), F.col("event_id").alias("seq"), "ts", F.when(F.col("event_type") == "purchase", "fixed").when(F.col("event_type") == "click", "unsettled").otherwise(F.col("event_type")).alias("outcome"), "value")


@query(f"with {_OUTCOMES} select path, arg_max(outcome, (ts, seq)) as outcome, arg_max(seq, (ts, seq)) as seq from o group by path")
def last_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10."""
    return reconcile.last_wins(_outcomes(spark, sf_dir), "path", ("ts", "seq")).select("path", "outcome", "seq")


@query(f"with {_OUTCOMES} select path, arg_min(outcome, (ts, seq)) as outcome, arg_min(seq, (ts, seq)) as seq from o group by path")
def first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A12, W10."""
    return reconcile.first_wins(_outcomes(spark, sf_dir), "path", ("ts", "seq")).select("path", "outcome", "seq")


@query(f"with {_OUTCOMES}, r as (select path, seq, ts, case when outcome = 'fixed' and seq % 97 <> 0 then 'bought' else outcome end as outcome from o) select path, arg_max(outcome, (ts, seq)) as outcome, arg_max(seq, (ts, seq)) as seq from r group by path having not bool_or(outcome = 'fixed')")
def absorbing_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A11 over all events; of the purchases one in 97 is `fixed`, as every user has some."""
    rare = F.when((F.col("outcome") == "fixed") & (F.col("seq") % 97 != 0), "bought").otherwise(F.col("outcome"))
    return reconcile.absorbing(_outcomes(spark, sf_dir).withColumn("outcome", rare), "path", ("ts", "seq")).select("path", "outcome", "seq")


@query(f"with {_OUTCOMES}, v as (select path, arg_max(case when value > 50 then 'rambled' else 'ok' end, seq) as verdict from o where seq % 2 = 0 group by path) select path, seq, verdict from o join v using (path) where outcome = 'unsettled' and seq % 2 = 1 and verdict = 'rambled'")
def rescue_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J12, P9."""
    o = _outcomes(spark, sf_dir)
    originals = o.where("seq % 2 = 0").withColumn("verdict", F.when(F.col("value") > 50, "rambled").otherwise("ok"))
    return reconcile.rescue_list(o.where("seq % 2 = 1").select("path", "seq", "outcome"), originals.select("path", "seq", "verdict")).select("path", "seq", "verdict")


@query(
    f"""with {_OUTCOMES}, c as (select path, outcome || seq as word, seq % 3 as report, seq from o where outcome in ('fixed', 'view', 'login') ) select path, arg_max(word, (report, seq)) as word from c group by path"""
)
def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A28."""
    o = _outcomes(spark, sf_dir).withColumn("word", F.concat("outcome", F.col("seq").cast("string")))
    return reconcile.claims(*[o.where(f"seq % 3 = {k}") for k in range(3)], outcomes=("fixed", "view", "login"))


@query(
    f"""with {_OUTCOMES} select path, case when bool_or(outcome = 'view' and seq % 3 = 0) then 'shouted' when bool_or(outcome = 'unsettled') then 'unsettled' else 'held' end as reason from o where outcome in ('unsettled', 'fixed') or (outcome = 'view' and seq % 3 = 0) group by path"""
)
def labelled_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P11."""
    o = _outcomes(spark, sf_dir)
    return reconcile.labelled(("held", o.where("outcome = 'fixed'")), ("unsettled", o.where("outcome = 'unsettled'")), ("shouted", o.where("outcome = 'view' and seq % 3 = 0")))


@query(
    """with e as (select o_orderkey as path, (o_orderkey % 7 + 1)::bigint as expected_size from orders where o_orderkey % 13 <> 0), w as (select l_orderkey as path, count(*)::bigint as written_size from lineitem where l_orderkey % 11 <> 0 group by 1)
select path, expected_size, written_size, case when written_size is null then 'missing' when expected_size is null then 'extra' when expected_size <> written_size then 'size differs' else 'same' end as status from e full outer join w using (path)"""
)
def reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J14, K6, K9."""
    e = _orders(spark, sf_dir).where("id % 13 <> 0").select(F.col("id").alias("path"), (F.col("id") % 7 + 1).alias("size"))
    w = table(spark, sf_dir, "lineitem").where("l_orderkey % 11 <> 0").groupBy(F.col("l_orderkey").alias("path")).agg(F.count(F.lit(1)).alias("size"))
    return reconcile.reconcile(e, w)


@query(
    """select 'missing' as kind, count(*)::bigint as n from orders where o_orderkey not in (select l_orderkey from lineitem where l_linenumber > 3)
union all select 'orphan', count(*) from (select distinct l_orderkey from lineitem where l_orderkey not in (select o_orderkey from orders where o_orderstatus = 'F'))
union all select 'resume', count(*) from orders where o_orderkey not in (select l_orderkey from lineitem where l_linenumber = 5) and o_orderkey not in (select l_orderkey from lineitem where l_linenumber = 6)"""
)
def anti_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1, J4, J10, U3, U5."""
    plan = _orders(spark, sf_dir).select(F.col("id").alias("path"), "o_orderstatus")
    clips = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("path"), "l_linenumber")
    n = lambda kind, df: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), "n")
    return (
        n("missing", planner.missing(plan, clips.where("l_linenumber > 3")))
        .union(n("orphan", planner.orphans(clips.select("path").distinct(), plan.where("o_orderstatus = 'F'"))))
        .union(n("resume", planner.resume(plan, clips.where("l_linenumber = 5"), clips.where("l_linenumber = 6"))))
    )


@query(
    """select o_orderkey as id, case when o_orderkey % 5 = 0 then 'slow' when c_mktsegment = 'BUILDING' then 'low' when c_mktsegment = 'MACHINERY' then 'high' else 'plain' end as voice
from orders left join customer on c_custkey = o_custkey where substr(sha1(o_orderstatus), 1, 16) || ' ' || case when o_orderkey % 5 = 0 then 'slow' when c_mktsegment = 'BUILDING' then 'low' when c_mktsegment = 'MACHINERY' then 'high' else 'plain' end
  is distinct from case when o_orderkey % 4 <> 0 then substr(sha1(o_orderstatus), 1, 16) || ' plain' end""".replace("case when o_orderkey % 5 = 0 then 'slow' ", "case when o_orderkey % 5 = 0 then 'plain' ")
)
def outstanding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clips without a stamp or with another than hash and voice."""
    o = _orders(spark, sf_dir)
    plan = o.select(F.when(F.col("id") % 5 == 0, "word").otherwise("quest").alias("kind"), "id", F.col("id").alias("path"), F.substring(F.sha1(F.col("o_orderstatus").cast("binary")), 1, 16).alias("hash"))
    voice = _orders(spark, sf_dir).join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("id").alias("quest_id"), F.col("c_mktsegment").alias("sex"))
    cast = planner.cast_voices(plan, voice, {"BUILDING": "low", "MACHINERY": "high"}, "plain")
    stamps = plan.where("id % 4 <> 0").select("path", F.concat_ws(" ", "hash", F.lit("plain")).alias("stamp"))
    return planner.outstanding(cast, stamps).select("id", "voice")


@query("select n_name || '_' || n_regionkey as speaker, case when n_nationkey in (1, 2) then 'own' when n_regionkey in (1, 3) then 'by sex' else 'fallback' end as voice from nation")
def cast_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J5b."""
    n = table(spark, sf_dir, "nation").select(F.col("n_name").alias("race"), F.col("n_regionkey").cast("string").alias("sex"), "n_nationkey")
    presets = n.where("n_nationkey in (1, 2)").select(F.concat_ws("_", "race", "sex").alias("name"), F.lit("own").alias("voice")).union(spark.createDataFrame([("1", "by sex"), ("3", "by sex")], "name string, voice string"))
    return planner.cast_by_chain(n, presets, "fallback").select(F.concat_ws("_", "race", "sex").alias("speaker"), "voice")


_SQL_QUEUE = (
    _SQL_ASSIGNED
    + """, q as (select o_orderkey as id, case when o_orderkey % 9 = 0 then 6 else coalesce(p.rank, 5) end as rank, case when o_orderkey % 9 = 0 then 'words' else pack end as pack, case when o_orderkey % 9 = 0 then 0 else o_orderkey end as order_id, case when o_orderkey % 101 = 0 then o_orderkey // 101 end as priority
  from a left join packs p on p.name = a.pack)"""
)


def _queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _assigned(spark, sf_dir).withColumn("kind", F.when(F.col("id") % 9 == 0, "word").otherwise("quest"))
    ranked = planner.release_order(rows.withColumn("pack", F.when(F.col("kind") == "quest", F.col("pack"))), _packs(spark), n_packs=len(PACKS))
    first = _orders(spark, sf_dir).where("id % 101 = 0").select(F.col("id").alias("quest_id"), F.expr("id div 101").alias("pos"))
    return planner.prioritised(ranked, first)


@query(_SQL_QUEUE + " select id, rank::int as rank, order_id::bigint as order_id, priority::bigint as priority from q")
def queue_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1, J17, J11."""
    return _queue(spark, sf_dir).select("id", "rank", "order_id", "priority")


@query(_SQL_QUEUE + ", c as (select pack, rank, count(*)::bigint as clips from q group by 1, 2) select pack, rank::int as rank, clips, sum(clips) over (order by rank, pack)::bigint as through from c")
def cumulative_remaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8, W2."""
    return planner.remaining_by_pack(_queue(spark, sf_dir)).select("pack", "rank", "clips", "through")


_SQL_ENTITY = """g as (select o_orderkey as quest_id, l_linenumber as pos, l_suppkey as npc from lineitem join orders on o_orderkey = l_orderkey),
m as (select s_suppkey as creature, s_nationkey as display from supplier where s_suppkey % 3 <> 0)"""


def _givers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("quest_id"), F.col("l_linenumber").alias("pos"), F.col("l_suppkey").alias("npc"))


@query(
    f"""with {_SQL_ENTITY}, r as (select creature as npc, case when n_regionkey = 0 then '0' else r_name end as race, case when n_nationkey % 2 = 1 then 'female' else 'male' end as sex from m join nation on n_nationkey = display join region on r_regionkey = n_regionkey where display <> 0)
select quest_id, arg_min(npc, (pos, npc)) as npc, arg_min(race, (pos, npc)) as race, arg_min(sex, (pos, npc)) as sex from g join r using (npc) group by quest_id"""
)
def first_resolving_giver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order, supplier, nation, region as quest, giver, display, extra."""
    s, n, r = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    models = s.where("s_suppkey % 3 <> 0").select(F.col("s_suppkey").alias("creature"), F.lit(1).alias("idx"), F.col("s_nationkey").alias("display"))
    display = n.select(F.col("n_nationkey").alias("display"), F.col("n_nationkey").alias("extra"))
    extra = n.select(F.col("n_nationkey").alias("extra"), F.col("n_regionkey").alias("race"), (F.col("n_nationkey") % 2).alias("sex"))
    races = r.where("r_regionkey <> 0").select(F.col("r_regionkey").alias("race"), F.col("r_name").alias("name"))
    return entities.first_resolving_giver(_givers(spark, sf_dir), models, display, extra, races)


@query(
    """with f as (select distinct l_orderkey as quest_id from lineitem where l_suppkey in (select s_suppkey from supplier where s_nationkey = 3)), k as (select o_orderkey as quest_id from orders where o_orderpriority = '1-URGENT')
select (select count(*) from f)::bigint as found, (select count(*) from k)::bigint as known, (select count(*) from f join k using (quest_id))::bigint as "both", (select count(*) from f join k using (quest_id)) / (select count(*) from k)::double as recall"""
)
def zone_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J8, J9, U1, U2."""
    places = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("npc"), F.col("s_nationkey").alias("map"))
    found = entities.on_map(_givers(spark, sf_dir), places, 3)
    return entities.recall(found, _orders(spark, sf_dir).where("o_orderpriority = '1-URGENT'").select(F.col("id").alias("quest_id")))


@query("with f as (select l_orderkey as quest_id, l_suppkey as npc, min(l_linenumber) as k from lineitem group by 1, 2) select quest_id, string_agg(npc::varchar, ',' order by k, npc) as npcs from f group by quest_id")
def ordered_givers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A14, A13, D16."""
    lists = entities.ordered_distinct(_givers(spark, sf_dir), "quest_id", "npc", ("pos",))
    return lists.select("quest_id", F.array_join(F.col("list").cast("array<string>"), ",").alias("npcs"))


@query("with p as (select l_orderkey, count(distinct l_suppkey) as n from lineitem group by 1) select count(*) filter (n = 1)::bigint as one, count(*) filter (n > 1)::bigint as several from p")
def giver_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A20."""
    return entities.givers_summary(_givers(spark, sf_dir))


@query(
    "select r_name as race, case when n_nationkey % 2 = 1 then 'female' else 'male' end as sex, count(*)::bigint as quests from customer join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey group by 1, 2 order by quests desc, race, sex limit 12"
)
def speaker_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A19, O6."""
    c, n, r = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    met = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    return entities.speaker_tally(met.select(F.col("r_name").alias("race"), F.when(F.col("n_nationkey") % 2 == 1, "female").otherwise("male").alias("sex")))


@query("with n as (select o_orderkey, row_number() over (order by o_orderkey) - 1 as i, count(*) over () as c from orders) select o_orderkey from n where i % greatest(1, c // 88) = 0 and i < greatest(1, c // 88) * 88")
def systematic_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sampling operator."""
    return planner.systematic_sample(_orders(spark, sf_dir).select("o_orderkey"), 88, order=("o_orderkey",))


@query("select o_orderkey, o_custkey, o_orderstatus, o_totalprice from (select *, row_number() over (order by o_orderkey) - 1 as i from orders) where i % 4 = 1")
def ordered_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One of four shards by place in the plan's order, whole rows."""
    return planner.shard(_orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"), 1, 4, order=("o_orderkey",))


@query(
    f"""with {_SQL_D}, n as (select quest_id, letter, count(*)::int as clips from d group by 1, 2), g as (select l_orderkey as quest_id, case l_returnflag when 'A' then 'o' when 'N' then 'p' else 'c' end as letter, count(distinct l_linenumber - (l_partkey % 10 = 0)::int)::int as firsts from lineitem group by 1, 2)
select quest_id, letter, clips, firsts = clips as accepted from g join n using (quest_id, letter)"""
)
def accepted_groupings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth part's clips begin with the sentence before, which another clip may begin with too."""
    d = _durations(spark, sf_dir)
    kept = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("quest_id"), F.when(F.col("l_returnflag") == "A", "o").when(F.col("l_returnflag") == "N", "p").otherwise("c").alias("letter"), (F.col("l_linenumber") - (F.col("l_partkey") % 10 == 0).cast("int")).alias("idx"))
    groupings = kept.groupBy("quest_id", "letter").agg(F.collect_set("idx").alias("firsts"))
    return packs.accepted_groupings(groupings, packs.passage_lengths(d)).select("quest_id", "letter", "clips", "accepted")


@query(
    f"""with {_SQL_D}, p as (select quest_id, letter, count(*)::int as n, array_agg(idx order by idx) as xs from d group by 1, 2)
select quest_id, letter, array_to_string(case when quest_id % 5 = 0 then [1] when quest_id % 2 = 0 then xs else range(1, n + 1) end, ',') as firsts from p"""
)
def span_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H6, H5's place in it: grouping row, else one clip per length, else the client's own grouping."""
    per = _durations(spark, sf_dir).groupBy("quest_id", "letter").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list("idx")).alias("xs"))
    passages = per.select("quest_id", "letter", (F.col("quest_id") % 5 != 0).alias("has_starts"), F.col("n").cast("int").alias("n_sentences"), F.array(F.lit(1)).alias("own_firsts"))
    starts = per.where("quest_id % 2 = 0").select("quest_id", "letter", F.col("xs").alias("firsts"))
    lengths = packs.passage_lengths(_durations(spark, sf_dir))
    done = packs.clip_spans(passages, starts, lengths)
    return done.select("quest_id", "letter", F.array_join(F.col("firsts").cast("array<string>"), ",").alias("firsts"))


@query("select s_suppkey as path, s_acctbal as size, 'x' as why from supplier where not (s_suppkey % 3 <> 0 and s_suppkey % 4 <> 0)")
def incremental_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copied unless the target has the size and is no older."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("path"), F.col("s_acctbal").alias("size"), F.lit(10).alias("mtime"))
    t = s.where("path % 3 <> 0").select("path", "size", F.when(F.col("path") % 4 == 0, 9).otherwise(10).alias("mtime"))
    return reconcile.copy_needed(s, t).select("path", "size", F.lit("x").alias("why"))


@query("select s_suppkey as path, case when s_suppkey % 5 = 0 then 'absent' when s_suppkey % 2 = 0 then 'same' else 'copy' end as state from supplier where s_suppkey % 7 <> 0")
def repairs_to_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J13."""
    path = F.concat(F.lit("sounds/w/"), F.col("s_suppkey").cast("string"), F.lit("/x.ogg"))
    s = table(spark, sf_dir, "supplier").select("s_suppkey", path.alias("path"))
    held = s.where("s_suppkey % 7 = 0").select("path")
    source = s.where("s_suppkey % 5 <> 0").select("path", F.lit("a").alias("sha"))
    target = s.select("path", F.when(F.col("s_suppkey") % 2 == 0, "a").otherwise("b").alias("sha"))
    return reconcile.to_copy(s.select("path"), held, source, target).select(F.regexp_extract("path", r"/(\d+)/", 1).cast("bigint").alias("path"), "state")


@query("select n_name as path from nation where n_name not in ('A') and not exists (select 1 from region where n_name = r_name or starts_with(n_name, r_name || '/')) and not starts_with(n_name, 'NATION_1')")
def release_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J22, J23."""
    files = table(spark, sf_dir, "nation").select(F.regexp_replace("n_name", "^NATION_1", "NATION_1/").alias("path"))
    ignored = table(spark, sf_dir, "region").select(F.col("r_name").alias("prefix")).union(spark.createDataFrame([("NATION_1",)], "prefix string"))
    return reconcile.not_ignored(files, ignored)


@query("select doc_id, coalesce(try_cast(case doc_id % 3 when 0 then doc_id::varchar when 1 then '-' || doc_id else 'x-' || doc_id end as bigint), -1) as id from documents where doc_id % 3 = 0")
def id_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Named and negative ids go."""
    d = F.col("doc_id").cast("string")
    raw = F.when(F.col("doc_id") % 3 == 0, d).when(F.col("doc_id") % 3 == 1, F.concat(F.lit("-"), d)).otherwise(F.concat(F.lit("x-"), d))
    return table(spark, sf_dir, "documents").select("doc_id", planner.valid_quest_id(raw).alias("id")).where("id is not null")
