"""Queries over formats, orders, samples and attempts: tables written in a format and read back from it."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions import ident, small
from lectern.operators import attempts, durations, ordering, packs, planner, reconcile
from lectern.sources import binary, staging, text

from .registry import query, spread, table


def _s(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _line(*parts: Column | str) -> Column:
    """Literal pieces and columns as one text; a piece that names no column is a literal."""
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts]).alias("value")


def _escaped(c: Column) -> Column:
    for raw, written in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n")):
        c = F.replace(c, F.lit(raw), F.lit(written))
    return c


@query("select c_custkey, 'Ü ' || c_name as name, c_acctbal from customer")
def jsonl_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written over what was there, and read back strictly."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("Ü "), "c_name").alias("name"), "c_acctbal")
    path = staging.fresh(spark, "rows")
    text.write_jsonl(rows.limit(1), path)
    text.write_jsonl(rows, path)
    return text.jsonl(spark, path, rows.schema)


@query("select s_suppkey as id, s_name as name from supplier where s_suppkey % 4 > 1 union all select n_nationkey, n_name from nation")
def jsonl_tolerant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of four lines one is torn and one blank; a second report is appended, a third doesn't exist."""
    first = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    more = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast(first.schema["id"].dataType).alias("id"), F.col("n_name").alias("name"))
    whole = F.to_json(F.struct("id", "name"))
    path = staging.fresh(spark, "report")
    first.select(F.when(F.col("id") % 4 == 0, F.substring(whole, 1, 9)).when(F.col("id") % 4 == 1, "").otherwise(whole).alias("value")).write.text(path)
    text.write_jsonl(more, path, append=True)
    read = lambda p: text.jsonl(spark, p, first.schema, tolerant=True, missing_ok=True)
    return read(path).union(read(path + "-2"))


@query("select p_partkey as id, p_name as text from part")
def word_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plan partitioned by kind, of which the words are read."""
    words = table(spark, sf_dir, "part").select(F.lit("word").alias("kind"), F.col("p_partkey").cast("long").alias("id"), F.col("p_name").alias("text"))
    quests = table(spark, sf_dir, "supplier").select(F.lit("quest").alias("kind"), F.col("s_suppkey").cast("long").alias("id"), F.col("s_name").alias("text"))
    path = staging.fresh(spark, "plan")
    words.union(quests).write.partitionBy("kind").json(path)
    return text.word_rows(text.jsonl(spark, path, "kind string, id long, text string")).select("id", "text")


@query("""select '"' || p_partkey || '" \\ ' as key, p_name || chr(10) || 'x' as word from part""")
def dictionary_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dictionary lines with escapes, among comments."""
    part = table(spark, sf_dir, "part")
    key, word = F.concat(F.lit('"'), _s("p_partkey"), F.lit('" \\ ')), F.concat("p_name", F.lit("\nx"))
    lines = part.select(F.explode(F.array(_line('  ["', _escaped(key), '"] = { n = 1, word = "', _escaped(word), '" },'), _line('-- word = "', F.col("p_name"), '"'))).alias("value"))
    return text.dictionary(lines).select("key", "word")


def _in_files(rows: DataFrame, *order: str) -> DataFrame:
    """The rows' lines (value) written in order over several files, whose names follow it, and read back with their places."""
    path = staging.fresh(rows.sparkSession, "ordered")
    rows.repartitionByRange(5, *order).sortWithinPartitions(*order).select("value").write.text(path)
    return text.lines(rows.sparkSession, path)


@query("select p_brand as key, arg_min(p_name, p_partkey) as text from part group by 1")
def dictionary_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first word of a key in several files, in their order."""
    part = table(spark, sf_dir, "part").select("p_partkey", _line('["', F.col("p_brand"), '"] = { word = "', F.col("p_name"), '" },'))
    return planner.word_plan(text.dictionary(_in_files(part, "p_partkey"))).select("key", "text")


@query("with l as (select o_custkey as path, row_number() over (order by o_orderkey) - 1 as n from orders) select c_custkey, min(n) as list_pos from customer join l on path = c_custkey group by 1")
def listed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths in the order of lists that name some more than once, numbered over all files."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", _line(" q/", _s("o_custkey"), " "))
    listed = text.path_list(_in_files(orders, "o_orderkey")).select("path", "pos.*")
    numbered = planner.with_row_number(listed, text.LINE_PLACE).select("path", F.col("row_number").alias("pos"))
    rows = table(spark, sf_dir, "customer").select("c_custkey", _line("q/", _s("c_custkey")).alias("path"))
    return planner.restricted(rows, numbered, in_list_order=True).select("c_custkey", "list_pos")


@query("""select 'quest' as kind, c_custkey as id, 'He said "' || c_name || '"' || chr(10) || '{x}' as text, c_mktsegment as flavor from customer""")
def brace_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two blocks in each text, of which one has no id; quotes, braces and line ends in strings."""
    c = table(spark, sf_dir, "customer")
    said = F.concat(F.lit('He said "'), "c_name", F.lit('"\n{x}'))
    whole = _line('T = {\n { ["kind"] = "quest", ["id"] = ', _s("c_custkey"), ', ["text"] = "', _escaped(said), '",\n ["flavor"] = "', F.col("c_mktsegment"), '" },\n { ["kind"] = "word" },\n}')
    return text.brace_blocks(c.select(whole))


@query(
    """select o_orderkey as quest_id, o_custkey || ',' || o_orderkey as npcs from orders union all select o_orderkey + 1, o_custkey::varchar from orders union all select 3, '' from orders"""
)
def marker_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three records in each text, the last without a list."""
    o = table(spark, sf_dir, "orders")
    whole = _line("x {9} q(", _s("o_orderkey"), ', "t", {', _s("o_custkey"), ", ", _s("o_orderkey"), "}, {7}) q(", _s(F.col("o_orderkey") + 1), ", {", _s("o_custkey"), "}) q(3, x)")
    found = text.segments(o.select(whole))
    return found.select("quest_id", F.array_join(F.col("npcs").cast("array<string>"), ",").alias("npcs"))


@query("select 'place' as kind, s_suppkey as of, s_nationkey as id from supplier union select 'place', s_suppkey, 30 from supplier union select 'giver', o_orderkey, o_custkey from orders union select 'giver', o_orderkey, 5 from orders")
def table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maps of creatures, and people of quests, of which some are named twice."""
    s, o = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "orders")
    creatures = s.select(_line("G[", _s("s_suppkey"), "]={'FA ", _s("s_nationkey"), ":67.14,41.30 30:36,70.05 30:1,2>8'}"))
    quests = o.select(_line("G[", _s("o_orderkey"), "]='FA L1 A:", _s("o_custkey"), " T:", _s("o_custkey"), ",5 e0'"))
    both = creatures.union(quests)
    found = text.places(both).select(F.lit("place").alias("kind"), F.col("npc").alias("of"), F.col("map").alias("id"))
    return found.union(text.people(both).select(F.lit("giver"), "quest_id", "npc"))


@query("select l_orderkey as a, l_partkey as b, l_suppkey as c from lineitem union all select l_orderkey, l_linenumber, 0 from lineitem")
def dump_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tuples in each line of one table, among lines of another."""
    li = table(spark, sf_dir, "lineitem")
    own = _line("INSERT INTO `creature` VALUES (", _s("l_orderkey"), ", ", _s("l_partkey"), ",", _s("l_suppkey"), ", 'x'),(", _s("l_orderkey"), ",", _s("l_linenumber"), ",0);")
    lines = li.select(F.explode(F.array(own, _line("INSERT INTO `other` VALUES (1,2,3);"))).alias("value"))
    return text.inserted_triples(lines, "creature", ("a", "b", "c"))


@query(
    """with d as (select l_orderkey as quest_id, l_linenumber as idx, (l_quantity * 10)::int as centis from lineitem)
select quest_id, 'o' as letter, array_to_string(array_agg(centis order by idx, centis), ',') as lengths from d group by 1"""
)
def pack_blobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passage tables as a string field of pack files, taken out and parsed."""
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("quest_id"), F.lit("o").alias("letter"), F.col("l_linenumber").alias("idx"), (F.col("l_quantity") * 10).cast("int").alias("centis"))
    lines = packs.as_table(packs.passage_lengths(li))
    files = lines.select(_line("P = {\n starts = [[\n1 o 1\n]],\n lengths = [[\n", F.col("value"), "\n]],\n}"))
    return packs.parse_table(text.blob(files, "lengths")).select("quest_id", "letter", F.array_join(F.col("lengths").cast("array<string>"), ",").alias("lengths"))


@query("select 'list' as kind, 0 as pos, o_orderkey as quest_id from orders union all select 'list', 1, -o_custkey from orders union all select 'any', 0, o_custkey from orders union all select 'any', 1, 7 from orders")
def id_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both readings, arrays of ids and any runs of digits."""
    o = table(spark, sf_dir, "orders")
    strict = text.id_list(o.select(_line("[", _s("o_orderkey"), ", -", _s("o_custkey"), "]")))
    loose = text.any_ids(o.select(_line("{ q", _s("o_custkey"), ", x-7 }")))
    return strict.select(F.lit("list").alias("kind"), "pos", "quest_id").union(loose.select(F.lit("any"), "pos", "quest_id"))


@query("select length(p_name)::int as len, median(p_size)::double as median from part group by 1 having count(*) >= 20")
def median_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medians as one JSON object, and back."""
    medians = durations.medians(table(spark, sf_dir, "part").select(F.col("p_name").alias("word"), F.col("p_size").cast("double").alias("seconds")))
    return text.median_table(text.as_document(medians, "len", "median"))


@query("select 'q/' || s_suppkey || '.ogg' as path, 'path' as kind from supplier union all select 'Data/' || n_name || '.lua', 'loads' from nation where n_nationkey % 3 <> 0 union all select n_name, 'ignored' from nation")
def path_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Path lists, what a manifest loads and the archive lacks, and ignored prefixes."""
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    listed = text.path_list(s.select(F.explode(F.array(_line("  q/", _s("s_suppkey"), ".ogg\t"), F.lit(" "))).alias("value"))).select("path", F.lit("path").alias("kind"))
    loads = text.manifest(n.select(F.explode(F.array(F.lit("## Title: x"), F.lit(""), _line("Data\\", F.col("n_name"), ".lua "))).alias("value")))
    archive = n.where("n_nationkey % 3 = 0").select(_line("Data/", F.col("n_name"), ".lua").alias("path"))
    ignored = text.ignore_list(n.select(F.explode(F.array(F.lit("ignore:"), _line("    - ", F.col("n_name"), " "))).alias("value")))
    return listed.union(planner.missing(loads, archive).select("path", F.lit("loads"))).union(ignored.select("prefix", F.lit("ignored")))


@query(
    """with r as (select case when p_partkey % 2 = 0 then p_name else '' end as word, case when p_partkey % 3 = 0 then p_brand end as headword, case when p_partkey % 5 = 0 then p_type end as key, p_brand || 'x' as lemma from part)
select distinct coalesce(nullif(word, ''), headword, key, lemma) as key, 'first' as how from r union all (select word, 'every' from r where word <> '' union select key, 'every' from r where key is not null)"""
)
def headword_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first name that is there, and all of two."""
    p = table(spark, sf_dir, "part")
    rows = p.select(F.when(F.col("p_partkey") % 2 == 0, F.col("p_name")).otherwise("").alias("word"), F.when(F.col("p_partkey") % 3 == 0, F.col("p_brand")).alias("headword"), F.when(F.col("p_partkey") % 5 == 0, F.col("p_type")).alias("key"), F.concat("p_brand", F.lit("x")).alias("lemma"))
    return text.headwords(rows).select("key", F.lit("first").alias("how")).union(text.headwords(rows, every=True).select("key", F.lit("every")))


def _bytes(value: Column, n: int) -> Column:
    """A number as n bytes, lowest first."""
    return F.concat(*[F.unhex(F.lpad(F.hex(F.shiftrightunsigned(value.cast("long"), 8 * k).bitwiseAND(255)), 2, "0")) for k in range(n)])


@query("select p_partkey, case when p_partkey % 9 > 0 then (p_partkey * 4) / 2.0 / (p_size * 1000) end::double as wav, case when p_partkey % 7 > 0 then p_partkey * 1000 / 24000.0 else 0 end::double as ogg, case when p_partkey % 7 > 0 then p_partkey * 1000 / 24000.0 end::double as signed from part")
def clip_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers of WAV files and last pages of Ogg streams, some of them broken."""
    p, key = table(spark, sf_dir, "part"), F.col("p_partkey")
    raw = lambda t: F.lit(t).cast("binary")
    rate = F.col("p_size") * 1000
    head = F.concat(raw("fmt "), _bytes(F.lit(16), 4), _bytes(F.lit(1), 2), _bytes(F.lit(1), 2), _bytes(rate, 4), _bytes(rate * 2, 4), _bytes(F.lit(2), 2), _bytes(F.lit(16), 2))
    wav = F.concat(F.when(key % 9 > 0, raw("RIFF")).otherwise(raw("RIFX")), _bytes(F.lit(0), 4), raw("WAVE"), raw("LIST"), _bytes(F.lit(3), 4), raw("abc"), _bytes(F.lit(0), 1), head, raw("data"), _bytes(key * 4, 4))
    page = F.concat(F.when(key % 7 > 0, raw("OggS")).otherwise(raw("Nope")), _bytes(F.lit(0), 2), _bytes(key * 1000, 8), raw("rest"))
    return p.select("p_partkey", wav.alias("w"), page.alias("o")).select("p_partkey", binary.wav_seconds(F.col("w")).alias("wav"), binary.ogg_seconds(F.col("o")).alias("ogg"), binary.ogg_seconds(F.col("o"), signed=True).alias("signed"))


#: Parts of one client table.
TABLE_ROWS = 1000


@query(
    f"""with p as (select p_partkey as id, p_size as size, ((p_partkey * 7919) % 1024)::bigint - 512 as signed, (p_partkey % 25) * 7 as shared, case when p_partkey % 3 = 0 then -p_partkey else 5 end as common from part where p_partkey % 4 <> 3)
select id // {TABLE_ROWS} as file, id, id as own, size, signed, shared, common from p
union all select id // {TABLE_ROWS}, id + 1000000000, id, size, signed, shared, common from p where id % 10 = 0"""
)
def packed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts written as packed client tables, and read back from them by section and range of rows.

    A file has a thousand keys: sections of the keys that leave 0, 1 or 2 by four (the second without a list of
    ids) and an encrypted one; a plain, a packed, a signed, an indexed and a common field; every tenth key is copied.
    """
    key = F.col("p_partkey")
    value = key.bitwiseOR(F.shiftleft(F.col("p_size").cast("long"), 32)).bitwiseOR(F.shiftleft(((key * 7919) % 1024 - 512).bitwiseAND(1023), 38)).bitwiseOR(F.shiftleft(key % 25, 48))
    p = table(spark, sf_dir, "part").select(F.floor(key / TABLE_ROWS).alias("file"), key.alias("id"), (key % 4).cast("int").alias("section"), _bytes(value, 7).alias("record"))
    told = lambda when, of: F.unhex(F.array_join(F.transform(F.sort_array(F.collect_list(F.when(when, F.struct("id", F.hex(of).alias("b"))))), lambda x: x["b"]), ""))
    id4, of = _bytes(F.col("id"), 4), [F.col("section") == k for k in range(3)]
    blocks = p.groupBy("file").agg(
        told(F.col("id") % 3 == 0, F.concat(id4, _bytes(-F.col("id"), 4))).alias("common"),
        *[told(of[k], F.col("record")).alias(f"r{k}") for k in range(3)], *[told(of[k], id4).alias(f"i{k}") for k in (0, 2)],
        *[told(of[k] & (F.col("id") % 10 == 0), F.concat(_bytes(F.col("id") + 1_000_000_000, 4), id4)).alias(f"c{k}") for k in range(3)],
    )
    blocks = blocks.withColumn("i1", F.lit(b""))
    u2, u4 = (lambda v: _bytes(F.lit(v) if isinstance(v, int) else v, 2)), (lambda v: _bytes(F.lit(v) if isinstance(v, int) else v, 4))
    size = lambda name: F.octet_length(name)
    fields = [(0, 32, 0, 0, 0, 0, 0), (32, 6, 0, 1, 0, 0, 0), (38, 10, 0, 5, 0, 0, 0), (48, 8, 100, 3, 0, 0, 0), (0, 0, 0, 2, 5, size("common"), 0)]
    pallet = F.concat(*[u4(7 * k) for k in range(25)])
    head = F.concat(F.rpad(F.lit(b"WDC5"), 136, F.lit(b"\0")), *[u4(v) for v in (0, 5, 7, 0, 0, 0, 0, 0, 0)], u2(0), u2(0), *[u4(v) for v in (5, 0, 0, 120)], u4(size("common")), u4(100), u4(4))
    start, sections = 136 + 68 + 4 * 40 + 4 * 5 + 5 * 24 + 100 + size("common"), []
    for k in range(3):
        sections += [u4(0), u4(0), u4(start), u4((size(f"r{k}") / 7).cast("long")), u4(0), u4(0), u4(size(f"i{k}")), u4(0), u4(0), u4(size(f"c{k}"))]
        start = start + size(f"r{k}") + size(f"i{k}") + size(f"c{k}")
    sections += [u4(9), u4(9), u4(0), u4(999)] + [u4(0)] * 6
    stored = [f(v) for field in fields for f, v in zip((u2, u2, u4, u4, u4, u4, u4), field)]
    body = [F.col(f"{name}{k}") for k in range(3) for name in "ric"]
    files = blocks.select(F.col("file").cast("string").alias("path"), F.concat(head, *sections, F.concat(*[u4(0)] * 5), *stored, pallet, F.col("common"), *body).alias("content"))
    folder = staging.fresh(spark, "client_tables")
    files.write.parquet(folder)
    v = lambda k: F.get("vals", F.lit(k))
    read = binary.packed_rows(spark.read.parquet(folder), rows=100)
    return read.select(F.col("path").cast("long").alias("file"), "id", v(0).alias("own"), v(1).alias("size"), v(2).alias("signed"), v(3).alias("shared"), v(4).alias("common"))


@query("select p_brand as path, sum(length(p_partkey || ' ' || p_name) + 1)::bigint as size from part group by p_brand")
def listed_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every brand's parts written as files of a folder of their own, and listed with their sizes."""
    clips, lines = staging.fresh(spark, "clips"), table(spark, sf_dir, "part").select(F.col("p_brand").alias("brand"), F.concat_ws(" ", "p_partkey", "p_name").alias("value"))
    lines.repartition("brand").write.partitionBy("brand").text(clips)
    listed = binary.listing(spark, clips, "*.txt").select(F.url_decode(F.regexp_extract("path", "brand=([^/]+)/", 1)).alias("path"), "size")
    return listed.groupBy("path").agg(F.sum("size").alias("size"))


@query(
    r"""with e as (select event_id, user_id, value, (event_id % 14)::bigint as n from events)
select event_id, case when n > 0 then least(greatest(value - 20, 0.0), n) / n else 0.0 end::double as progress,
  case when event_id % 2 = 0 then format('{:,}', event_id) || ' and up' else format('{:,}', event_id) || '–' || format('{:,}', event_id + 99) end as range,
  case when n = 0 then '' when n = 1 then 'a' when n = 2 then 'a and b' else 'a, b and c' end as joined,
  coalesce(['one', 'two', 'three', 'four', 'five', 'six', 'seven', 'eight', 'nine', 'ten', 'eleven', 'twelve'][n], n::varchar) as word,
  'v' || user_id as suffix, case when n = 0 then 'q' || user_id else 'c' || n end as speaker, (value / 1.009)::double as cap,
  '\195\132' || '\034' || n || '\092' as literal from e"""
)
def small_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H39-H43, H45, H48."""
    e = table(spark, sf_dir, "events").withColumn("n", F.col("event_id") % 14)
    n, id_ = F.col("n"), F.col("event_id")
    client = F.when(n == 0, "").otherwise(F.concat(F.lit("c"), _s(n)))
    return e.select(
        "event_id", small.progress(F.col("value") - 20, n).alias("progress"), small.range_label(id_, F.when(id_ % 2 == 0, F.lit(10**9)).otherwise(id_ + 99)).alias("range"),
        small.joined_with_and(F.slice(F.array(F.lit("a"), F.lit("b"), F.lit("c")), F.lit(1), F.least(n, F.lit(3)).cast("int"))).alias("joined"), small.number_word(n).alias("word"),
        small.folder_suffix(F.concat(F.lit("Pack-x-v"), _s("user_id"))).alias("suffix"), small.speaker_label(client, F.concat(F.lit("q"), _s("user_id"))).alias("speaker"),
        small.capped(F.col("value")).alias("cap"), small.escape_literal(F.concat(F.lit('Ä"'), _s(n), F.lit("\\"))).alias("literal"),
    )


@query("select p_partkey, row_number() over (order by length(p_name), p_partkey) - 1 as row_number from part")
def suspects_by_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2."""
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey"), F.col("p_name").alias("word"), F.col("p_partkey").alias("seq"))
    return ordering.by_length(rows).select("p_partkey", "row_number")


@query("select path, row_number() over (order by length(replace(h, ' ', '')) / greatest(length(replace(w, ' ', '')), 1), path) - 1 as row_number from (select p_partkey as path, p_name as w, substr(p_name, 1, (p_partkey % 9)::int) as h from part)")
def worst_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3."""
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("path"), F.col("p_name").alias("want"), F.expr("substring(p_name, 1, int(p_partkey % 9))").alias("heard"))
    return ordering.worst_first(rows).select("path", "row_number")


@query("select l_orderkey, l_linenumber, row_number() over (order by l_quantity desc, l_discount, l_returnflag, l_orderkey, l_linenumber) - 1 as row_number from lineitem")
def longest_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O4."""
    li = table(spark, sf_dir, "lineitem")
    rows = li.select(F.col("l_quantity").alias("ratio"), F.col("l_discount").alias("similarity"), F.col("l_returnflag").alias("word"), F.col("l_orderkey").alias("path"), F.col("l_linenumber").alias("folder"))
    return ordering.longest_first(rows).select(F.col("path").alias("l_orderkey"), F.col("folder").alias("l_linenumber"), "row_number")


@query("select n_name, row_number() over (order by k is null, k desc, n_name) - 1 as row_number from (select n_name, case when n_regionkey = 2 then n_nationkey end as k from nation)")
def known_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nations of one region come first, last of them foremost; the rest by name."""
    n = table(spark, sf_dir, "nation")
    known = n.where("n_regionkey = 2").select(F.col("n_name").alias("name"), (-F.col("n_nationkey")).alias("pos"))
    return ordering.known_first(n.select(F.col("n_name").alias("name")), known).select(F.col("name").alias("n_name"), "row_number")


@query("select o_orderkey, 'sample' as how from (select o_orderkey from orders order by md5('11:' || o_orderkey), o_orderkey limit 40) union all select o_orderkey, 'preview' from (select o_orderkey from orders order by o_totalprice, o_orderkey limit 15)")
def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A seeded sample and a preview, whose sizes are the feature."""
    o = table(spark, sf_dir, "orders")
    sample = ordering.seeded_sample(o.select("o_orderkey"), 40, 11, "o_orderkey").select("o_orderkey", F.lit("sample").alias("how"))
    return sample.union(ordering.preview(o.select("o_orderkey", "o_totalprice"), 15, "o_totalprice", "o_orderkey").select("o_orderkey", F.lit("preview")))


@query("select l_linenumber as rate, count(*) as n from lineitem group by 1")
def rate_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A22."""
    return durations.histogram(table(spark, sf_dir, "lineitem").select(F.col("l_linenumber").alias("rate")), "rate")


@query(
    """with p as (select p_partkey * 100 as original, case when p_partkey % 7 > 0 then p_partkey * 30 end as encoded, case when p_partkey % 5 > 0 then p_size end as seconds, p_size / 8.0 as head, p_size / 16.0 as tail from part)
select sum(original)::bigint as original, sum(encoded)::bigint as encoded, count(*) filter (encoded is null) as failed, 100.0 * sum(encoded) / sum(original) as percent,
  100.0 * sum(case when seconds is not null then head + tail end) / greatest(sum(seconds), 0.001) as silence from p"""
)
def size_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A26."""
    k, s = F.col("p_partkey"), F.col("p_size").cast("double")
    return durations.size_shares(table(spark, sf_dir, "part").select((k * 100).alias("original"), F.when(k % 7 > 0, k * 30).alias("encoded"), F.when(k % 5 > 0, s).alias("seconds"), (s / 8).alias("head"), (s / 16).alias("tail")))


@query(
    """with e as (select event_id, case event_id % 4 when 0 then event_id || '_o' || (event_id % 9) when 1 then event_id || 'o1' when 2 then 'x_' || event_id else event_id || '_p' end as stem,
  case event_id % 3 when 0 then event_id || '!' when 1 then '' else event_id || 'a' end as heard from events)
select event_id, event_id as quest, 'o' as letter, (event_id % 9)::int as idx from e where event_id % 4 = 0 and event_id % 3 <> 0"""
)
def guarded_stems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clips of well-formed stems, less those heard as numerals."""
    id_ = F.col("event_id")
    k = id_ % 4
    stem = F.when(k == 0, F.concat(_s(id_), F.lit("_o"), _s(id_ % 9))).when(k == 1, F.concat(_s(id_), F.lit("o1"))).when(k == 2, F.concat(F.lit("x_"), _s(id_))).otherwise(F.concat(_s(id_), F.lit("_p")))
    heard = F.when(id_ % 3 == 0, F.concat(_s(id_), F.lit("!"))).when(id_ % 3 == 1, "").otherwise(F.concat(_s(id_), F.lit("a")))
    rows = table(spark, sf_dir, "events").select("event_id", ident.stem_parts(stem).alias("p"), heard.alias("heard"))
    return reconcile.without_numerals(rows).where("p is not null").select("event_id", "p.quest", "p.letter", "p.idx")


@query("select o_orderkey as path, case when o_orderkey % 50 = 0 then 'ValueError: bad clip ' || o_orderkey else substr(sha1(o_orderstatus), 1, 16) || ' low' end as said from orders")
def attempts_by_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One clip in fifty fails its batch; tried again it is named, and all others are stamped."""

    def work(batch: pd.DataFrame) -> pd.Series:
        bad = batch["path"][batch["path"] % 50 == 0]
        if len(bad):
            raise ValueError(f"bad clip {bad.iloc[0]}")
        return batch["hash"]

    plan = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("path"), ident.text_hash(F.col("o_orderstatus")).alias("hash"), F.lit("low").alias("voice"))
    return attempts.said(attempts.attempted(spread(plan), work))
