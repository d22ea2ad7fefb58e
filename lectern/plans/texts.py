"""Queries over passages: segmentation, identity, planning, words."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions import ident, match, small, text
from lectern.operators import consensus, durations, planner

from .registry import query, spread, table

#: The SQL twins of `tidy`, `sentences` and `grouped`, as common table expressions.
SQL_TIDY = r"""
tidied as (select doc_id, lang, source, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
  coalesce(text, ''), '\r\n?', chr(10), 'g'), '[ \t]+', ' ', 'g'), '[,;:]\s*([,.;:!?])', '\1', 'g'), '\s+([,.;:!?])', '\1', 'g'),
  '\n{3,}', chr(10) || chr(10), 'g'), '[ \t\r\f\v]*\n[ \t\r\f\v]*', chr(10), 'g'), '^\s+|\s+$', '', 'g') as t from documents)"""
SQL_SENTENCES = (
    SQL_TIDY
    + r""",
tokens as (select *, regexp_extract_all(t, '\s*\S+') as toks from tidied),
bared as (select *, list_transform(toks, lambda x: regexp_replace(x, '^\s+|["''>)\]“”’»]+$', '', 'g')) as bare from tokens),
ended as (select *, list_filter(range(1, len(toks) + 1), lambda i: i = len(toks) or regexp_matches(toks[i + 1], '^\s*[\r\n]')
  or (regexp_matches(bare[i], '[.!?…]$') and lower(bare[i]) not in ('dr.', 'mr.', 'mrs.', 'ms.', 'z.b.', 'd.h.', 'bzw.', 'e.g.', 'i.e.'))) as ends from bared),
sentenced as (select doc_id, lang, source, t, list_transform(ends, lambda e, k: regexp_replace(array_to_string(toks[(case when k = 1 then 1 else ends[k - 1] + 1 end):e], ''), '^\s+|\s+$', '', 'g')) as ss from ended)"""
)
SQL_CLIPS = (
    SQL_SENTENCES
    + r""",
lifted as (select doc_id, lang, source, list_prepend({'done': []::struct(text varchar, first int, last int)[], 't': '', 'f': 0, 'n': 0},
  list_transform(ss, lambda s: {'done': []::struct(text varchar, first int, last int)[], 't': s, 'f': 0, 'n': 0})) as xs from sentenced),
folded as (select doc_id, lang, source, list_reduce(xs, lambda a, x: case
  when a.t = '' then (case when length(x.t) >= 30 then {'done': list_append(a.done, {'text': x.t, 'first': a.n + 1, 'last': a.n + 1}), 't': '', 'f': a.n + 1, 'n': a.n + 1} else {'done': a.done, 't': x.t, 'f': a.n + 1, 'n': a.n + 1} end)
  when length(a.t) + 1 + length(x.t) > 420 then (case when length(x.t) >= 30
    then {'done': list_append(list_append(a.done, {'text': a.t, 'first': a.f, 'last': a.n}), {'text': x.t, 'first': a.n + 1, 'last': a.n + 1}), 't': '', 'f': a.n + 1, 'n': a.n + 1}
    else {'done': list_append(a.done, {'text': a.t, 'first': a.f, 'last': a.n}), 't': x.t, 'f': a.n + 1, 'n': a.n + 1} end)
  when length(a.t) + 1 + length(x.t) >= 30 then {'done': list_append(a.done, {'text': a.t || ' ' || x.t, 'first': a.f, 'last': a.n + 1}), 't': '', 'f': a.f, 'n': a.n + 1}
  else {'done': a.done, 't': a.t || ' ' || x.t, 'f': a.f, 'n': a.n + 1} end) as a from lifted),
closed as (select doc_id, lang, source, case when a.t = '' then a.done
  when len(a.done) > 0 and length(a.done[-1].text) + 1 + length(a.t) <= 420 then list_append(a.done[:len(a.done) - 1], {'text': a.done[-1].text || ' ' || a.t, 'first': a.done[-1].first, 'last': a.n})
  else list_append(a.done, {'text': a.t, 'first': a.f, 'last': a.n}) end as cs from folded),
clips as (select doc_id, lang, source, unnest(range(1, len(cs) + 1)) as i, unnest(cs) as c from (
  select doc_id, lang, source, list_filter(cs, lambda c: regexp_matches(c.text, '\p{L}')) as cs from closed))"""
)


def _clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents"))
    each = docs.select("doc_id", "lang", "source", F.posexplode(text.clips(text.tidy(F.col("text")))).alias("i", "c"))
    return each.select("doc_id", "lang", "source", (F.col("i") + 1).cast("bigint").alias("sentence"), F.col("c.text").alias("text"), F.col("c.first").alias("first"), F.col("c.last").alias("last"))


@query("with" + SQL_SENTENCES + " select doc_id, unnest(range(1, len(ss) + 1))::bigint as n, unnest(ss) as sentence from sentenced")
def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H2, W5."""
    docs = spread(table(spark, sf_dir, "documents"))
    each = docs.select("doc_id", F.posexplode(text.sentences(text.tidy(F.col("text")))).alias("i", "sentence"))
    return each.select("doc_id", (F.col("i") + 1).cast("bigint").alias("n"), "sentence")


@query("with" + SQL_CLIPS + " select doc_id, i::bigint as sentence, c.text as text, c.first as first, c.last as last from clips")
def clips_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1 (tidy), H3, W1."""
    return _clips(spark, sf_dir).drop("lang", "source")


@query(
    "with"
    + SQL_CLIPS
    + """, per as (select doc_id, array_agg(c.first order by i) as firsts, max(c.last) as top from clips group by doc_id),
n as (select doc_id, len(ss) as n from sentenced)
select doc_id, array_to_string(firsts, ',') as firsts, n::int as n_sentences, firsts = range(1, n + 1) as plain from per join n using (doc_id)"""
)
def clip_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H4: where clips begin, and whether they are one for each sentence."""
    tidy = spread(table(spark, sf_dir, "documents")).select("doc_id", text.tidy(F.col("text")).alias("t"))
    # The sentences are found once, for the clips and for their number.
    once = text.let(text.paragraphs(F.col("t")), lambda p: F.struct(text.clips_of(p).alias("cs"), F.size(F.flatten(p)).alias("n_sentences")))
    # Generated columns aren't worked out again for each use, as projected ones are.
    both = tidy.select("doc_id", F.inline(F.array(once))).where(F.size("cs") > 0)
    return both.select("doc_id", F.array_join(F.transform("cs", lambda c: c["first"].cast("string")), ",").alias("firsts"), "n_sentences", text.is_plain(F.col("cs"), F.col("n_sentences")).alias("plain"))


@query(
    "with"
    + SQL_CLIPS.replace("list_filter(cs, lambda c: regexp_matches(c.text, '\\p{L}'))", "list_filter(cs, lambda c: regexp_matches(c.text, '[A-Za-z]|[^\\x00-\\x7f]'))")
    + """ select lang, count(*)::bigint as client, count(*) filter (regexp_matches(c.text, '\\p{L}'))::bigint as own from clips group by lang"""
)
def grouping_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H5: clips by the client's grouping, and how many of them the generator has too."""
    docs = spread(table(spark, sf_dir, "documents"))
    each = docs.select("lang", F.explode(text.client_clips(text.tidy(F.col("text")))).alias("c"))
    return each.groupBy("lang").agg(F.count(F.lit(1)).alias("client"), F.count_if(F.col("c.text").rlike(r"\p{L}")).alias("own"))


SQL_PATH = "'sounds/q/' || lpad((doc_id % 100)::varchar, 2, '0') || '/' || doc_id || '_o' || i || '.ogg'"


@query(
    "with"
    + SQL_CLIPS
    + f""", plan as (select source, {SQL_PATH} as path, substr(sha1(c.text), 1, 16) as hash, doc_id, i, length(c.text) as chars from clips)
select source, count(*) as clips, count(*) filter (doc_id % 7 = 0) as missing,
  count(*) filter (doc_id % 7 <> 0 and (i % 5 = 0 or doc_id % 11 = 0)) as stale,
  count(*) filter (doc_id % 7 <> 0 and i % 5 <> 0 and doc_id % 11 <> 0) as done, sum(chars)::bigint as chars from plan group by source"""
)
def plan_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is missing, stale or done per source.

    The inventory lacks the clips of every seventh document; the previous plan has other hashes for
    every fifth clip and doesn't know every eleventh document.
    """
    clips = _clips(spark, sf_dir)
    plan = clips.select(F.lit("quest").alias("kind"), "source", "doc_id", "sentence", ident.quest_path(F.col("doc_id"), F.lit("description"), F.col("sentence")).alias("path"), F.length("text").alias("chars"), ident.text_hash(F.col("text")).alias("hash"))
    # Made once and read three times; on disk, as it grows with the texts.
    plan = plan.persist(StorageLevel.DISK_ONLY)
    inventory = plan.where("doc_id % 7 <> 0").select("path")
    previous = plan.where("doc_id % 11 <> 0").select("path", F.when(F.col("sentence") % 5 == 0, F.lit("old")).otherwise(F.col("hash")).alias("hash"))
    status = planner.plan_status(plan, inventory, previous)
    n = lambda s: F.count_if(F.col("status") == s).alias(s)
    return status.groupBy("source").agg(F.count(F.lit(1)).alias("clips"), n("missing"), n("stale"), n("done"), F.sum("chars").alias("chars"))


@query("with" + SQL_CLIPS + f" select doc_id, i::bigint as sentence, {SQL_PATH} as path, true as valid, true as shaped, substr(sha1(c.text), 1, 16) as hash from clips")
def clip_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H8, H11, P3."""
    path = ident.quest_path(F.col("doc_id"), F.lit("description"), F.col("sentence"))
    return _clips(spark, sf_dir).select("doc_id", "sentence", path.alias("path"), ident.valid_path(path).alias("valid"), ident.clip_path_shape(path).alias("shaped"), ident.text_hash(F.col("text")).alias("hash"))


@query("select doc_id, substr(sha1(coalesce(text, '')), 1, 16) as hash from documents")
def text_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H8."""
    return table(spark, sf_dir, "documents").select("doc_id", ident.text_hash(F.col("text")).alias("hash"))


def _sql_fnv(start: int) -> str:
    return (
        "list_reduce(list_prepend(" + str(start) + "::ubigint, list_transform(range(1, length(hex(encode(w))) + 1, 2), lambda i: ('0x' || substr(hex(encode(w)), i, 2))::int::ubigint)), "
        "lambda h, b: (xor(h, b) * 16777619::ubigint) % 4294967296::ubigint)"
    )


@query(
    f"""with words as (select p_name as w from part union select n_name from nation),
d as (select w, lower(lpad(hex({_sql_fnv(2166136261)}), 8, '0')) || lower(lpad(hex({_sql_fnv((2166136261 ^ 1) * 16777619 % 2**32)}), 8, '0')) as digest from words)
select w as word, digest, 'sounds/w/' || substr(digest, 1, 2) || '/' || digest || '.ogg' as path from d"""
)
def word_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H9-H11."""
    words = table(spark, sf_dir, "part").select(F.col("p_name").alias("word")).union(table(spark, sf_dir, "nation").select("n_name")).distinct()
    return words.select("word", ident.word_digest(F.col("word")).alias("digest"), ident.word_path(F.col("word")).alias("path"))


@query(
    r"""select doc_id, md5(replace(lower(regexp_replace(coalesce(text, ''), '[^\p{L}\p{N}\p{M}_]+', '', 'g')), 'ß', 'ss')) as normalised,
md5(regexp_replace(lower(coalesce(text, '')), '[\p{P}\p{Z}\p{C}]', '', 'g')) as edges,
md5(lower(coalesce(text, ''))) as folded,
md5(translate(replace(replace(coalesce(text, ''), 'ß', 'ss'), 'ẞ', 'ss'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZÄÖÜ', 'abcdefghijklmnopqrstuvwxyzäöü')) as word_key from documents"""
)
def fold_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H12-H15."""
    t = F.col("text")
    return spread(table(spark, sf_dir, "documents")).select(
        "doc_id", F.md5(text.normalise(t)).alias("normalised"), F.md5(text.fold_edges(t)).alias("edges"), F.md5(text.fold_case(t)).alias("folded"), F.md5(text.word_key(t)).alias("word_key")
    )


@query(
    r"""select doc_id, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[^\p{L}\p{N}\p{M}_''’-]+'), lambda p: p <> ''))::int as n_pieces,
len(list_filter(regexp_extract_all(coalesce(text, ''), '\p{L}+'), lambda p: length(p) > 1))::int as n_words from documents"""
)
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H16, H17."""
    return spread(table(spark, sf_dir, "documents")).select("doc_id", F.size(text.pieces(F.col("text"))).alias("n_pieces"), F.size(text.word_tokens(F.col("text"))).alias("n_words"))


@query(
    r"""select lower(w) as key, arg_min(w, (doc_id, i)) as word, count(*)::bigint as n from (
  select doc_id, unnest(ws) as w, unnest(range(len(ws))) as i from (select doc_id, list_filter(regexp_extract_all(coalesce(text, ''), '\p{L}+'), lambda p: length(p) > 1) as ws from documents where lang = 'de'))
where lower(w) not in (select lower(unnest(regexp_extract_all(text, '\p{L}+'))) from benchmark) group by 1"""
)
def new_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of German documents that no benchmark item has, in first-seen spelling."""
    docs = table(spark, sf_dir, "documents").where("lang = 'de'").select(F.col("doc_id").alias("pos"), "text")
    known = table(spark, sf_dir, "benchmark").select(F.explode(F.regexp_extract_all("text", F.lit(r"\p{L}+"), F.lit(0))).alias("key"))
    fresh = planner.new_words(docs, known)
    counts = docs.select(F.explode(text.word_tokens(F.col("text"))).alias("w")).groupBy(text.fold_case(F.col("w")).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return fresh.join(counts, "key").select("key", "word", "n")


@query(
    r"""with d as (select lang, lower(unnest(list_filter(regexp_extract_all(coalesce(text, ''), '\p{L}+'), lambda p: length(p) > 1))) as w from documents),
k as (select distinct lower(unnest(regexp_extract_all(text, '\p{L}+'))) as w from benchmark)
select lang, count(*)::bigint as words, count(k.w)::bigint as known from d left join k using (w) group by lang"""
)
def word_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many running words of each language the benchmark's vocabulary knows."""
    words = spread(table(spark, sf_dir, "documents")).select("lang", F.explode(text.word_tokens(F.col("text"))).alias("w")).select("lang", F.lower("w").alias("w"))
    # Counted per word first, so that a frequent word is one row when it meets the vocabulary.
    counted = words.groupBy("lang", "w").agg(F.count(F.lit(1)).alias("n"))
    known = table(spark, sf_dir, "benchmark").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))).alias("w")).distinct().withColumn("k", F.lit(1))
    return counted.join(known, "w", "left").groupBy("lang").agg(F.sum("n").alias("words"), F.sum(F.when(F.col("k") == 1, F.col("n")).otherwise(0)).alias("known"))


_PAIRS = """with pairs as (select c.conv_id, c.turn, p.p_name as want, coalesce(c.text, '') as said
  from conversations c join part p on p.p_partkey = (c.conv_id * 8 + c.turn) % (select greatest(count(*), 1) from part) + (select coalesce(min(p_partkey), 0) from part)),
heard as (select *, case turn % 6 when 0 then want when 1 then want || ' ' || want when 2 then substr(want, 1, 4) when 3 then '' when 4 then said || ' ' || want || ' x' else said end as heard from pairs),
n as (select *, replace(lower(regexp_replace(want, '[^\\p{L}\\p{N}\\p{M}_]+', '', 'g')), 'ß', 'ss') as a, replace(lower(regexp_replace(heard, '[^\\p{L}\\p{N}\\p{M}_]+', '', 'g')), 'ß', 'ss') as b,
  regexp_replace(lower(want), '[\\p{P}\\p{Z}\\p{C}]', '', 'g') as fa, regexp_replace(lower(heard), '[\\p{P}\\p{Z}\\p{C}]', '', 'g') as fb from heard)"""


def _heard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in transcripts of every shape: whole turns of conversations, dealt over all part names."""
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("want"))
    n, least = part.agg(F.count(F.lit(1)), F.min("p_partkey")).first()
    conv = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("said"))
    pairs = conv.join(part, F.pmod(F.col("conv_id") * 8 + F.col("turn"), F.lit(max(n, 1))) + F.lit(least or 0) == F.col("p_partkey")).drop("p_partkey")
    want, said, k = F.col("want"), F.col("said"), F.col("turn") % 6
    heard = F.when(k == 0, want).when(k == 1, F.concat(want, F.lit(" "), want)).when(k == 2, F.substring(want, 1, 4)).when(k == 3, "").when(k == 4, F.concat(said, F.lit(" "), want, F.lit(" x"))).otherwise(said)
    return pairs.withColumn("heard", heard).drop("said")


@query(
    _PAIRS
    + """ select conv_id, turn, want, heard, case when b = '' then 'silent' when a = b then 'ok' when a <> '' and contains(b, a) then (case when length(b) >= 2 * length(a) then 'rambled' else 'ok-ish' end)
  when contains(a, b) then 'clipped' else 'different' end as verdict, a <> '' and length(b) > greatest(3 * length(a), length(a) + 12) as rambling,
  case when fb <> '' and fa <> fb and contains(fa, fb) then 'clipped' when fa <> '' and fa <> fb and ends_with(fb, fa) then 'false start'
  when fa <> '' and starts_with(fb, fa) and length(fb) - length(fa) >= 4 then 'trailing' end as edge from n"""
)
def classify_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H13, H18, H20 (without `many`), H27, P8, P10."""
    w, h = F.col("want"), F.col("heard")
    return _heard(spark, sf_dir).select("conv_id", "turn", "want", "heard", match.classify(w, h).alias("verdict"), match.rambles(w, h).alias("rambling"), F.when(~match.has_filler(w, h) | match.still_clipped(w, h) | match.still_false_start(w, h), match.edge_fault(w, h)).otherwise(F.lit(None)).alias("edge"))


@query()
def classify_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows only, as matching-block similarity isn't SQL. Distinct pairs are scored once."""
    w, h = F.col("want"), F.col("heard")
    pairs = spread(_heard(spark, sf_dir))
    # What the UDFs read is made natively below the distinct; they take plain columns.
    inputs = pairs.select("want", "heard", text.normalise(w).alias("a"), text.normalise(h).alias("b"), F.transform(text.pieces(h), text.normalise).alias("parts"), match.sound_code(w).alias("sa"), match.sound_code(h).alias("sb")).distinct()
    scored = inputs.withColumn("similarity", match.block_ratio(F.col("a"), F.col("b"))).withColumn("best", match.best_ratio(F.col("a"), F.col("parts")))
    sounded = scored.withColumn("sound", match.sound_similarity(F.col("sa"), F.col("sb")))
    s, o = F.col("similarity"), F.col("sound")
    judged = sounded.select(
        "want", "heard", "similarity", "sound", match.classify(w, h, s, F.col("best")).alias("verdict"), match.acceptable(w, h, s).alias("base"), match.acceptable(w, h, s, rescue=True).alias("rescue"),
        match.acceptable_settled(w, h, s).alias("settled"), match.acceptable_edges(w, h, s).alias("edges"), match.acceptable_sound(w, h, s, o).alias("by_sound"), match.acceptable_initial(w, h, s).alias("initial"),
    )
    return pairs.join(judged, ["want", "heard"]).select("conv_id", "turn", *judged.columns)


@query(
    _PAIRS
    + """, v as (select case when b = '' then 'silent' when a = b then 'ok' when a <> '' and contains(b, a) then (case when length(b) >= 2 * length(a) then 'rambled' else 'ok-ish' end)
  when contains(a, b) then 'clipped' else 'different' end as verdict from n)
select verdict, count(*)::bigint as n, round(count(*) * 100.0 / sum(count(*)) over (), 6)::double as percent from v group by verdict"""
)
def verdict_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2."""
    rows = _heard(spark, sf_dir).select(match.classify(F.col("want"), F.col("heard")).alias("verdict"))
    return durations.verdict_histogram(rows).select("verdict", "n", F.round("percent", 6).alias("percent"))


@query(
    _PAIRS
    + """ select length(want)::int as len, count(*)::bigint as n from n where b = '' or (a <> '' and length(b) > greatest(3 * length(a), length(a) + 12)) group by 1 order by 1 limit 10"""
)
def defects_by_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Certain defects by word length, the ten shortest lengths."""
    w, h = F.col("want"), F.col("heard")
    bad = _heard(spark, sf_dir).where((match.classify(w, h) == "silent") | match.rambles(w, h))
    return durations.defects_by_length(bad.select(w.alias("word")))


_SQL_SOUND = """with names as (select distinct n as name, regexp_replace(upper(n), '[^A-Z]', '', 'g') as w from (select p_name as n from part union select c_name from customer union select n_name from nation)),
ch as (select name, w, list_transform(range(1, length(w) + 1), lambda i: case
  when substr(w, i, 1) = 'H' then '' when substr(w, i, 1) in ('A','E','I','J','O','U','Y') then '0' when substr(w, i, 1) = 'B' then '1'
  when substr(w, i, 1) = 'P' then (case when substr(w, i + 1, 1) = 'H' then '3' else '1' end)
  when substr(w, i, 1) in ('D','T') then (case when substr(w, i + 1, 1) in ('C','S','Z') then '8' else '2' end)
  when substr(w, i, 1) in ('F','V','W') then '3' when substr(w, i, 1) in ('G','K','Q') then '4'
  when substr(w, i, 1) = 'X' then (case when i > 1 and substr(w, i - 1, 1) in ('C','K','Q') then '8' else '48' end)
  when substr(w, i, 1) = 'L' then '5' when substr(w, i, 1) in ('M','N') then '6' when substr(w, i, 1) = 'R' then '7' when substr(w, i, 1) in ('S','Z') then '8'
  when i = 1 then (case when substr(w, 2, 1) in ('A','H','K','L','O','Q','R','U','X') then '4' else '8' end)
  when substr(w, i - 1, 1) in ('S','Z') then '8' when substr(w, i + 1, 1) in ('A','H','K','O','Q','U','X') then '4' else '8' end) as codes from names),
flat as (select name, string_split(array_to_string(codes, ''), '') as ds from ch),
runs as (select name, list_filter(ds, lambda d, i: d <> '' and (i = 1 or d <> ds[i - 1])) as ds from flat),
coded as (select name, array_to_string(list_filter(ds, lambda d, i: i = 1 or d <> '0'), '') as code from runs)
"""


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "part").select(F.col("p_name").alias("name")).union(table(spark, sf_dir, "customer").select("c_name")).union(table(spark, sf_dir, "nation").select("n_name"))
    return n.distinct().select("name", match.sound_code(F.col("name"), ascii_only=True).alias("code"))


@query(_SQL_SOUND + "select name, code from coded")
def sound_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H28."""
    return _names(spark, sf_dir)


@query(_SQL_SOUND + "select code, count(*)::bigint as n, min(name) as first from coded group by code")
def sound_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many names share a sound."""
    return _names(spark, sf_dir).groupBy("code").agg(F.count(F.lit(1)).alias("n"), F.min("name").alias("first"))


@query()
def sound_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agreement among all part names of one brand and type, by letters and by sound. Rows only."""
    part = table(spark, sf_dir, "part").select("p_brand", "p_type", text.normalise(F.col("p_name")).alias("l"), match.sound_code(F.col("p_name"), ascii_only=True).alias("s"))
    by = part.select("p_brand", "p_type", F.explode(F.array(F.struct(F.lit("l").alias("kind"), F.col("l").alias("v")), F.struct(F.lit("s").alias("kind"), F.col("s").alias("v")))).alias("x")).select("p_brand", "p_type", "x.*")
    both = consensus.group_agreement(by, ["p_brand", "p_type", "kind"], "v")
    of = lambda kind, c: F.max(F.when(F.col("kind") == kind, F.col(c)))
    return both.groupBy("p_brand", "p_type").agg(of("l", "agreement").alias("letters"), of("l", "medoid").alias("medoid"), of("s", "agreement").alias("sound"))


@query()
def close_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many other names of its brand and type each part name is like, and the one it is most like. Rows only."""
    part = table(spark, sf_dir, "part").select("p_brand", "p_type", text.normalise(F.col("p_name")).alias("name")).distinct()
    close = consensus.close_pairs(part, ["p_brand", "p_type"], "name", match.ACCEPT)
    # Of equally close names the first by name.
    best = F.min(F.struct((-F.col("similarity")).alias("s"), "b"))
    found = close.groupBy("p_brand", "p_type", F.col("a").alias("name")).agg(F.count(F.lit(1)).alias("n_close"), best.alias("best"))
    return part.join(found, ["p_brand", "p_type", "name"], "left").select("p_brand", "p_type", "name", F.coalesce("n_close", F.lit(0)).alias("n_close"), F.col("best.b").alias("closest"), (-F.col("best.s")).alias("similarity"))


@query(
    """select p_partkey, case when length(s) >= 4 and upper(s) = s and lower(s) <> s and regexp_matches(s, '[AEIOUY]') and not regexp_matches(s, '^(\\w-)+\\w$') then substr(s, 1, 1) || lower(substr(s, 2)) else s end as spoken
from (select p_partkey, case when p_partkey % 2 = 0 then upper(p_name) else p_name end as s from part)"""
)
def spoken_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H31."""
    s = F.when(F.col("p_partkey") % 2 == 0, F.upper("p_name")).otherwise(F.col("p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", match.spoken_case(s).alias("spoken"))


@query(
    """select event_id, least(60, 5 * power(2, least(floor(w / 30), 4)))::bigint as pause, w >= 1200 as gives_up,
'-' || floor(ceil(v - 1e-6) / 60)::bigint || ':' || lpad((ceil(v - 1e-6)::bigint % 60)::varchar, 2, '0') as clock,
case when n <= 1 then '' else least(greatest(i, 1), n) || ' of ' || n end as label,
least(greatest(case when i = 3 then 1.5 else i * 3.0 end, 0.0), 10.0)::double as delay,
[2, i, 0] > [2, n, 0] as newer
from (select event_id, event_id % 1500 as w, value as v, (event_id % 5)::bigint as i, (event_id % 7)::bigint as n from events)"""
)
def small_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H34, H36-H38, P16, T4."""
    e = table(spark, sf_dir, "events")
    w, v, i, n = F.col("event_id") % 1500, F.col("value"), F.col("event_id") % 5, F.col("event_id") % 7
    setting = F.when(i == 3, F.lit("none")).otherwise((i * 3).cast("string"))
    version = lambda k: F.concat_ws(".", F.lit("2"), k.cast("string"))
    return e.select(
        "event_id", small.backoff_pause(w).alias("pause"), small.gives_up(w).alias("gives_up"), small.clock(v).alias("clock"), small.position_label(i, n).alias("label"),
        small.clamped(setting, 0.0, 10.0, 1.5).alias("delay"), small.version_newer(version(i), F.concat(version(n), F.lit(".0"))).alias("newer"),
    )


@query()
def cleaned_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1, H7, H46 over raw markup; rows only (Java and RE2 regex differ in what the full chain needs)."""
    t = text.clean(F.col("html"))
    return spread(table(spark, sf_dir, "pages")).select("page_id", t.alias("cleaned"), F.size(text.split_long(t)).alias("parts"), F.length(text.render(F.col("html"))).alias("rendered"))
