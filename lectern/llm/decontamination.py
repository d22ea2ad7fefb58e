r"""Benchmark passages in documents, re-parameterised ones included; in DataFrame functions only.

Texts are turned into templates: numbers, the units behind them, and names (capitalised words inside
a sentence) become typed placeholders, everything else is lower-cased words. Windows of `width`
template words are hashed on both sides and joined; windows with fewer than `MIN_FIXED` plain words
are hashed with their values, so that only exact copies match. A document that holds at least `share`
of an item's telling windows, or of all its windows, is a candidate. It is confirmed when its slots are
consistent with the item's: each value that fills a placeholder of the item corresponds to one value in
the document (a share of `consistency` of the slot pairs agrees with the most frequent counterpart), and
different values don't become one (that share and the one seen from the document's values, on average).
That is judged for each occurrence that holds the share of the item's places (windows at one distance
from the item's, or at distances at most `GAP` apart), and for all places together; one is enough, and
`agreement` is that of the best.

Items that differ in nothing but the values of their slots, and whose slots are equal to each other in the
same places, are one class; a document has one hit for a class, with all of its items whose own values stand in
one occurrence (`verbatim`). Items whose windows are told by their values are in classes of their own.

Items with fewer template words than `width` are one window of their own width; with fewer than
three plain words they can't be told from chance and match nothing.

The item windows are broadcast while there are at most `BROADCAST_ROWS` of them, with their slots at
most `BROADCAST_WINDOWS`; beyond that the joins shuffle.

Edge cases: null or empty texts and items match nothing; a text of any length is matched whole;
repeated rows are matched alike; where counterparts of a slot are tied, either counts; null ids are
ids like others; empty tables give no rows; columns other than those named are ignored by `hits`
and pass through `without_hits`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._store import BROADCAST_IDS, picked, staged

WIDTH = 8
SHARE = 0.5
MIN_FIXED = 4
CONSISTENCY = 0.7
#: Words by which the windows of one occurrence may stand apart from one another's distance.
GAP = 3
BROADCAST_ROWS = 500_000
#: Item windows, with the values of their slots, that are broadcast at most.
BROADCAST_WINDOWS = 100_000
NUMBER, UNIT, NAME = "\ue001", "\ue002", "\ue003"
#: Units that may follow a number.
UNITS = (
    "mm", "cm", "km", "m", "mg", "kg", "g", "t", "ml", "l", "s", "min", "h", "kmh", "mph", "w", "kw", "v", "hz", "mb", "gb", "tb",
    "meters", "metres", "miles", "feet", "inches", "grams", "pounds", "litres", "liters", "seconds", "minutes", "hours", "days",
    "weeks", "months", "years", "dollars", "euros", "percent", "degrees",
)


def tagged(text: Column) -> Column:
    """The text with a mark before each number, unit and name."""
    named = F.regexp_replace(text, r"(?<=[\p{Ll},;] )(\p{Lu}\p{L}*)", NAME + "$1")
    numbered = F.when(text.rlike(r"\p{Nd}"), F.regexp_replace(F.regexp_replace(named, r"(?<![\p{L}\p{N}])(\p{Nd}+(?:[.,:]\p{Nd}+)*)", NUMBER + "$1"), rf"({NUMBER}[\p{{Nd}}.,:]+)\s*((?i:{'|'.join(UNITS)}))(?!\p{{L}})", "$1 " + UNIT + "$2")).otherwise(named)
    return numbered


def _raw_words(tagged: Column) -> Column:
    return F.filter(F.split(tagged, rf"(?:[^\p{{L}}\p{{N}}{NUMBER}-{NAME}.,:]|[.,:](?!\p{{N}}))+"), lambda w: w != "")


def _template_words(tagged: Column) -> Column:
    return _raw_words(F.lower(F.regexp_replace(tagged, rf"([{NUMBER}-{NAME}])[\p{{L}}\p{{N}}]+(?:[.,:]\p{{N}}+)*", "$1")))


def raw_words(text: Column) -> Column:
    """Words with their marks and values."""
    return _raw_words(tagged(text))


def template_words(text: Column) -> Column:
    """Lower-cased words, with a bare mark for each slot."""
    return _template_words(tagged(text))


def is_slot(word: Column) -> Column:
    return F.substring(word, 1, 1).between(NUMBER, NAME)


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def window_hashes(words: Column, width: int) -> Column:
    """Hash of each window of `width` word hashes; none where there are fewer."""
    last = F.size(words) - width
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.slice(words, i + 1, width)))).otherwise(F.array().cast("array<bigint>"))


def let(value: Column, body) -> Column:
    """`body` with `value` bound once, however often it is used."""
    return F.get(F.transform(F.array(value), body), 0)


def both_words(text: Column) -> Column:
    """struct(words, raw): template words, and the same words with their marks and values."""
    return let(tagged(text), lambda t: F.struct(_template_words(t).alias("words"), _raw_words(t).alias("raw")))


def least_plain(width: Column) -> Column:
    """How many plain words a window of this width must have to be told by its template."""
    return F.least(F.lit(MIN_FIXED), F.greatest(width - 1, F.lit(3)))


def mixed_hashes(words: Column, raw: Column, width: int) -> Column:
    """Hash of each window: of its template, or of its words with their values where few are plain."""
    need = min(MIN_FIXED, max(width - 1, 3))

    def chosen(parts: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(parts["slots"]) - width)
        own = lambda name, i: F.slice(parts[name], i + 1, width)
        mixed = F.transform(at, lambda i: F.when(F.size(F.filter(own("slots", i), lambda x: ~x)) >= need, F.xxhash64(own("words", i))).otherwise(F.xxhash64(own("raw", i))))
        return F.when(F.size(parts["slots"]) < width, F.array().cast("array<bigint>")).when(F.size(F.filter(parts["slots"], lambda x: x)) > width - need, mixed).otherwise(window_hashes(parts["words"], width))

    # Bound once: what stands in the function of a window is worked out for every window.
    return let(F.struct(F.transform(words, is_slot).alias("slots"), word_hashes(words).alias("words"), F.transform(raw, lambda w: F.xxhash64(F.lower(w))).alias("raw")), chosen)


def item_windows(items: DataFrame, *, width: int = WIDTH) -> DataFrame:
    """item, at, width, window, telling, slots, and numbers of windows and places: the windows of each item.

    `total` and `places` are of telling windows, `total_all` and `places_all` of all.
    """
    words = items.where("text is not null").select("item", both_words(F.col("text")).alias("b")).select("item", "b.words", "b.raw")
    slots = F.filter("raw", is_slot)
    words = words.withColumn("shape", F.xxhash64("words", F.transform(slots, lambda v: F.array_position(slots, v))))
    sized = words.withColumn("width", F.least(F.lit(width), F.size("words"))).where("width > 0")
    at = sized.select("item", "shape", "words", word_hashes(F.col("words")).alias("hashes"), "raw", "width", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("width"))).alias("at"))
    own = F.slice("words", F.col("at") + 1, F.col("width"))
    n_plain = F.size(F.filter(own, lambda w: ~is_slot(w)))
    values = F.slice("raw", F.col("at") + 1, F.col("width"))
    told = at.withColumn("telling", n_plain >= least_plain(F.col("width"))).where(F.col("telling") | (F.col("width") == width) | (n_plain >= 3))
    window = F.when(F.col("telling"), F.xxhash64(F.slice("hashes", F.col("at") + 1, F.col("width")))).otherwise(F.xxhash64(F.transform(values, lambda w: F.xxhash64(F.lower(w)))))
    found = told.select("item", "shape", "at", "width", window.alias("window"), "telling", F.filter(values, is_slot).alias("slots"), placed_slots(values, F.col("at")).alias("placed"))
    total = found.groupBy("item", "window", "telling").agg(F.count_distinct("at").alias("k")).groupBy("item").agg(
        F.count_if("telling").alias("total"), F.count(F.lit(1)).alias("total_all"), F.sum(F.when(F.col("telling"), F.col("k")).otherwise(0)).alias("places"), F.sum("k").alias("places_all")
    )
    return found.join(total, "item")


def placed_slots(values: Column, at: Column) -> Column:
    """struct(place, value) of each slot of a window that stands at `at` in the item."""
    return F.filter(F.transform(values, lambda v, i: F.struct((at + i).alias("place"), F.lower(v).alias("value"))), lambda x: is_slot(x["value"]))


def template_classes(windows: DataFrame) -> DataFrame:
    """item, class_id, values of the items of `item_windows`: the least item of its template, and a hash of its own slots' values."""
    # The slots as arrays, so that items without any stay.
    each = windows.groupBy("item").agg(
        F.sort_array(F.collect_set("shape")).alias("shapes"), F.sort_array(F.collect_set(F.when(~F.col("telling"), F.col("window")))).alias("by_value"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("placed")))).alias("placed"),
    )
    kind = each.select("item", F.xxhash64(F.col("shapes"), F.lit(0), F.col("by_value")).alias("kind"), F.xxhash64("placed").alias("values"))
    least = kind.groupBy("kind").agg(F.min("item").alias("class_id"))
    return kind.join(least, "kind").select("item", "class_id", "values")


def hits(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", width: int = WIDTH, share: float = SHARE, consistency: float = CONSISTENCY) -> DataFrame:
    """doc_id, tie, item_id, class_id, verbatim, matched, total, agreement: a row for each document and template that it holds.

    `verbatim` lists the items of the class whose own values the document has (empty where it has others only),
    `item_id` is the least of them, or else that of the class. Items of a class: `template_classes`.
    """
    every = staged(item_windows(picked(items, item=item_col, text=item_text_col), width=width), "all_item_windows")
    classes = staged(template_classes(every), "item_classes")
    first = classes.where(F.col("item").eqNullSafe(F.col("class_id"))).select(F.col("item").alias("first"))
    wanted = staged(every.join(first, F.col("item").eqNullSafe(F.col("first")), "left_semi").drop("shape", "placed"), "item_windows")
    widths = sorted(r[0] for r in wanted.select("width").distinct().collect())  # at most `width` numbers
    known = wanted.select("window").distinct()
    if known.count() <= BROADCAST_ROWS:
        known = F.broadcast(known)
    rows = picked(docs, doc_id=id_col, text=text_col).where("text is not null").withColumn("tie", F.xxhash64("text"))
    per_width = lambda b: F.array(*[F.struct(F.lit(w).alias("width"), mixed_hashes(b["words"], b["raw"], w).alias("hashes")) for w in widths or [width]])
    spread = rows.select("doc_id", "tie", F.explode(let(both_words(F.col("text")), per_width)).alias("p")).select("doc_id", "tie", F.col("p.width").alias("width"), F.posexplode("p.hashes").alias("pos", "window"))
    found = staged(spread.join(known, "window").select("doc_id", "tie", "width", "pos", "window"), "window_hits")
    # Hits of a window that a third of all rows may hold stay where they are, while the items are few.
    met = found.join(F.broadcast(wanted) if wanted.count() <= BROADCAST_WINDOWS else wanted, ["window", "width"])
    own = ["doc_id", "tie", "item"]
    same = lambda a, b: F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.tie") == F.col(f"{b}.tie"))
    alike = lambda a, b: same(a, b) & F.col(f"{a}.item").eqNullSafe(F.col(f"{b}.item"))
    enough = lambda told, total, every, total_all: ((total > 0) & (told >= share * total)) | (every >= share * total_all)
    c = F.col
    kinds = met.select(*own, "window", "telling", "total", "total_all").distinct()
    held = kinds.groupBy(*own).agg(F.count_if("telling").alias("told"), F.count(F.lit(1)).alias("every"), F.first("total").alias("total"), F.first("total_all").alias("total_all"))
    held = staged(held.where(enough(c("told"), c("total"), c("every"), c("total_all"))), "held_items")
    # Occurrences: windows that stand at one distance from the item's, or at distances with small gaps between.
    places = met.alias("m").join(held.alias("h"), alike("m", "h"), "left_semi").select(*own, "at", "pos", "width", "telling", "slots", "places", "places_all").distinct()
    in_order = W.partitionBy(*own).orderBy(c("pos") - c("at"))
    apart = (c("pos") - c("at")) - F.lag(c("pos") - c("at")).over(in_order) > F.least(F.lit(GAP), c("width") - 1)
    places = places.withColumn("apart", F.coalesce(apart, F.lit(False)).cast("int"))
    places = staged(places.withColumn("chain", F.sum("apart").over(in_order)).drop("apart"), "held_places")
    level = lambda n, key: F.struct(F.lit(n).alias("level"), key.cast("long").alias("key"))
    levels = [level(0, c("pos") - c("at")), level(1, c("chain"))]
    stood = places.select(*own, F.explode(F.array(*levels)).alias("o"), "at", "telling", "places", "places_all").distinct().groupBy(*own, "o.level", "o.key")
    stood = stood.agg(F.count_if("telling").alias("told"), F.count(F.lit(1)).alias("every"), F.first("places").alias("places"), F.first("places_all").alias("places_all"))
    judged = stood.where(enough(c("told"), c("places"), c("every"), c("places_all"))).select(*own, "level", "key").union(held.select(*own, F.lit(2).alias("level"), F.lit(0).cast("long").alias("key")))
    # Slots: the values in the document where the item's windows stand, beside the item's own.
    slotted = places.where(F.size("slots") > 0).groupBy("doc_id", "tie").agg(F.collect_set(F.struct("item", "at", "pos", "width", "slots", "chain")).alias("places"))
    slotted = staged(slotted, "slotted_places")
    # Only texts with hits are shuffled, while their ids are few.
    ids = slotted.select("doc_id", "tie")
    if slotted.count() <= BROADCAST_IDS:
        rows = rows.alias("r").join(F.broadcast(ids).alias("i"), same("r", "i"), "left_semi")
    valued = rows.alias("r").join(slotted.alias("p"), same("r", "p")).select("r.doc_id", "r.tie", raw_words(F.col("r.text")).alias("raw"), "p.places")
    one = valued.select("doc_id", "tie", "raw", F.explode("places").alias("p")).select("doc_id", "tie", "raw", "p.*")
    here = F.slice("raw", c("pos") + 1, c("width"))
    pairs = one.select(*own, "at", "pos", "chain", F.explode(F.arrays_zip(c("slots").alias("theirs"), F.filter(here, is_slot).alias("ours"), placed_slots(here, c("at")).alias("placed"))).alias("s"))
    pairs = staged(pairs, "slot_pairs")
    counted = pairs.select(*own, F.explode(F.array(*levels, level(2, F.lit(0)))).alias("o"), "s").groupBy(*own, "o.level", "o.key", c("s.theirs").alias("theirs"), c("s.ours").alias("ours")).agg(F.count(F.lit(1)).alias("n"))
    # From the item's values to the document's, and back.
    sides = counted.select(*own, "level", "key", "n", F.explode(F.array(F.struct(F.lit(True).alias("forth"), c("theirs").alias("value")), F.struct(F.lit(False).alias("forth"), c("ours").alias("value")))).alias("side"))
    top = sides.groupBy(*own, "level", "key", "side").agg(F.max("n").alias("best"), F.sum("n").alias("n"))
    shared = lambda forth: F.sum(F.when(c("side.forth") == forth, c("best"))) / F.sum(F.when(c("side.forth") == forth, c("n")))
    agreed = top.groupBy(*own, "level", "key").agg(F.least(shared(True), (shared(True) + shared(False)) / 2).alias("agreement"))
    # Items of the class all of whose slots stand in one occurrence with their own values.
    read = pairs.groupBy(*own, c("pos") - c("at")).agg(F.xxhash64(F.sort_array(F.collect_set("s.placed"))).alias("values")).select(*own, "values").distinct()
    members = classes.select(c("item").alias("member"), "class_id", "values")
    copied = read.alias("r").join(members.alias("m"), (c("r.values") == c("m.values")) & c("r.item").eqNullSafe(c("m.class_id")))
    copied = copied.groupBy("r.doc_id", "r.tie", "r.item").agg(F.sort_array(F.collect_set("member")).alias("verbatim"))
    at_one = alike("j", "a") & (c("j.level") == c("a.level")) & (c("j.key") == c("a.key"))
    best = judged.alias("j").join(agreed.alias("a"), at_one, "left").groupBy("j.doc_id", "j.tie", "j.item").agg(F.max(F.coalesce("a.agreement", F.lit(1.0))).alias("agreement")).where(c("agreement") >= consistency)
    by_template = (c("h.total") > 0) & (c("h.told") >= share * c("h.total"))
    matched, total = F.when(by_template, c("h.told")).otherwise(c("h.every")), F.when(by_template, c("h.total")).otherwise(c("h.total_all"))
    found = held.alias("h").join(best.alias("b"), alike("h", "b")).join(copied.alias("v"), alike("h", "v"), "left")
    verbatim = F.coalesce("v.verbatim", F.array().cast(copied.schema["verbatim"].dataType))
    return found.select("h.doc_id", "h.tie", F.coalesce(F.get(verbatim, F.lit(0)), "h.item").alias("item_id"), c("h.item").alias("class_id"), verbatim.alias("verbatim"), matched.alias("matched"), total.alias("total"), "b.agreement")


def without_hits(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of `docs` that hold no item, with all their columns."""
    found = hits(docs, items, id_col=id_col, text_col=text_col, **how).select(F.col("doc_id").alias("_hit_id"), F.col("tie").alias("_hit_tie")).distinct()
    return docs.join(found, docs[id_col].eqNullSafe(found["_hit_id"]) & (F.xxhash64(docs[text_col]) == found["_hit_tie"]), "left_anti")
