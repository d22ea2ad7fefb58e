"""What was intended against what is there, and which of several reports on one thing counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions import text


def reconcile(expected: DataFrame, written: DataFrame, *, key: str = "path", size: str = "size", content: str | None = None) -> DataFrame:
    """key, expected_size, written_size, status: missing, extra, size differs, content differs or same.

    content: a column of checksums, compared where the sizes are equal.
    """
    own = [content] if content else []
    e = expected.select(key, F.col(size).alias("expected_size"), *[F.col(c).alias("_sum") for c in own], F.lit(True).alias("_e"))
    w = written.select(key, F.col(size).alias("written_size"), *[F.col(c).alias("_found") for c in own], F.lit(True).alias("_w"))
    status = F.when(F.isnull("_w"), "missing").when(F.isnull("_e"), "extra").when(~F.col("expected_size").eqNullSafe(F.col("written_size")), "size differs")
    if content:
        status = status.when(~F.col("_sum").eqNullSafe(F.col("_found")), "content differs")
    return e.join(w, key, "full_outer").select(key, "expected_size", "written_size", status.otherwise("same").alias("status"))


def last_wins(rows: DataFrame, key: str, order: tuple[str, ...]) -> DataFrame:
    """The last row of each key by `order`."""
    return _extreme(rows, key, order, F.max_by)


def first_wins(rows: DataFrame, key: str, order: tuple[str, ...]) -> DataFrame:
    return _extreme(rows, key, order, F.min_by)


def _extreme(rows: DataFrame, key: str, order: tuple[str, ...], pick) -> DataFrame:
    return rows.groupBy(key).agg(pick(F.struct(*[c for c in rows.columns if c != key]), F.struct(*order)).alias("_row")).select(key, "_row.*")


def absorbing(rows: DataFrame, key: str, order: tuple[str, ...], *, outcome: str = "outcome", settled: str = "fixed") -> DataFrame:
    """The last row of each key that was never settled: once settled, a key is out for good."""
    grouped = rows.groupBy(key).agg(F.bool_or(F.col(outcome) == settled).alias("_done"), F.max_by(F.struct(*[c for c in rows.columns if c != key]), F.struct(*order)).alias("_row"))
    return grouped.where("not coalesce(_done, false)").select(key, "_row.*")


def claims(*reports: DataFrame, outcomes: tuple[str, ...] = ("fixed", "replaced", "forced")) -> DataFrame:
    """path, word of rewritten clips over reports (path, word, outcome, seq), later reports and rows first."""
    every = None
    for k, r in enumerate(reports):
        own = r.where(F.col("outcome").isin(*outcomes)).select("path", "word", F.struct(F.lit(k).alias("report"), F.col("seq")).alias("_at"))
        every = own if every is None else every.union(own)
    return every.groupBy("path").agg(F.max_by("word", "_at").alias("word"))


def rescue_list(report: DataFrame, originals: DataFrame, *, order: tuple[str, ...] = ("seq",)) -> DataFrame:
    """Unsettled rows of the report with the verdict of the original row (the last by path), where that rambled."""
    last = last_wins(originals, "path", order).select("path", "verdict")
    return report.where("outcome = 'unsettled'").join(last, "path").where("verdict = 'rambled'")


def labelled(*reasons: tuple[str, DataFrame]) -> DataFrame:
    """path, reason: the strongest reason of each path; earlier arguments are weaker."""
    every = None
    for k, (name, rows) in enumerate(reasons):
        own = rows.select("path", F.struct(F.lit(k).alias("k"), F.lit(name).alias("name")).alias("_r"))
        every = own if every is None else every.union(own)
    return every.groupBy("path").agg(F.max("_r")["name"].alias("reason"))


def to_copy(fixed: DataFrame, held: DataFrame, source: DataFrame, target: DataFrame) -> DataFrame:
    """path, state of fixed clips that aren't held back: odd path, absent, same, or copy."""
    shape = r"^sounds/(?:q|w)/[^/]+/[^/]+$"
    free = fixed.select("path").distinct().join(held, "path", "left_anti")
    met = free.join(source.select("path", F.col("sha").alias("_s")), "path", "left").join(target.select("path", F.col("sha").alias("_t")), "path", "left")
    state = F.when(~F.col("path").rlike(shape), "odd").when(F.isnull("_s"), "absent").when(F.col("_s").eqNullSafe(F.col("_t")), "same").otherwise("copy")
    return met.select("path", state.alias("state"))


def copy_needed(source: DataFrame, target: DataFrame) -> DataFrame:
    """Rows of source (path, size, mtime) that target has in another size or older."""
    t = target.select("path", F.col("size").alias("_size"), F.col("mtime").alias("_mtime"))
    return source.join(t, "path", "left").where("not coalesce(size = _size and _mtime >= mtime, false)").drop("_size", "_mtime")


def not_ignored(files: DataFrame, ignored: DataFrame) -> DataFrame:
    """Files that are no ignored path and stand below none: a path's folders and itself are looked up by equality."""
    parts = F.split("path", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))
    each = files.where("path is not null").select("path", F.explode(above).alias("prefix")).distinct()
    return files.join(each.join(ignored.select("prefix").distinct(), "prefix", "left_semi").select("path"), "path", "left_anti").select(*files.columns)


def without_numerals(heard: DataFrame, *, keep: bool = False) -> DataFrame:
    """Reports (heard) but those whose transcript is nothing but digits; all of them where asked."""
    return heard if keep else heard.where(~text.normalise(F.col("heard")).rlike(r"^\p{Nd}+$"))
