"""Incremental, reversible line de-duplication: exact reference counts behind sharded cuckoo filters.

A line's key is the line without white space at both ends and with A-Z lower-cased; keys shorter than
`min_chars` code points are never touched. The index holds, in the shared folder,

* the references: one row per (key, document),
* the exact reference counts: one row per key with its number of documents and its largest document,
* one cuckoo filter per shard of the keys, whose 16-bit fingerprints can be removed again.

A new batch is counted first (one row per key, so that no key is hot), dealt to the shards and
screened by their filters: a key that a filter doesn't know is new and needs no look at the exact
counts; only keys that may be known are joined with them. All keys that turn out new enter the
filters, those that a filter took for known too. A filter that is full is built anew from the counts,
and when there are twice the keys that the shards were made for, all are. Deleting documents lowers
the counts, and keys that nobody holds any more leave the filters.

Edge cases: a null or empty text is one empty line and loses nothing; a text of any length is split
whole; rows that repeat a document's id count as one document and lose the same lines; a null id
counts as one document, smaller than any other; an empty table gives no rows; other columns pass
through `clean` untouched, but for such as have the names of the two that it adds.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._store import BROADCAST_IDS, SPACE, dropped, staged, tidied

MIN_CHARS = 40
MIN_DOCS = 5
#: Keys that one shard's filter holds at about its best load.
KEYS_PER_SHARD = 100_000
#: The batches of one table: shares of its documents.
SHARES = (2, 1, 1)
NO_ID = -(1 << 63)
_STRIP = SPACE.encode()


def key_of(line: str, min_chars: int = MIN_CHARS) -> bytes | None:
    """128-bit key of a line, or None where the line is too short."""
    raw = line.encode("utf-8", "surrogatepass").strip(_STRIP).lower()
    if len(raw) < min_chars or len(raw) < 4 * min_chars and len(raw.decode("utf-8", "surrogatepass")) < min_chars:
        return None
    return xxhash.xxh3_128_digest(raw)


class Cuckoo:
    """Cuckoo filter: buckets of four 16-bit fingerprints; adds and looks up whole arrays of 128-bit keys."""

    SLOTS, KICKS = 4, 400

    def __init__(self, buckets: int, table: np.ndarray | None = None):
        self.buckets = buckets
        self.table = np.zeros((buckets, self.SLOTS), np.uint16) if table is None else table
        self.random = np.random.default_rng(buckets)

    @classmethod
    def for_keys(cls, n: int) -> Cuckoo:
        return cls(1 << max(4, int(np.ceil(np.log2(max(1, n) / (cls.SLOTS * 0.8))))))

    @staticmethod
    def words(keys: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)

    def at(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mark = (keys[:, 1] >> np.uint64(48)).astype(np.uint16)
        return (keys[:, 0] & np.uint64(self.buckets - 1)).astype(np.int64), np.where(mark == 0, 1, mark).astype(np.uint16)

    def other(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        return bucket ^ ((mark.astype(np.int64) * 0x5BD1E995 >> 5) & (self.buckets - 1))

    def contains(self, keys: np.ndarray) -> np.ndarray:
        bucket, mark = self.at(keys)
        return (self.table[bucket] == mark[:, None]).any(1) | (self.table[self.other(bucket, mark)] == mark[:, None]).any(1)

    def add(self, keys: np.ndarray) -> bool:
        """False, and no promise about the table, where the keys don't fit."""
        bucket, mark = self.at(keys)
        for kick in range(self.KICKS):
            if not len(bucket):
                return True
            order = np.argsort(bucket, kind="stable")
            bucket, mark = bucket[order], mark[order]
            first = np.r_[True, bucket[1:] != bucket[:-1]]
            starts = np.flatnonzero(first)
            rank = np.arange(len(bucket)) - np.repeat(starts, np.diff(np.r_[starts, len(bucket)]))
            taken = self.table[bucket] != 0
            free = self.SLOTS - taken.sum(1)
            fits = rank < free
            if fits.any():
                slots = np.argsort(taken[fits], axis=1, kind="stable")
                self.table[bucket[fits], slots[np.arange(len(slots)), rank[fits]]] = mark[fits]
            if kick:
                # The first that doesn't fit takes a place; what stood there moves to its other bucket.
                push = rank == free
                slot = self.random.integers(0, self.SLOTS, int(push.sum()))
                old = self.table[bucket[push], slot]
                self.table[bucket[push], slot] = mark[push]
                mark[push] = old
            bucket, mark = self.other(bucket, mark)[~fits], mark[~fits]
        return False

    def remove(self, keys: np.ndarray) -> None:
        for b, o, m in zip(*(lambda b, m: (b.tolist(), self.other(b, m).tolist(), m.tolist()))(*self.at(keys))):
            for place in (b, o):
                found = np.flatnonzero(self.table[place] == m)
                if len(found):
                    self.table[place, found[0]] = 0
                    break


def line_refs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """key, doc: a row for each document and key of at least `min_chars` code points."""

    def refs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in tidied(batches):
            for at in range(0, len(batch), 250):
                part = batch.iloc[at : at + 250]
                keys: list[bytes] = []
                ids: list[int] = []
                for doc, text in zip(part["doc"].tolist(), part["text"].tolist()):
                    own = {k for line in (text or "").split("\n") if (k := key_of(line, min_chars))}
                    keys += own
                    ids += [doc] * len(own)
                yield pd.DataFrame({"key": keys, "doc": np.array(ids, np.int64)})

    rows = docs.select(F.coalesce(docs[id_col].cast("long"), F.lit(NO_ID)).alias("doc"), docs[text_col].alias("text"))
    return rows.mapInPandas(refs, "key binary, doc long")


_FILTERS = "shard int, buckets int, cuckoo binary"
_COUNTS = "key binary, n_docs long, last_doc long"


def _opened(row: pd.DataFrame) -> Cuckoo:
    return Cuckoo(int(row["buckets"].iloc[0]), np.frombuffer(row["cuckoo"].iloc[0], np.uint16).reshape(-1, Cuckoo.SLOTS).copy())


def _closed(shard: int, have: Cuckoo | None) -> pd.DataFrame:
    """A shard's row; without a filter where it must be built anew."""
    return pd.DataFrame([{"shard": shard, "buckets": have.buckets if have else None, "cuckoo": have.table.tobytes() if have else None}]).astype(object)


def _screen(old: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
    """One shard: which of the batch's keys its filter may know."""
    maybe = _opened(old).contains(Cuckoo.words(counts["key"].tolist())) if len(old) and len(counts) else np.zeros(len(counts), bool)
    return counts.assign(maybe=maybe)[["key", "n_docs", "last_doc", "maybe"]]


def _learn(old: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
    """One shard's filter with further keys, or without a filter where they don't fit."""
    if not len(new):
        return old
    if not len(old):
        return _build(new)
    have = _opened(old)
    return _closed(int(old["shard"].iloc[0]), have if have.add(Cuckoo.words(new["key"].tolist())) else None)


def _forget(old: pd.DataFrame, gone: pd.DataFrame) -> pd.DataFrame:
    if len(old) and len(gone):
        have = _opened(old)
        have.remove(Cuckoo.words(gone["key"].tolist()))
        return _closed(int(old["shard"].iloc[0]), have)
    return old


def _build(keys: pd.DataFrame) -> pd.DataFrame:
    """One shard's filter from all of its keys."""
    words = Cuckoo.words(keys["key"].tolist())
    have = Cuckoo.for_keys(len(words))
    while not have.add(words):
        have = Cuckoo(have.buckets * 2)
    return _closed(int(keys["shard"].iloc[0]), have)


@dataclasses.dataclass(frozen=True)
class LineIndex:
    """References, counts and filters of all lines seen so far; every change gives a new index.

    Every key of the counts has one fingerprint of its own in its shard's filter.
    """

    refs: DataFrame
    counts: DataFrame
    filters: DataFrame
    shards: int = 0
    n_keys: int = 0
    min_chars: int = MIN_CHARS

    @classmethod
    def empty(cls, spark: SparkSession, min_chars: int = MIN_CHARS) -> LineIndex:
        none = lambda ddl: spark.range(0).select(*[F.lit(None).cast(kind).alias(name) for name, kind in (c.split() for c in ddl.split(", "))])
        return cls(none("key binary, doc long"), none(_COUNTS), none(_FILTERS), min_chars=min_chars)

    def _shard(self, shards: int):
        return F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int").alias("shard")

    def insert(self, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> LineIndex:
        """With the lines of further documents, whose ids are new to the index."""
        return self.insert_refs(staged(line_refs(docs, id_col=id_col, text_col=text_col, min_chars=self.min_chars), "line_refs"))

    def insert_refs(self, refs: DataFrame) -> LineIndex:
        """With the rows (key, doc) of further documents, from a staged table."""
        batch = staged(_counted(refs), "line_counts")
        shards, filters, n = self.shards, self.filters, batch.count()
        need = -(-(self.n_keys + n) // KEYS_PER_SHARD)
        if need > 2 * shards:
            # Twice the keys that the shards were made for: deal all anew.
            shards = max(1, need)
            filters = staged(self.counts.select(self._shard(shards), "key").groupBy("shard").applyInPandas(_build, _FILTERS), "line_filters")
        dealt = batch.select(self._shard(shards), *batch.columns)
        screened = staged(filters.groupBy("shard").cogroup(dealt.groupBy("shard")).applyInPandas(_screen, _COUNTS + ", maybe boolean"), "screened")
        # A key that its filter doesn't know is new, and needs no look at the counts.
        maybe = screened.where("maybe").select("key", F.col("n_docs").alias("more"), F.col("last_doc").alias("later"))
        both = self.counts.join(maybe, "key", "full_outer")
        both = both.select("key", (F.coalesce("n_docs", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("n_docs"), F.greatest("last_doc", "later").alias("last_doc"), F.isnull("n_docs").alias("new"))
        counts = staged(both.union(screened.where("not maybe").select("key", "n_docs", "last_doc", F.lit(True))), "line_counts")
        new = counts.where("new").select(self._shard(shards), "key")
        filters = staged(filters.groupBy("shard").cogroup(new.groupBy("shard")).applyInPandas(_learn, _FILTERS), "line_filters")
        full = filters.where("cuckoo is null").select("shard")
        if not full.isEmpty():
            # Built anew, and larger, from the exact counts. The list has at most a number for each shard.
            again = counts.select(self._shard(shards), "key").join(F.broadcast(full), "shard", "left_semi").groupBy("shard").applyInPandas(_build, _FILTERS)
            filters = staged(filters.where("cuckoo is not null").union(again), "line_filters")
        dropped(batch, screened)
        return LineIndex(self.refs.union(refs) if self.n_keys else refs, counts.drop("new"), filters, shards, counts.count(), self.min_chars)

    def delete(self, doc_ids: DataFrame) -> LineIndex:
        """Without the documents of the ids in `doc_ids`' only column."""
        gone = doc_ids.select(F.coalesce(F.col(doc_ids.columns[0]).cast("long"), F.lit(NO_ID)).alias("doc")).distinct()
        touched = staged(self.refs.join(gone, "doc", "left_semi").select("key").distinct(), "touched_keys")
        refs = staged(self.refs.join(gone, "doc", "left_anti").select("key", "doc"), "line_refs")
        again = _counted(refs.join(touched, "key", "left_semi"))
        counts = staged(self.counts.join(touched, "key", "left_anti").union(again), "line_counts")
        unheld = touched.join(counts, "key", "left_anti").select(self._shard(max(1, self.shards)), "key")
        filters = staged(self.filters.groupBy("shard").cogroup(unheld.groupBy("shard")).applyInPandas(_forget, _FILTERS), "line_filters")
        return LineIndex(refs, counts, filters, self.shards, counts.count(), self.min_chars)

    def to_drop(self, min_docs: int = MIN_DOCS) -> DataFrame:
        """doc, keys: the keys that each document loses, being in `min_docs` documents and not last in this one."""
        often = self.counts.where(F.col("n_docs") >= min_docs).select("key", "last_doc", "n_docs")
        # At most a thousand keys can each hold a thousandth of all references; those are broadcast.
        total = self.refs.count()
        hot = F.broadcast(often.where(F.col("n_docs") * 1000 >= total).drop("n_docs"))
        cold = often.where(F.col("n_docs") * 1000 < total).drop("n_docs")
        lost = self.refs.join(hot, "key").union(self.refs.join(hot, "key", "left_anti").join(cold.hint("merge"), "key")).where("doc <> last_doc")
        return lost.groupBy("doc").agg(F.collect_set("key").alias("keys"))


def _counted(refs: DataFrame) -> DataFrame:
    return refs.groupBy("key").agg(F.count_distinct("doc").alias("n_docs"), F.max("doc").alias("last_doc"))


def clean(docs: DataFrame, drops: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, lines_col: str = "n_lines", dropped_col: str = "n_dropped") -> DataFrame:
    """`docs` with the dropped lines gone from the text, and with n_lines and n_dropped (in place of columns of these names)."""
    own = [c for c in docs.columns if c not in (lines_col, dropped_col)]
    rows = docs.select(*[docs[c].alias(f"c{i}") for i, c in enumerate(own)])
    doc, text = (f"c{own.index(c)}" for c in (id_col, text_col))
    drops = staged(drops, "lines_to_drop")
    at = lambda side: F.coalesce(rows[doc].cast("long"), F.lit(NO_ID)) == side["doc"]
    rest = None
    if drops.count() <= BROADCAST_IDS:
        # Only texts that lose something are shuffled.
        ids = F.broadcast(drops.select("doc"))
        rest = rows.join(ids, at(ids), "left_anti")
        met = rows.join(ids, at(ids), "left_semi").join(drops.hint("merge"), at(drops)).drop("doc")
    else:
        met = rows.join(drops, at(drops), "left").drop("doc")
    packed = met.select(F.struct(*[c for c in rows.columns if c != text]).alias("rest"), F.col(text).alias("text"), "keys")

    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, keys in tidied(batches):
            out = []
            for t, own in zip(texts, keys):
                lines = (t or "").split("\n")
                if own is None:
                    out.append((t, len(lines), 0))
                    continue
                own = set(own)
                left = [x for x in lines if key_of(x, min_chars) not in own]
                out.append(("\n".join(left), len(lines), len(lines) - len(left)))
            yield pd.DataFrame(out, columns=["text", "n_lines", "n_dropped"])

    # Called non-deterministic so that a filter on the result doesn't run it a second time.
    done = packed.select("rest", F.pandas_udf(cut, "text string, n_lines long, n_dropped long").asNondeterministic()("text", "keys").alias("cut"))
    done = done.select(*[(F.col("cut.text") if f"c{i}" == text else F.col(f"rest.c{i}")).alias(c) for i, c in enumerate(own)], F.col("cut.n_lines").alias(lines_col), F.col("cut.n_dropped").alias(dropped_col))
    if rest is None:
        return done
    lines = F.size(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).cast("long")
    return done.union(rest.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(own)], lines.alias(lines_col), F.lit(0).cast("long").alias(dropped_col)))


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, shares: tuple[int, ...] = SHARES, **names: str) -> DataFrame:
    """All documents: index them in batches, and cut what the index says."""
    refs = staged(line_refs(docs, id_col=id_col, text_col=text_col, min_chars=min_chars), "line_refs")
    index = LineIndex.empty(docs.sparkSession, min_chars)
    part, at = F.pmod(F.xxhash64("doc"), F.lit(sum(shares))), 0
    for share in shares:
        index = index.insert_refs(refs.where((part >= at) & (part < at + share)))
        at += share
    index = dataclasses.replace(index, refs=refs)
    return clean(docs, index.to_drop(min_docs), id_col=id_col, text_col=text_col, min_chars=min_chars, **names)
