"""Long repeated passages by a logarithmic family of sparse suffix arrays.

Every window of `length` bytes has one *anchor*: the start, in the window, of the `gram`-byte string
with the least hash (the leftmost on ties). Equal windows have equal anchors at equal distances, and
neighbouring windows share theirs, so a text has about one anchor in 150 bytes. A batch's suffix
array holds the suffixes that start at anchors, in the order of their text (their first `gram` bytes;
an entry also names the windows that the anchor serves, and a hash of all bytes that these cover,
which orders entries further). Entries with the same bytes are one row with their number and one
place.

The arrays of earlier batches are levels: tables in text order. A new array is merge-scanned with each
level: both are range-partitioned by their text, and neighbours whose common prefix is at least `gram`
bytes are told. Levels of about the size of what is added merge with it in the same scan, so that
there are logarithmically many. Entries of the batch and of a level that agree in all their bytes are
matches at once, which settles the inside of long matches. Entries that share only their first `gram`
bytes or more stand at the ends of matches: they are put down and `settled` for all batches together,
by the longest common prefixes before and behind their anchors. Two windows at distance d from their
anchors are equal where d bytes before and `length` - d behind agree; for each d these are classes of
neighbours in the two sorted orders of a group. Groups of more than `group` different ends aren't
gathered: their windows are hashed and counted over the whole cluster with partial sums.

Anchors, and classes in groups up to `group`, are told by their bytes; equality of all bytes that an
entry covers, and windows of larger groups, by 64-bit hashes, which is exact but for collisions.

Edge cases: a null text is empty and loses nothing; texts below `length` bytes have no window; equal
texts of at least `length` bytes vanish altogether, first copies too, as windows are judged on the
input; repeated rows count as places of their own; a text of one repeated letter, or any period, has
one entry for each place in its period, and its ranges are merged before they leave the task; long
texts are read in parts of `PART` bytes; an empty table gives no rows; columns other than those named
are ignored.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import BROADCAST_IDS, dropped, picked, staged, tidied

LENGTH = 400
GRAM = 100
#: Different ends at one anchor that are compared in one task.
GROUP = 20_000
#: Bytes of a text that are hashed at once; longer texts go in overlapping parts.
PART = 1 << 20
#: The batches of one table: shares of its rows in 256ths.
SHARES = (128, 64, 64)
NO_ID = -(1 << 63)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_VALUE = np.random.default_rng(10).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2^64."""
    if len(_powers.get("up", ())) < n:
        size = 1 << max(12, (n - 1).bit_length())
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for name, b in (("up", _BASE), ("down", inverse)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            _powers[name] = np.multiply.accumulate(p)
    return _powers["up"][:n], _powers["down"][:n]


class Hashed:
    """Hashes of all substrings of one byte string in constant time each."""

    def __init__(self, raw: bytes):
        n = len(raw)
        up, self.down = powers(n + 1)
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum(_VALUE[np.frombuffer(raw, np.uint8)] * up[:n], out=self.total[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (self.total[ends] - self.total[starts]) * self.down[starts]
        return _mix(h)

    def all(self, length: int) -> np.ndarray:
        return _mix((self.total[length:] - self.total[:-length]) * self.down[: len(self.total) - length])


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def sliding_least(v: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours."""
    n = len(v) - width + 1
    padded = np.full(-(-len(v) // width) * width, np.uint64(2**64 - 1))
    padded[: len(v)] = v
    block = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(block, axis=1).ravel()
    behind = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


_PLACE = np.uint64((1 << 22) - 1)


def anchors_of(raw: bytes, length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """Rows of x, lo, hi, full: the anchors, the windows lo..hi that each serves, and the hash of all bytes of these."""
    out = []
    step = max(PART, 4 * length)
    for at in range(0, max(1, len(raw) - length + 1), step):
        part = raw[at : at + step + length - 1]
        if len(part) < length:
            break
        hashed = Hashed(part)
        grams = hashed.all(gram)
        order = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
        x = (sliding_least(order, length - gram + 1) & _PLACE).astype(np.int64)
        lo = np.flatnonzero(np.r_[True, x[1:] != x[:-1]])
        hi = np.r_[lo[1:], len(x)] - 1
        x = x[lo]
        shape = ((x - lo) << 20 | (hi - x + length)).astype(np.uint64)
        full = _mix(hashed.of(lo, hi + length) ^ _mix(shape) + grams[x])
        out.append(np.stack([x + at, lo + at, hi + at, full.view(np.int64)], 1))
    return np.concatenate(out) if out else np.zeros((0, 4), np.int64)


def merged(lo: np.ndarray, hi: np.ndarray) -> list[tuple[int, int]]:
    """Ranges lo..hi (exclusive) as few disjoint ones."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(zip(lo.tolist(), hi.tolist())):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_ENTRY = "suffix binary, full long, n long, doc long, tie long, at long"


def packed(lo, x, hi):
    """One number for an anchor and its windows; the distances are below 2^15."""
    return lo << 30 | (x - lo) << 15 | (hi - lo)


def suffix_entries(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """suffix, full, n, doc, tie, at for `docs` of doc, tie, text: a text's different entries, each with the number of its places.

    Where that is more than one, the ranges that these cover stand in rows of their own: suffix null, at and n their ends.
    """

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in tidied(batches):
            for s in range(0, len(b), 250):
                part = b.iloc[s : s + 250]
                texts: list[bytes | None] = []
                full, n, doc, tie, at = [], [], [], [], []
                for d, t, text in zip(part["doc"].tolist(), part["tie"].tolist(), part["text"]):
                    raw = (text or "").encode("utf-8", "surrogatepass")
                    found = anchors_of(raw, length, gram)
                    if not len(found):
                        continue
                    own, first, inverse, count = np.unique(found[:, 3], return_index=True, return_inverse=True, return_counts=True)
                    x, lo, hi = found[first, 0], found[first, 1], found[first, 2]
                    texts += [raw[i : i + gram] for i in x.tolist()]
                    full.append(own)
                    n.append(count)
                    at.append(packed(lo, x, hi))
                    again = found[count[inverse] > 1]
                    ranges = merged(again[:, 1], again[:, 2] + length)
                    if ranges:
                        texts += [None] * len(ranges)
                        full.append(np.zeros(len(ranges), np.int64))
                        at.append(np.array([a for a, _ in ranges]))
                        n.append(np.array([z for _, z in ranges]))
                    doc.append(np.full(len(own) + len(ranges), d))
                    tie.append(np.full(len(own) + len(ranges), t))
                if texts:
                    yield pd.DataFrame({"suffix": texts, **{k: np.concatenate(v) for k, v in (("full", full), ("n", n), ("doc", doc), ("tie", tie), ("at", at))}})

    return docs.mapInPandas(look, _ENTRY)


def numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = picked(docs, doc_id=id_col, text=text_col)
    return rows.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64("text").alias("tie"), "text")


def merge_scan(new: DataFrame, old: DataFrame | None) -> DataFrame:
    """Both arrays as one, in text order, from rows of suffix, full, n, doc, tie, at.

    fresh: whether the entry is in `new`; woke: whether an entry that stood alone in `old` is in `new`
    too; met: whether neighbours with its first `gram` bytes include a new one and one that stands
    alone (also true at the borders of what is scanned at once, where this can't be told).
    """
    both = new.withColumn("fresh", F.lit(True))
    if old is not None:
        both = both.unionByName(old.withColumn("fresh", F.lit(False)))
    order = both.repartitionByRange("suffix", "full").sortWithinPartitions("suffix", "full", "fresh")

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for b in batches:
            b = b if rest is None else pd.concat([rest, b], ignore_index=True)
            if not len(b):
                continue
            # Rows of the last entry wait for those that may follow.
            ends = ((b["full"] == b["full"].iloc[-1]) & (b["suffix"] == b["suffix"].iloc[-1])).to_numpy()
            if not ends.all():
                yield told(b[~ends])
            rest = b[ends]
        if rest is not None:
            yield told(rest)

    def told(b: pd.DataFrame) -> pd.DataFrame:
        suffix, full = b["suffix"].to_numpy(), b["full"].to_numpy()
        other = np.r_[True, suffix[1:] != suffix[:-1]]
        starts = np.flatnonzero(other | np.r_[True, full[1:] != full[:-1]])
        n, fresh = b["n"].to_numpy(), b["fresh"].to_numpy()
        out = b.iloc[starts].copy()
        out["n"] = np.add.reduceat(n, starts)
        out["fresh"] = np.logical_or.reduceat(fresh, starts)
        out["woke"] = np.logical_or.reduceat(~fresh & (n == 1), starts) & out["fresh"]
        # Groups of neighbours with a common prefix of `gram` bytes.
        groups = np.flatnonzero(other[starts])
        size = np.diff(np.r_[groups, len(out)])
        met = (size > 1) & np.logical_or.reduceat(out["fresh"].to_numpy(), groups) & np.logical_or.reduceat(out["n"].to_numpy() == 1, groups)
        met[[0, -1]] = True
        out["met"] = np.repeat(met, size)
        return out

    return order.mapInPandas(scan, _ENTRY + ", fresh boolean, woke boolean, met boolean")


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    return n - ((int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")).bit_length() + 7) // 8


def common_suffix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if not n:
        return 0
    return n - ((int.from_bytes(a[-n:], "little") ^ int.from_bytes(b[-n:], "little")).bit_length() + 7) // 8


def repeated_distances(before: list[bytes], behind: list[bytes], length: int) -> Iterator[tuple[int, int, int]]:
    """(end, least d, greatest d): runs of distances at which an end's window equals another end's.

    An end has the bytes before its anchor and those from the anchor on; its windows start at most
    len(before) bytes before the anchor, and end where its bytes do.
    """
    k = len(before)
    most = np.array([len(b) for b in before])
    least = length - np.array([len(b) for b in behind])
    if k == 2:
        lo = max(length - common_prefix(*behind), int(least.max()))
        hi = common_suffix(*before)
        if lo <= hi:
            yield from ((i, lo, hi) for i in (0, 1))
        return
    onward = np.array(sorted(range(k), key=behind.__getitem__))
    backward = [b[::-1] for b in before]
    back = np.array(sorted(range(k), key=backward.__getitem__))
    ahead = np.array([common_prefix(behind[a], behind[b]) for a, b in zip(onward, onward[1:])])
    ago = np.array([common_suffix(before[a], before[b]) for a, b in zip(back, back[1:])])
    first, last = max(0, int(np.sort(least)[1])), int(np.sort(most)[-2])
    hit = np.zeros((max(0, last - first + 1), k), bool)
    one, two = np.empty(k, np.int64), np.empty(k, np.int64)
    # Classes change only where a common prefix or suffix ends, or an end's windows begin or cease.
    turns = np.unique(np.r_[first, length - ahead, ago + 1, least, most + 1])
    turns = turns[(turns >= first) & (turns <= last)].tolist()
    for d, until in zip(turns, [*turns[1:], last + 1]):
        one[onward] = np.r_[0, np.cumsum(ahead < length - d)]
        two[back] = np.r_[0, np.cumsum(ago < d)]
        served = np.flatnonzero((least <= d) & (d <= most))
        if len(served) < 2:
            continue
        code = one[served] * k + two[served]
        order = np.argsort(code, kind="stable")
        same = code[order][1:] == code[order][:-1]
        hit[d - first : until - first, served[order[np.r_[same, False] | np.r_[False, same]]]] = True
    edge = np.diff(np.pad(hit.astype(np.int8), ((1, 1), (0, 0))), axis=0).T
    for (i, a), (_, z) in zip(np.argwhere(edge == 1), np.argwhere(edge == -1)):
        yield int(i), first + int(a), first + int(z) - 1


_RANGE = "doc long, tie long, lo long, hi long"


@dataclasses.dataclass(frozen=True)
class SuffixIndex:
    """Levels of sparse suffix arrays, from the largest; the ranges found so far; the ends to settle; all rows of the batches."""

    levels: tuple[tuple[int, DataFrame], ...] = ()
    found: DataFrame | None = None
    ends: DataFrame | None = None
    texts: DataFrame | None = None
    length: int = LENGTH
    gram: int = GRAM
    group: int = GROUP

    @classmethod
    def empty(cls, length: int = LENGTH, gram: int = GRAM, group: int = GROUP) -> SuffixIndex:
        return cls(length=length, gram=gram, group=group)

    def add(self, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> SuffixIndex:
        """With a batch: scanned with all levels, of which those of about its size merge with it."""
        if self.length >= 1 << 15:
            raise ValueError("windows of 32 KiB and more don't fit the packed entries")
        rows = numbered(docs, id_col, text_col)
        made = staged(suffix_entries(rows, self.length, self.gram), "suffixes")
        entries = made.where("suffix is not null")
        # Partial sums come before the shuffle: an entry in a third of all rows is one row a task.
        once = entries.groupBy("suffix", "full").agg(F.sum("n").alias("n"), *[F.first(c).alias(c) for c in ("doc", "tie", "at")])
        size, levels, old = entries.count(), list(self.levels), None
        while levels and levels[-1][0] <= 1.5 * size:
            more, level = levels.pop()
            size, old = size + more, level if old is None else old.unionByName(level)
        run = staged(merge_scan(once, old), "level")
        columns = [c.split()[0] for c in _ENTRY.split(", ")]
        scans = [run.where("fresh")]
        for _, level in levels:
            scans.append(staged(merge_scan(run.where("fresh").select(columns), level).where("fresh or woke or met"), "scan"))
        told = scans[0]
        for more in [run.where("woke or met"), *scans[1:]]:
            told = told.unionByName(more)
        twice = told.where("fresh and n > 1").select("full").distinct()
        end = lambda bits: self._lo(bits) + self._span(bits) + self.length
        inside = entries.join(twice, "full", "left_semi").unionByName(told.where("woke").select(columns))
        inside = inside.select("doc", "tie", self._lo(F.col("at")).alias("lo"), end(F.col("at")).alias("hi"))
        own = made.where("suffix is null").select("doc", "tie", F.col("at").alias("lo"), F.col("n").alias("hi"))
        found = staged(inside.union(own), "found")
        ends = staged(told.where("met").select(columns), "ends")
        dropped(made, *scans[1:])
        joined = lambda a, b: b if a is None else a.union(b)
        return dataclasses.replace(self, levels=(*levels, (size, run.select(columns))), found=joined(self.found, found), ends=joined(self.ends, ends), texts=joined(self.texts, rows))

    @staticmethod
    def _lo(at):
        return F.shiftright(at, 30)

    @staticmethod
    def _span(at):
        return at.bitwiseAND(32767)

    def settled(self) -> SuffixIndex:
        """With the ends compared, and the ranges of their matches among those found."""
        if self.ends is None:
            return self
        # A hot entry is one row in each of logarithmically many levels.
        ends = self.ends.groupBy(F.xxhash64("suffix").alias("key"), "full").agg(F.max("n").alias("n"), *[F.first(c).alias(c) for c in ("doc", "tie", "at")])
        ends = staged(ends, "different_ends")
        groups = staged(ends.groupBy("key").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("few")).where("kinds > 1 and few = 1").select("key", "kinds"), "groups")
        context = staged(self._contexts(ends.join(groups, "key")), "contexts")
        more = staged(self._gathered(context.where(F.col("kinds") <= self.group)).union(self._counted(context.where(F.col("kinds") > self.group))), "found")
        dropped(ends, groups, context)
        return dataclasses.replace(self, found=self.found.union(more), ends=None)

    def _contexts(self, ends: DataFrame) -> DataFrame:
        """The ends with the bytes that their windows cover, before the anchor and from it on."""
        length = self.length
        # Of one text, so bounded by its length.
        per_text = staged(ends.groupBy("doc", "tie").agg(F.collect_list(F.struct("key", "full", "kinds", "n", "at")).alias("near")), "ends_by_text")
        # Repeated rows bring an end once for each row.
        met = _with_ids(self.texts, per_text).dropDuplicates(["doc", "tie"]).join(per_text, ["doc", "tie"])

        def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in tidied(batches):
                for s in range(0, len(b), 200):
                    out = []
                    for doc, tie, text, near in b.iloc[s : s + 200][["doc", "tie", "text", "near"]].itertuples(index=False):
                        raw = text.encode("utf-8", "surrogatepass")
                        for e in near:
                            lo, before, more = e["at"] >> 30, e["at"] >> 15 & 32767, e["at"] & 32767
                            out.append((doc, tie, e["key"], e["full"], e["kinds"], e["n"] == 1, lo + before, raw[lo : lo + before], raw[lo + before : lo + more + length]))
                    yield pd.DataFrame(out, columns=["doc", "tie", "key", "full", "kinds", "open", "x", "before", "behind"])

        return met.mapInPandas(cut, "doc long, tie long, key long, full long, kinds long, open boolean, x long, before binary, behind binary")

    def _gathered(self, context: DataFrame) -> DataFrame:
        length = self.length
        sent = context.select("key", "doc", "tie", "open", "x", "before", "behind").repartition("key").sortWithinPartitions("key")

        def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held: list[tuple] = []
            for b in tidied(batches):
                out = []
                for row in b.itertuples(index=False, name=None):
                    if held and held[-1][0] != row[0]:
                        out += resolve(held)
                        held = []
                    held.append(row)
                yield made(out)
            yield made(resolve(held))

        def made(out: list[tuple]) -> pd.DataFrame:
            return pd.DataFrame(out, columns=["doc", "tie", "lo", "hi"])

        def resolve(held: list[tuple]) -> list[tuple]:
            if len(held) < 2:
                return []
            runs = repeated_distances([r[5] for r in held], [r[6] for r in held], length)
            return [(held[i][1], held[i][2], held[i][4] - z, held[i][4] - a + length) for i, a, z in runs if held[i][3]]

        return sent.mapInPandas(compare, _RANGE)

    def _counted(self, context: DataFrame) -> DataFrame:
        """As `_gathered`, a row per window: for groups too large to gather."""
        length = self.length

        def spell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in tidied(batches):
                for s in range(0, len(b), 200):
                    part = b.iloc[s : s + 200]
                    raws = [x + y for x, y in zip(part["before"], part["behind"])]
                    n = np.array([len(r) - length + 1 for r in raws])
                    nth = np.concatenate([np.arange(k) for k in n])
                    h = np.concatenate([Hashed(r).all(length) for r in raws])
                    before = part["before"].map(len).to_numpy()
                    h = _mix(h ^ _mix((np.repeat(before, n) - nth).astype(np.uint64)) + np.repeat(part["key"].to_numpy().view(np.uint64), n))
                    yield pd.DataFrame({"window": h.view(np.int64), **{c: np.repeat(part[c].to_numpy(), n) for c in ("doc", "tie", "open")}, "at": np.repeat(part["x"].to_numpy() - before, n) + nth})

        spelt = staged(context.mapInPandas(spell, "window long, doc long, tie long, open boolean, at long"), "windows")
        twice = spelt.groupBy("window").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("window")
        return spelt.where("open").join(twice, "window", "left_semi").select("doc", "tie", F.col("at").alias("lo"), (F.col("at") + length).alias("hi"))

    def cut(self, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """doc_id, n_bytes, n_removed, n_spans, and what is left of the text (kept, binary)."""
        found = self.settled().found
        lost = found.groupBy("doc", "tie").agg(F.collect_set(F.struct("lo", "hi")).alias("ranges"))
        rows = picked(docs, doc_id=id_col, text=text_col)
        rows = rows.select("doc_id", "text", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64("text").alias("tie"))
        met = rows.join(lost, ["doc", "tie"], "left")

        def take(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
            for texts, ranges in tidied(batches):
                out = []
                for text, own in zip(texts, ranges):
                    raw = (text or "").encode("utf-8", "surrogatepass")
                    kept, at, spans = [], 0, 0
                    if own is not None:
                        for lo, hi in merged(np.array([r["lo"] for r in own]), np.array([r["hi"] for r in own])):
                            kept.append(raw[at:lo])
                            at = hi
                            spans += 1
                    left = b"".join(kept) + raw[at:]
                    out.append((len(raw), len(raw) - len(left), spans, left))
                yield pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept"])

        done = met.select("doc_id", F.pandas_udf(take, "n_bytes long, n_removed long, n_spans long, kept binary")("text", "ranges").alias("x"))
        return done.select("doc_id", "x.*")


def _with_ids(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of `texts` whose doc and tie are in `ids`, picked where they stand if the ids are few."""
    keys = ids.select("doc", "tie")
    return texts.join(F.broadcast(keys) if keys.count() <= BROADCAST_IDS else keys, ["doc", "tie"], "left_semi")


def dedup_passages(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, shares: tuple[int, ...] = SHARES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept for all documents, which enter the index in batches."""
    index = SuffixIndex.empty(length, gram)
    part, at = F.pmod(F.xxhash64(docs[id_col], F.lit(5)), F.lit(sum(shares))), 0
    for share in shares:
        index = index.add(docs.where((part >= at) & (part < at + share)), id_col=id_col, text_col=text_col)
        at += share
    return index.cut(docs, id_col=id_col, text_col=text_col)
