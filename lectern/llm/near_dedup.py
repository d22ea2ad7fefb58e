"""Near-duplicate documents by SetSketch registers, banded, estimated by likelihood, then verified.

A document is the set of its distinct word shingles. Its SetSketch has `REGISTERS` registers; register
i holds floor(-log_b(x_i)) + offset, truncated to a byte, where x_i is the least of the exponential
variables that hash i gives the shingles. Sketches of parts merge by the greater register, and two
registers agree about as often as the sets overlap, so bands of registers serve as bucket keys.

Exact copies (equal word sequences) are one representative from the start. For representatives:

1. In each bucket every member is compared with the bucket's least member only. The likelihood of the
   register comparisons gives an estimate of the similarity; pairs that may reach the threshold are
   verified on the full shingle sets, and the links make components.
2. Buckets that still hold more than one component are screened: sketches are compared within
   blocks of at most `BLOCK` members (a larger bucket becomes pairs of blocks, dealt to different tasks), and
   the members with a possible partner in another component get their full sets. Within a block,
   verified links join components at once, and pairs that are already joined need no check, so a
   block of n members gives n - 1 links at most. No step emits all pairs of a group.

With 24 bands of 5, a pair at similarity 0.85 shares no bucket with a chance below 1e-6.

Edge cases: texts of fewer words than a shingle are one shingle; a text of any length is sketched whole; without words (or null) a document
is linked with nothing, not even its copies; null ids stand in no component's name (a group of null
ids only has component null); repeated rows fall together; an empty table gives no rows; columns
other than those named are ignored by `near_duplicates` and pass through `keep_first`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import SPACE, dropped, free, picked, staged, tidied

WORDS = 5
THRESHOLD = (85, 100)
BANDS, ROWS = 24, 5
REGISTERS = BANDS * ROWS
BASE = 1.1
OFFSET = 24
#: Standard deviations below the threshold at which an estimate rules a pair out.
SLACK = 5.0
BLOCK = 512
#: Texts sketched at once.
PART = 128
#: Bytes of shingle sets that a block holds on average at most, but for single members.
BLOCK_BYTES = 32 << 20
_A = (np.random.default_rng(20).integers(0, 1 << 63, REGISTERS, np.uint64) << np.uint64(1)) | np.uint64(1)
_B = np.random.default_rng(21).integers(0, 1 << 63, REGISTERS, np.uint64)
_SPACES = SPACE.encode()
_BREAKS = bytes.maketrans(_SPACES, b" " * len(_SPACES))
_P = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    """Words of a text, A-Z lower-cased, as UTF-8."""
    return [w for w in (text or "").encode("utf-8", "surrogatepass").lower().translate(_BREAKS).split(b" ") if w]


def shingle_hashes(words: list[bytes], width: int = WORDS) -> np.ndarray:
    """The set of 64-bit hashes of all runs of `width` words, sorted; of a shorter text, of all its words."""
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(1, len(h) - width + 1)
    out = np.full(n, min(len(h), width), np.uint64)
    for k in range(min(width, len(h))):
        out ^= out >> np.uint64(31)
        out = (out + h[k : k + n]) * _P
    return np.unique(out ^ (out >> np.uint64(32)))


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """A row of registers for each set, none of which is empty."""
    out = np.zeros((len(sets), REGISTERS), np.uint8)
    lo = 0
    while lo < len(sets):
        # Blocks that stay in the cache.
        hi, size = lo, 0
        while hi < len(sets) and (hi == lo or size + len(sets[hi]) <= 32_768):
            size += len(sets[hi])
            hi += 1
        h = np.concatenate(sets[lo:hi])
        starts = np.cumsum([0, *map(len, sets[lo : hi - 1])])
        least = np.empty((REGISTERS, hi - lo), np.uint64)
        v = np.empty_like(h)
        for i in range(REGISTERS):
            np.multiply(h, _A[i], out=v)
            np.add(v, _B[i], out=v)
            np.minimum.reduceat(v, starts, out=least[i])
        x = -np.log1p(-(least.T.astype(np.float64) + 1.0) / 2.0**64.0000001)
        out[lo:hi] = np.clip(np.floor(-np.log(x) / np.log(BASE)) + OFFSET, 0, 255)
        lo = hi
    return out


_GRID = np.linspace(0.0, 1.0, 101)


def estimates(more: np.ndarray, less: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Similarities of the greatest likelihood, for how often the first register is more and less, and the sets' sizes."""
    u, v = (n / (n + m))[:, None], (m / (n + m))[:, None]
    j = np.minimum(_GRID[None, :], np.minimum(n / m, m / n)[:, None])
    p = lambda x: -np.log1p(-np.maximum(x, 0) * (BASE - 1) / BASE) / np.log(BASE)
    up, down = p(u - v * j), p(v - u * j)
    value = more[:, None] * np.log(np.maximum(up, 1e-12)) + less[:, None] * np.log(np.maximum(down, 1e-12)) + (REGISTERS - more - less)[:, None] * np.log(np.maximum(1 - up - down, 1e-12))
    return j[np.arange(len(j)), value.argmax(1)]


def least_estimate(num: int, den: int) -> float:
    t = num / den
    return t - SLACK * float(np.sqrt(t * (1 - t) / REGISTERS)) - 0.01


def similar(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    """Whether two sorted sets have den * |intersection| >= num * |union|."""
    if min(len(a), len(b)) * den < num * max(len(a), len(b)):
        return False
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    at = np.minimum(np.searchsorted(long, short), len(long) - 1)
    both = int((long[at] == short).sum())
    return den * both >= num * (len(a) + len(b) - both)


def sketched(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, copy (128-bit key of the word sequence, null without words), n, sketch."""

    def look(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in tidied(batches):
            # In parts: the words of a whole batch, each an object, take many times its text.
            own = texts.tolist()
            yield pd.concat([some(own[at : at + PART]) for at in range(0, len(own), PART)] or [some([])], ignore_index=True)

    def some(texts: list[str | None]) -> pd.DataFrame:
        words = [words_of(t) for t in texts]
        sets = [shingle_hashes(w) for w in words]
        full = [i for i, s in enumerate(sets) if len(s)]
        made = sketches([sets[i] for i in full])
        out: list[bytes | None] = [None] * len(sets)
        for i, s in zip(full, made):
            out[i] = s.tobytes()
        return pd.DataFrame({"copy": [xxhash.xxh3_128_digest(b" ".join(w)) if w else None for w in words], "n": [len(s) for s in sets], "sketch": out})

    rows = picked(docs, doc_id=id_col, text=text_col)
    return rows.select("doc_id", F.pandas_udf(look, "copy binary, n long, sketch binary")("text").alias("x")).select("doc_id", "x.*")


def bucketed(reps: DataFrame) -> DataFrame:
    """band, key, rep: the buckets of each representative."""
    keys = F.array(*[F.xxhash64(F.lit(k), F.substring(F.col("sketch"), k * ROWS + 1, ROWS)) for k in range(BANDS)])
    return reps.select("rep", F.posexplode(keys).alias("band", "key"))


def components(links: DataFrame) -> DataFrame:
    """v, label: the least vertex that each vertex of links (a, b) reaches, by large and small stars."""
    edges = staged(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    seen = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e")).select(F.col("e.u").alias("u"), F.col("e.m").alias("v"))
        before, edges = edges, staged(small.where("u <> v").distinct(), "edges")
        dropped(before)
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == seen:
            return edges.select(F.col("u").alias("v"), F.col("v").alias("label"))
        seen = now


def full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """rep, hashes: the shingle sets of the representatives in `wanted`, as sorted 64-bit numbers."""

    def look(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in tidied(batches):
            yield pd.Series([shingle_hashes(words_of(t)).tobytes() for t in texts], dtype=object)

    # The list of representatives grows with the documents: one plan at every size.
    rows = docs.join(wanted.hint("merge"), docs["doc_id"] == wanted["rep"], "left_semi")
    made = rows.select(F.col("doc_id").alias("rep"), F.pandas_udf(look, "binary")("text").alias("hashes"))
    return made


def verified_pairs(pairs: DataFrame, reps: DataFrame, docs: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose estimate may reach the threshold and whose full sets do."""
    bar = least_estimate(num, den)

    def may(sa: pd.Series, sb: pd.Series, na: pd.Series, nb: pd.Series) -> pd.Series:
        if not len(sa):
            return pd.Series([], dtype=bool)
        x, y = (np.frombuffer(b"".join(s), np.uint8).reshape(-1, REGISTERS) for s in (sa, sb))
        return pd.Series(estimates((x > y).sum(1), (x < y).sum(1), na.to_numpy(float), nb.to_numpy(float)) >= bar)

    def link(ha: pd.Series, hb: pd.Series) -> pd.Series:
        return pd.Series([similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), num, den) for x, y in zip(ha, hb)], dtype=bool)

    side = lambda x: reps.select(F.col("rep").alias(x), F.col("sketch").alias("s" + x), F.col("n").alias("n" + x))
    close = pairs.join(side("a"), "a").join(side("b"), "b").where(f"na * {den} >= nb * {num} and nb * {den} >= na * {num}")
    close = staged(close.where(F.pandas_udf(may, "boolean")("sa", "sb", "na", "nb")).select("a", "b"), "close_pairs")
    wanted = close.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
    sets = staged(full_sets(docs, wanted), "pair_sets")
    held = lambda x: sets.select(F.col("rep").alias(x), F.col("hashes").alias("h" + x))
    return close.join(held("a"), "a").join(held("b"), "b").where(F.pandas_udf(link, "boolean")("ha", "hb")).select("a", "b")


def _groups(batches: Iterator[pd.DataFrame], by: list[str]) -> Iterator[pd.DataFrame]:
    """Rows that stand together by `by`, from sorted batches."""
    rest: pd.DataFrame | None = None
    for batch in batches:
        if not len(batch):
            continue
        if rest is not None:
            batch = pd.concat([rest, batch], ignore_index=True)
        new = (batch[by] != batch[by].shift()).any(axis=1).to_numpy()
        starts = np.flatnonzero(new)
        for lo, hi in zip(starts[:-1], starts[1:]):
            yield batch.iloc[lo:hi]
        rest = batch.iloc[starts[-1] :]
    if rest is not None:
        yield rest


def _candidates(sketch: np.ndarray, n: np.ndarray, label: np.ndarray, side: np.ndarray, band: int, bar: float, num: int, den: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each row the later rows of another component (and, in a pair of blocks, of the other block) that may be similar
    and share no earlier bucket: each pair is looked at in the first band that both share."""
    mixed = len(set(side.tolist())) > 1
    for i in range(len(n) - 1):
        ok = (label[i + 1 :] != label[i]) & (n[i + 1 :] * den >= n[i] * num) & (n[i] * den >= n[i + 1 :] * num)
        if mixed:
            ok &= side[i + 1 :] != side[i]
        at = np.flatnonzero(ok) + i + 1
        if not len(at):
            continue
        more, less = (sketch[i] > sketch[at]).sum(1), (sketch[i] < sketch[at]).sum(1)
        # Far pairs need no estimate: registers agree at least as often as the sets do.
        near = REGISTERS - more - less >= bar * REGISTERS
        at, more, less = at[near], more[near], less[near]
        if len(at):
            at = at[estimates(more, less, np.full(len(at), float(n[i])), n[at].astype(float)) >= bar]
        if len(at):
            same = (sketch[i] == sketch[at]).reshape(-1, BANDS, ROWS).all(2)
            at = at[same.argmax(1) == band]
        if len(at):
            yield i, at


def residual_links(reps: DataFrame, labels: DataFrame, docs: DataFrame, num: int, den: int) -> DataFrame:
    """Links (a, b) between components that still share buckets."""
    bar = least_estimate(num, den)
    known = reps.join(labels, reps["rep"] == labels["v"], "left").select("rep", "n", "sketch", F.coalesce("label", "rep").alias("label"))
    known = staged(known, "labelled")
    rows = bucketed(known).join(known.select("rep", "label", "n"), "rep")
    mixed = rows.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("size"), (F.sum("n") * 8).alias("bytes"))
    # Blocks are bounded by members and, as their full sets may be fetched, by the bytes of these.
    parts = F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("bytes") / BLOCK_BYTES))
    mixed = mixed.where("lo <> hi").select("key", F.least(parts, "size").cast("int").alias("parts"))
    members = rows.join(mixed, "key")
    own = F.pmod(F.xxhash64("rep", F.lit(3)), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    dealt = members.select("band", "key", "rep", "label", own.alias("own"), other.alias("other")).select("band", "key", "rep", "label", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    group = ["key", "i", "j"]
    full = dealt.join(known.select("rep", "n", "sketch"), "rep").repartition(*group).sortWithinPartitions(*group, "rep")

    def screen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = []
        for g in _groups(batches, group):
            if len(g) < 2:
                continue
            sketch = np.frombuffer(b"".join(g["sketch"]), np.uint8).reshape(-1, REGISTERS)
            some: set[int] = set()
            for a, at in _candidates(sketch, g["n"].to_numpy(), g["label"].to_numpy(), g["own"].to_numpy(), int(g["band"].iloc[0]), bar, num, den):
                some.add(a)
                some.update(at.tolist())
            if some:
                out.append(g.iloc[sorted(some)][["band", *group, "rep", "label", "own", "n", "sketch"]])
            if len(out) >= 1000:
                yield pd.concat(out)
                out = []
        if out:
            yield pd.concat(out)

    kind = reps.schema["rep"].dataType.simpleString()
    open_ = staged(full.select("band", *group, "rep", "label", "own", "n", "sketch").mapInPandas(screen, f"band int, key long, i int, j int, rep {kind}, label {kind}, own int, n long, sketch binary"), "open_members")
    sets = staged(full_sets(docs, open_.select("rep").distinct()), "open_sets")
    ready = open_.join(sets.select("rep", "hashes"), "rep").repartition(*group).sortWithinPartitions(*group, "rep")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in _groups(batches, group):
            g = g.drop_duplicates("rep")
            sketch = np.frombuffer(b"".join(g["sketch"]), np.uint8).reshape(-1, REGISTERS)
            sets = [np.frombuffer(h, np.uint64) for h in g["hashes"]]
            rep, label, own, n = (g[c].to_numpy() for c in ("rep", "label", "own", "n"))
            label = label.copy()
            out = []
            for a, at in _candidates(sketch, n, label, own, int(g["band"].iloc[0]), bar, num, den):
                for b in at:
                    if label[a] != label[b] and similar(sets[a], sets[b], num, den):
                        out.append((rep[a], rep[b]))
                        label[label == label[b]] = label[a]
            if out:
                yield pd.DataFrame(out, columns=["a", "b"])

    return ready.select("band", *group, "rep", "label", "own", "n", "sketch", "hashes").mapInPandas(verify, f"a {kind}, b {kind}")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row."""
    num, den = threshold
    rows = picked(docs, doc_id=id_col, text=text_col)
    seen = staged(sketched(rows), "sketches")
    per_copy = seen.where("copy is not null and doc_id is not null").groupBy("copy").agg(F.min("doc_id").alias("rep"), F.any_value("n").alias("n"), F.any_value("sketch").alias("sketch"))
    reps = staged(per_copy, "representatives")
    buckets = bucketed(reps)
    first = buckets.groupBy("key").agg(F.min("rep").alias("a"), F.max("rep").alias("hi")).where("a <> hi").select("key", "a")
    pairs = buckets.join(first, "key").where("rep <> a").select("a", F.col("rep").alias("b")).distinct()
    links = staged(verified_pairs(pairs, reps, rows, num, den), "star_links")
    more = residual_links(reps, components(links), rows, num, den)
    labels = components(staged(links.union(more), "links"))
    named = reps.join(labels, reps["rep"] == labels["v"], "left").select("copy", F.coalesce("label", "rep").alias("component"))
    told = seen.join(named, "copy", "left")
    component = F.coalesce("component", "doc_id")
    return told.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def keep_first(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """The rows of `docs` of the least id of each component, with all their columns; of repeated rows all stay."""
    name = free("kept_id", docs.columns)
    keep = near_duplicates(docs, id_col=id_col, text_col=text_col, threshold=threshold).where("kept").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(keep, docs[id_col].eqNullSafe(keep[name]), "left_semi")
