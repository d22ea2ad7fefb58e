"""Language identification by interpolated Kneser-Ney character models, one per language.

Texts are lower-cased, runs of anything but letters become one space, and every character is
predicted from the four before it. Five-gram counts are summed over all training rows (partial sums
per task, then one small shuffle); lower orders use continuation counts, and each order's discount
comes from its own full counts (n1 / (n1 + 2 n2), within 0.1 to 0.9). Nothing is cut. Each order's
grams stand in one sorted array of 64-bit hashes, shared by a part's languages, beside a matrix of
log-probabilities; weights of unseen continuations stand in a second such array for contexts. A text
gets the language of the lowest cross-entropy per character.

A model is made of parts of at most `LANGUAGES` languages and about `PART_GRAMS` five-gram kinds (or
one language that has more): that bounds the matrix, and what a worker holds at once. With several
parts the texts are scored once for each, and the sums meet by row.

Rejection is calibrated on all training rows that the counts leave out: for each length class, a
text is rejected whose best cross-entropy lies further beyond their median than `SPREAD` times their
`QUANTILE` does. They meet as counts of cross-entropies in steps of 1 / `STEPS` nats.

Bounds: none on rows; the counts that come to the driver are as many as classes and steps, not rows.
The model grows with the kinds of five-grams in the training rows. The counts cover all training rows
but the fold of one in `CALIBRATION_FOLD` that calibrates, as a model is surer of rows it has seen,
and those too of a language that has no other.

Edge cases: a null text, or one without a letter, is `und` with score 0 and rejected; a long text is
scored whole, `BLOCK` characters at a time; ties go to the language that sorts first; without
training rows everything is `und`; repeated rows count as often as they stand; an empty table gives
no rows; columns other than those named are ignored by `identify` and pass through `keep_identified`,
whatever their names.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._store import free, picked, staged, tidied

ORDER = 5
#: Languages, and kinds of five-grams, of one part of a model.
LANGUAGES = 8
PART_GRAMS = 2_000_000
#: Kinds of five-grams that a counting task holds at most.
HELD_GRAMS = 400_000
#: Steps of a nat in which the cross-entropies that calibrate are counted.
STEPS = 1_000
QUANTILE = 0.9995
SPREAD = 2.0
#: One training row in so many, by the hash of its text, calibrates and isn't counted.
CALIBRATION_FOLD = 8
#: Texts judged at once.
ROWS = 256
#: Characters handled at once.
BLOCK = 1 << 18
PRIME = np.uint64(0x9E3779B97F4A7C15)
UNKNOWN = "und"
_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For every code point, whether it is a letter."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def normal(text: str) -> np.ndarray:
    """Code points of the lower-cased letters, with one space after each run; empty without a letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = letters()[codes]
    if not letter.any():
        return codes[:0]
    last = np.r_[False, letter[:-1]] & ~letter
    codes = np.where(letter, codes, np.uint32(32))[letter | last]
    return codes if codes[-1] == 32 else np.r_[codes, np.uint32(32)]


_AHEAD = np.full(ORDER - 1, 32, np.uint32)


def blocks(texts: Iterable[np.ndarray]) -> Iterator[tuple[np.ndarray, list[tuple[int, int, int]]]]:
    """Codes of many texts in one array of about BLOCK, each behind ORDER - 1 spaces, with (text, begin, end)
    of the characters to predict, counted from the first that has a full context. Long texts are cut,
    and go on behind the characters before the cut."""
    parts: list[np.ndarray] = []
    spans: list[tuple[int, int, int]] = []
    held = 0
    for i, text in enumerate(texts):
        for at in range(0, len(text), BLOCK):
            piece = text[at : at + BLOCK]
            parts += [text[at - ORDER + 1 : at] if at >= ORDER - 1 else _AHEAD, piece]
            spans.append((i, held, held + len(piece)))
            held += len(piece) + ORDER - 1
            if held >= BLOCK:
                yield np.concatenate(parts).astype(np.uint64), spans
                parts, spans, held = [], [], 0
    if parts:
        yield np.concatenate(parts).astype(np.uint64), spans


class Sorted:
    """Sorted 64-bit hashes with the place where each value of their top bits begins."""

    def __init__(self, values: np.ndarray):
        self.values = np.r_[values, np.uint64(2**64 - 1)]
        self.shift = np.uint64(64 - max(1, int(np.ceil(np.log2(len(values) + 2)))))
        tops = np.arange((1 << int(64 - self.shift)) + 1, dtype=np.float64) * 2.0 ** float(self.shift)
        self.starts = np.searchsorted(values, np.minimum(tops, 2.0**64 - 2049).astype(np.uint64)).astype(np.int32)
        self.starts[-1] = len(values)
        self.most = int(np.diff(self.starts).max(initial=0))

    def find(self, h: np.ndarray) -> np.ndarray:
        """Place of each hash, -1 where it is unknown."""
        at = self.starts[h >> self.shift]
        hit = self.values[at] == h
        out = np.where(hit, at, -1)
        left = np.flatnonzero(~hit & (self.values[at] < h))
        for _ in range(self.most):
            if not len(left):
                break
            step = at[left] + 1
            at[left] = step
            value, want = self.values[step], h[left]
            out[left[value == want]] = step[value == want]
            left = left[value < want]
        return out


def hashes(codes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n-gram that ends at each position from n - 1 on."""
    m = len(codes) - n + 1
    return mixed([codes[k : k + m] for k in range(n)])


def mixed(columns: list[np.ndarray]) -> np.ndarray:
    h = columns[0] * PRIME
    for c in columns[1:]:
        h ^= h >> np.uint64(29)
        h += c
        h *= PRIME
    return h


def counted_grams(codes: np.ndarray, spans: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """How often each different five-gram ends in the spans of a block, and its code points."""
    m = len(codes) - ORDER + 1
    # What ends in the spaces between two texts is no gram of either.
    inside = np.ones(m + ORDER, bool)
    inside[(np.array([end for _, _, end in spans])[:, None] + np.arange(ORDER - 1)).ravel()] = False
    inside = inside[:m]
    if codes.max() < 1 << 12:
        # Five code points of twelve bits fit one number, and numbers sort fastest.
        packed = codes[:m].copy()
        for k in range(1, ORDER):
            packed <<= np.uint64(12)
            packed |= codes[k : k + m]
        packed = packed[inside]
        packed.sort()
        starts = np.flatnonzero(np.r_[True, packed[1:] != packed[:-1]])
        own = packed[starts]
        grams = np.stack([(own >> np.uint64(12 * (ORDER - 1 - k))) & np.uint64(4095) for k in range(ORDER)], 1)
        return np.diff(np.r_[starts, len(packed)]), grams.astype(np.uint32)
    _, first, n = np.unique(hashes(codes, ORDER)[inside], return_index=True, return_counts=True)
    return n, np.lib.stride_tricks.sliding_window_view(codes.astype(np.uint32), ORDER)[inside][first]


def gram_counts(rows: DataFrame) -> DataFrame:
    """lang, gram, n: five-gram counts over rows of lang and text."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: dict[str, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        size = 0

        def merged(parts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            h, n, g = (np.concatenate(x) for x in zip(*parts))
            own, first, inverse = np.unique(h, return_index=True, return_inverse=True)
            return own, np.bincount(inverse, n).astype(np.int64), g[first]

        def out() -> Iterator[pd.DataFrame]:
            for lang, parts in kept.items():
                _, n, g = merged(parts)
                yield pd.DataFrame({"lang": lang, "gram": np.ascontiguousarray(g).view(f"<U{ORDER}").ravel(), "n": n})
            kept.clear()

        for batch in tidied(batches):
            for lang, own in batch.groupby("lang"):
                for codes, spans in blocks(normal(t) for t in own["text"]):
                    n, grams = counted_grams(codes, spans)
                    own_h = mixed([grams[:, k].astype(np.uint64) for k in range(ORDER)])
                    kept.setdefault(lang, []).append((own_h, n, grams))
                    size += len(n)
                    if len(kept[lang]) >= 4:
                        size -= sum(len(p[0]) for p in kept[lang])
                        kept[lang] = [merged(kept[lang])]
                        size += len(kept[lang][0][0])
                    if size > HELD_GRAMS:
                        yield from out()
                        size = 0
        yield from out()

    counted = rows.select(F.col("lang").cast("string").alias("lang"), "text").mapInPandas(count, "lang string, gram string, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclasses.dataclass
class Model:
    """Sorted hash arrays: for each order the grams with log-probabilities, and the contexts with log-weights."""

    langs: list[str]
    grams: list[np.ndarray]
    logp: list[np.ndarray]
    contexts: list[np.ndarray]
    weight: list[np.ndarray]
    floor: np.ndarray

    @classmethod
    def fit(cls, langs: list[str], lang: np.ndarray, codes: np.ndarray, n: np.ndarray, letters: int) -> Model:
        """From five-grams: number of the language in `langs`, code points (a row each), count; and the number of different characters."""
        columns = lambda g: [g[:, k].astype(np.uint64) for k in range(g.shape[1])]
        orders = {ORDER: (lang, codes, n.astype(float))}
        for order in range(ORDER - 1, 0, -1):
            # Continuation counts: how many different grams of the next order end with this one.
            lang, codes, _ = orders[order + 1]
            codes = codes[:, 1:]
            by = np.lexsort((h := mixed(columns(codes)), lang))
            new = np.flatnonzero(np.r_[True, (h[by][1:] != h[by][:-1]) | (lang[by][1:] != lang[by][:-1])])
            orders[order] = (lang[by][new], codes[by][new], np.diff(np.r_[new, len(by)]).astype(float))
        floor = np.full(len(langs), np.log(1.0 / (letters + 1)))
        grams, logp, contexts, weight = [], [], [], []
        below_at, below = np.zeros(0, np.uint64), np.exp(floor)[None, :]
        for order in range(1, ORDER + 1):
            lang, codes, c = orders[order]
            union, first, at = np.unique(mixed(columns(codes)), return_index=True, return_inverse=True)
            value = np.zeros((len(union), len(langs)))
            value[at, lang] = c
            own = columns(codes[first])
            heads, head_at = np.unique(mixed(own[:-1]), return_inverse=True) if order > 1 else (np.zeros(1, np.uint64), np.zeros(len(union), int))
            tail_at = np.searchsorted(below_at, mixed(own[1:])) if order > 1 else np.zeros(len(union), int)
            p = np.zeros(value.shape)
            lam = np.ones((len(heads), len(langs)))
            for k in range(len(langs)):
                mine = c[lang == k]
                ones, twos = float((mine == 1).sum()), float((mine == 2).sum())
                cut = min(0.9, max(0.1, ones / max(1.0, ones + 2 * twos)))
                total = np.bincount(head_at, value[:, k], len(heads))
                kinds = np.bincount(head_at, value[:, k] > 0, len(heads))
                seen = total > 0
                lam[seen, k] = cut * kinds[seen] / total[seen]
                p[:, k] = np.maximum(value[:, k] - cut, 0) / np.maximum(total, 1e-300)[head_at] + lam[head_at, k] * below[tail_at, k]
            grams.append(union)
            logp.append(np.log(p).astype(np.float32))
            contexts.append(heads if order > 1 else np.zeros(0, np.uint64))
            weight.append(np.log(lam).astype(np.float32))
            below_at, below = union, p
        return cls(langs, grams, logp, contexts, weight, floor.astype(np.float32))

    def __post_init__(self) -> None:
        self.tables = [Sorted(g) for g in self.grams]
        self.heads = [Sorted(c) for c in self.contexts]

    def log_probabilities(self, codes: np.ndarray) -> np.ndarray:
        """A row for each position from ORDER - 1 on: the log-probability in each language."""
        at = self.tables[-1].find(hashes(codes, ORDER))
        out = self.logp[-1][at]
        left = np.flatnonzero(at < 0)
        out[left] = 0
        for n in range(ORDER, 1, -1):
            # Positions that no longer gram has answered: the context's weight, and the next shorter gram.
            if not len(left):
                return out
            near = [codes[left + ORDER - 1 - k] for k in range(n - 1, -1, -1)]
            at = self.heads[n - 1].find(mixed(near[:-1]))
            out[left[at >= 0]] += self.weight[n - 1][at[at >= 0]]
            at = self.tables[n - 2].find(mixed(near[1:]))
            out[left[at >= 0]] += self.logp[n - 2][at[at >= 0]]
            left = left[at < 0]
        out[left] += self.weight[0][0] + self.floor
        return out

    def nats(self, texts: list[np.ndarray]) -> np.ndarray:
        """Nats of each text in each language; normal texts, none empty."""
        total = np.zeros((len(texts), len(self.langs)))
        for codes, spans in blocks(texts):
            lp = self.log_probabilities(codes)
            for doc, begin, end in spans:
                total[doc] -= lp[begin:end].sum(0, dtype=np.float64)
        return total


def nats_of(shared, text: Column) -> Column:
    """struct(nats, n): nats in each of a part's languages, and the number of characters; n is 0, and nats null, without letters."""

    def look(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in tidied(batches):
            own, out, sizes = batch.tolist(), [], []
            # In parts: the code points of a whole batch take several times its text.
            for at in range(0, len(own), ROWS):
                plain = [normal(t or "") for t in own[at : at + ROWS]]
                full = [i for i, t in enumerate(plain) if len(t)]
                made: list[list[float] | None] = [None] * len(plain)
                if full:
                    for i, row in zip(full, shared.value.nats([plain[i] for i in full]).tolist()):
                        made[i] = row
                out += made
                sizes += map(len, plain)
            yield pd.DataFrame({"nats": pd.Series(out, dtype=object), "n": np.array(sizes, np.int64)})

    # Called non-deterministic so that a filter on the result doesn't run it a second time.
    return F.pandas_udf(look, "nats array<double>, n long").asNondeterministic()(text)


@dataclasses.dataclass
class Identifier:
    """A model in parts; the limits of cross-entropy by length class."""

    langs: list[str]
    parts: list
    limits: list[float] | None = None

    def told(self, rows: DataFrame, text_col: str, name: str) -> DataFrame:
        """`rows` with a struct `name`(lang_pred, score, cross_entropy, rejected, n)."""
        if len(self.parts) <= 1:
            scored = nats_of(self.parts[0], F.col(text_col)) if self.parts else F.struct(F.lit(None).cast("array<double>").alias("nats"), F.lit(0).cast("long").alias("n"))
            return rows.select("*", scored.alias(name)).withColumn(name, self._judged(F.col(name)))
        row, part = free("row", rows.columns), free("part", rows.columns)
        rows = staged(rows.withColumn(row, F.monotonically_increasing_id()), "rows")
        sums = None
        for k, shared in enumerate(self.parts):
            own = staged(rows.select(row, F.lit(k).alias(part), nats_of(shared, F.col(text_col)).alias(name)), "nats")
            sums = own if sums is None else sums.union(own)
        every = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(part, f"{name}.nats"))), lambda x: x["nats"]))
        met = sums.groupBy(row).agg(F.struct(every.alias("nats"), F.first(f"{name}.n").alias("n")).alias(name))
        return rows.join(met, row).drop(row).withColumn(name, self._judged(F.col(name)))

    def _judged(self, x: Column) -> Column:
        empty = (x["n"] == 0) | F.lit(not self.langs)
        langs = F.array(*[F.lit(k) for k in self.langs]) if self.langs else F.array(F.lit(UNKNOWN))
        low = F.array_min(x["nats"])
        best = F.when(~empty, low / x["n"])
        # Posterior under equal priors, with the evidence of a hundred characters at most.
        odds = F.aggregate(x["nats"], F.lit(0.0), lambda a, v: a + F.exp((low - v) / x["n"] * F.least(x["n"], F.lit(100))))
        limit = F.get(F.array(*[F.lit(float(v)) for v in self.limits]), length_class(x["n"])) if self.limits else F.lit(np.inf)
        return F.struct(
            F.when(empty, F.lit(UNKNOWN)).otherwise(F.get(langs, (F.array_position(x["nats"], low) - 1).cast("int"))).alias("lang_pred"),
            F.when(empty, F.lit(0.0)).otherwise(1 / odds).alias("score"),
            best.alias("cross_entropy"),
            (empty | (best > limit)).alias("rejected"),
            x["n"].alias("n"),
        )


CLASSES = 13


def length_class(n: Column) -> Column:
    return F.least(F.floor(F.log2(F.greatest(n, F.lit(1)))), F.lit(CLASSES - 1)).cast("int")


def gram_codes(grams: DataFrame) -> tuple[np.ndarray, pd.DataFrame]:
    """Code points of the strings of five characters in the column `gram`, a row each, and the other columns."""
    table = grams.toArrow()
    rows = table.drop_columns(["gram"]).to_pandas()
    # A chunk at a time: as Python strings they would take many times their size.
    raw = b"".join(b"".join(c.cast("binary").to_pylist()) for c in table["gram"].chunks)
    return np.frombuffer(raw.decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, ORDER), rows


def counted_quantile(values: np.ndarray, n: np.ndarray, q: float) -> float:
    """The quantile of ascending values that stand n times each, between two of them by proportion."""
    upto = np.cumsum(n)
    at = q * (upto[-1] - 1)
    low, high = (values[np.searchsorted(upto, place, "right")] for place in (np.floor(at), np.ceil(at)))
    return float(low + (high - low) * (at - np.floor(at)))


def fit(rows: DataFrame, *, part_grams: int = PART_GRAMS, languages: int = LANGUAGES) -> Identifier:
    """An identifier from all rows of lang and text."""
    spark = rows.sparkSession
    rows = rows.where("lang is not null and text is not null").select(F.col("lang").cast("string").alias("lang"), "text")
    in_fold = F.pmod(F.xxhash64("text", F.lit(8)), F.lit(CALIBRATION_FOLD)) == 0
    # A row for each language.
    held = rows.groupBy("lang").agg(F.count_if(in_fold).alias("fold"), F.count_if(~in_fold).alias("rest")).collect()
    lost = [r["lang"] for r in held if not r["rest"]]
    counts = staged(gram_counts(rows.where(~in_fold | F.col("lang").isin(lost))), "gram_counts")
    kinds = sorted((r["lang"], r["n"]) for r in counts.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect())
    if not kinds:
        return Identifier([], [])
    letters = counts.select(F.substring("gram", -1, 1)).distinct().count()
    groups: list[list[str]] = [[]]
    size = 0
    for lang, n in kinds:
        if groups[-1] and (size + n > part_grams or len(groups[-1]) >= languages):
            groups.append([])
            size = 0
        groups[-1].append(lang)
        size += n
    parts = []
    for group in groups:
        codes, own = gram_codes(counts.where(F.col("lang").isin(group)))
        number = own["lang"].map({lang: k for k, lang in enumerate(group)}).to_numpy(np.int64)
        parts.append(spark.sparkContext.broadcast(Model.fit(group, number, codes, own["n"].to_numpy(), letters)))
        del codes, own
    made = Identifier([lang for group in groups for lang in group], parts)
    told = made.told(rows.where(in_fold).select("text"), "text", "x").select("x.cross_entropy", length_class(F.col("x.n")).alias("class")).where("cross_entropy is not null")
    seen = told.groupBy("class", F.round(F.col("cross_entropy") * STEPS).cast("long").alias("step")).agg(F.count(F.lit(1)).alias("n")).toPandas()
    limits = np.full(CLASSES, np.inf)
    for k in range(CLASSES):
        own = seen[np.abs(seen["class"] - k) <= 1].groupby("step")["n"].sum().sort_index()
        if own.sum() >= 20:
            middle, far = (counted_quantile(own.index.to_numpy() / STEPS, own.to_numpy(), q) for q in (0.5, QUANTILE))
            limits[k] = middle + SPREAD * (far - middle)
    # A shorter text may be as odd as a longer one.
    limits = np.maximum.accumulate(np.where(np.isinf(limits), -np.inf, limits)[::-1])[::-1]
    made.limits = np.where(np.isinf(limits), np.inf, limits).tolist()
    return made


def identify(docs: DataFrame, training: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, lang_pred, score, cross_entropy, rejected for each row of `docs`, learnt from `training`."""
    made = fit(picked(training, text=text_col, lang=lang_col))
    return made.told(picked(docs, doc_id=id_col, text=text_col), "text", "told").select("doc_id", "told.lang_pred", "told.score", "told.cross_entropy", "told.rejected")


def keep_identified(docs: DataFrame, training: DataFrame, *, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of `docs` that are not rejected, with all their columns."""
    told = free("told", docs.columns)
    return fit(picked(training, text=text_col, lang=lang_col)).told(docs, text_col, told).where(~F.col(told)["rejected"]).drop(told)
