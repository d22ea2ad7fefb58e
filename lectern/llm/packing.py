"""Best-fit packing of tokenised documents by a configuration linear program.

A *configuration* is a multiset of piece lengths whose sum is at most the sequence length. The
covering program "use configurations so that every length is covered as often as it occurs, with as
few as possible" is solved over the whole length histogram by multiplicative weights. Lengths stand
in `CLASSES` classes of about equally many tokens, a class counting as the mean of its pieces. Each
round prices the classes, an unbounded-knapsack dynamic program finds the best configuration under
the prices, and the prices of what it covers decay. Any prices bound the program from below (what
all pieces are worth, over what the best configuration is worth); the rounds end when the cover is
within `GAP` of the best such bound, or after `ROUNDS`.

Multiplicities are rounded in running sums, and configurations are filled with real lengths, those
with the longest pieces first; the room that a class leaves beside its real lengths is filled by best
fit. Pieces of at most limit / `FILL` tokens, priced like all, are placed last: they and what is left
go by best fit, longest first, into open room, and into new sequences where none fits.
All of this handles at most `limit` numbers, however many documents there are; the documents only
meet it in two places: the histogram (one small aggregate) and a lookup that turns (length, rank
among that length) into a sequence and an offset.

Edge cases: a null or empty text is the single end id; a text of any length is encoded whole and cut
into pieces of `limit`; equal rows are separate documents, and which of two pieces of one length goes
where is arbitrary; an empty table gives no rows; ids may be null and repeat, and are of any type, as
they never leave the JVM; columns other than the two named are ignored.
"""

from __future__ import annotations

import bisect
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import dense_rank_in, picked, staged, tidied

LIMIT = 4096
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
#: Rounds of the linear program at most, and the distance from its lower bound that ends it.
ROUNDS, GAP = 2000, 0.02
#: Classes of neighbouring lengths that the linear program tells apart.
CLASSES = 48
#: Pieces of at most limit / FILL tokens get their places last, in the room that the program has planned for them.
FILL = 8
#: Steps into which the knapsack divides a sequence.
STEPS = 512
#: Words in each of the two halves of a Python worker's memory.
REMEMBERED = 400_000


class WordCoder:
    """Ids of a text as little-endian 32-bit bytes, by way of its white-space separated chunks.

    The tokenizer's normaliser and splitter never look across a space or line feed, so a text's ids
    are those of its chunks in order. Chunks are encoded once, in one call for all that are new.
    """

    def __init__(self, name: str):
        import public_tokenizers
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        # For runs of lower-case letters, which neither normaliser nor splitter changes.
        self.plain = Tokenizer.from_file(public_tokenizers.path(name))
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.stops = {c: self._single(c) for c in ".,"}

    def _single(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _together(self, tokenizer, chunks: list[str]) -> None:
        """Learn chunks in one call."""
        for at in range(0, len(chunks), 20_000):
            part = chunks[at : at + 20_000]
            got = tokenizer.encode(part, is_pretokenized=True, add_special_tokens=False)
            words = got.word_ids
            if None in words or len(words) and (np.diff(words) < 0).any():
                self.known.update((c, self._single(c)) for c in part)
                continue
            ids = np.asarray(got.ids, "<u4").tobytes()
            ends = (np.searchsorted(np.asarray(words, np.int64), np.arange(len(part)), "right") * 4).tolist()
            self.known.update(zip(part, map(ids.__getitem__, map(slice, [0, *ends[:-1]], ends))))

    def learn(self, letters: list[str], others: list[str]) -> None:
        """Ids of different runs of lower-case letters, and of different other chunks."""
        if len(self.known) > REMEMBERED:
            # Words that are met again come over from the older half; those that aren't go with it.
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        for tokenizer, own in ((self.plain, letters), (self.tokenizer, others)):
            new = []
            for c in [c for c in own if c not in known]:
                if c in older:
                    known[c] = older[c]
                else:
                    new.append(c)
            self._together(tokenizer, new)

    def encode(self, texts: pa.Array) -> list[bytes]:
        # Arrow splits and numbers the chunks; only different ones become Python's.
        split = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        coded = split.flatten().dictionary_encode()
        chunks, which = coded.dictionary, coded.indices.to_numpy()
        # A letter run with one full stop or comma after it splits before the stop.
        stop = np.select([pc.ends_with(chunks, c).to_numpy(zero_copy_only=False) for c in self.stops], range(1, len(self.stops) + 1), 0)
        body = pc.if_else(pa.array(stop > 0), pc.utf8_slice_codeunits(chunks, 0, -1), chunks)
        simple = pc.match_substring_regex(body, "^[A-Za-zÀ-ÖØ-öø-ÿ]+$").to_numpy(zero_copy_only=False)
        lowered = pc.utf8_lower(body.filter(pa.array(simple))).dictionary_encode()
        letters, others = lowered.dictionary.to_pylist(), chunks.filter(pa.array(~simple)).to_pylist()
        self.learn(letters, others)
        # Units: the letter runs, the other chunks, nothing, and the stops; a chunk is two of them.
        units = [*map(self.known.__getitem__, letters), *map(self.known.__getitem__, others), b"", *self.stops.values()]
        nothing = len(letters) + len(others)
        first = np.empty(len(chunks), np.int64)
        first[simple] = lowered.indices.to_numpy()
        first[~simple] = len(letters) + np.arange(len(others))
        both = np.stack([first, nothing + np.where(simple, stop, 0)], 1)[which].ravel()
        flat = np.frombuffer(b"".join(units), "<u4")
        sizes = np.fromiter(map(len, units), np.int64, len(units)) >> 2
        n = sizes[both]
        ends = np.cumsum(n)
        at = np.repeat((np.cumsum(sizes) - sizes)[both] - ends + n, n)
        at += np.arange(len(at))
        raw = flat[at].tobytes()
        offsets = np.asarray(split.offsets)
        cuts = (np.r_[0, ends][(offsets - offsets[0]) * 2] * 4).tolist()
        return [raw[a:b] for a, b in zip(cuts, cuts[1:])]


_coders: dict[str, WordCoder] = {}


def coder(name: str) -> WordCoder:
    if name not in _coders:
        _coders[name] = WordCoder(name)
    return _coders[name]


def token_pieces(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER, limit: int = LIMIT, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: each document's ids cut into pieces of at most `limit`."""
    rows = picked(docs, doc_id=id_col, text=text_col)
    end = struct.pack("<I", end_id)

    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = coder(tokenizer).encode
        for texts in tidied(batches):
            starts, length, crc = [0], [], []
            for lo in range(0, len(texts), 1000):
                for ids in encode(texts[lo : lo + 1000]):
                    ids += end
                    own = [ids[at : at + 4 * limit] for at in range(0, len(ids), 4 * limit)]
                    length += [len(p) // 4 for p in own]
                    crc += map(zlib.crc32, own)
                    starts.append(len(length))
            yield pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.StructArray.from_arrays([pa.array(length, pa.int64()), pa.array(crc, pa.int64())], ["length", "ids_crc32"]))

    pieces = F.arrow_udf(cut, "array<struct<length: long, ids_crc32: long>>")("text")
    each = rows.select("doc_id", F.posexplode(pieces).alias("piece", "p"))
    return each.select("doc_id", "piece", (F.col("piece").cast("long") * limit).alias("start"), "p.length", "p.ids_crc32")


def best_configuration(prices: np.ndarray, lengths: np.ndarray, limit: int) -> dict[int, int]:
    """Unbounded knapsack by dynamic programming: the multiset of lengths of the greatest total price."""
    order = np.argsort(lengths)
    lengths, prices = lengths[order], prices[order]
    worth = np.zeros(limit + 1)
    choice = np.full(limit + 1, -1)
    fits = np.searchsorted(lengths, np.arange(limit + 1), "right").tolist()
    for room in range(int(lengths[0]), limit + 1):
        k = fits[room]
        total = worth[room - lengths[:k]] + prices[:k]
        at = total.argmax()
        worth[room], choice[room] = max((total[at], at), (worth[room - 1], -1))
    found: dict[int, int] = {}
    room = limit
    while room > 0:
        if choice[room] < 0:
            room -= 1
            continue
        l = int(lengths[choice[room]])
        found[l] = found.get(l, 0) + 1
        room -= l
    return found


def classes_of(lengths: np.ndarray, counts: np.ndarray, most: int = CLASSES) -> np.ndarray:
    """Class number of each length: runs of neighbouring lengths that hold about equally many tokens.

    A class counts as the mean of its pieces, so that a configuration of classes may lack room for its
    longer ones, or have some left beside its shorter ones: what is put into it is measured piece by piece.
    """
    mass = np.cumsum(lengths * counts)
    cut = np.minimum((mass - 1) * most // mass[-1], most - 1)
    return np.unique(cut, return_inverse=True)[1]


def fractional_cover(sizes: np.ndarray, demand: np.ndarray, limit: int, rounds: int = ROUNDS, gap: float = GAP) -> tuple[list[tuple[dict[int, int], float]], float]:
    """Configurations with fractional multiplicities that cover all sizes on the whole, and a lower bound on any cover.

    Multiplicative weights for the covering program: a size's price falls with the share of its
    demand that is covered so far, and the best configuration under the prices is taken up.
    """
    place = {int(l): i for i, l in enumerate(sizes)}
    demand = demand.astype(float)
    covered = np.zeros(len(sizes))
    columns: dict[tuple, float] = {}
    # Prices in proportion to size bound the program by the tokens.
    used, bound = 0.0, float(sizes @ demand) / limit
    for k in range(rounds):
        share = covered / demand
        # The more is covered, the smaller is a step beside it, and the sharper may prices tell shares apart.
        prices = np.exp(-4.0 * np.log(len(sizes) + 1) / max(share.mean(), 1e-9) ** 0.5 * (share - share.min())) / demand if k else 1.0 / demand
        config = best_configuration(prices, sizes, limit)
        at = np.array([place[l] for l in config])
        many = np.array(list(config.values()), float)
        bound = max(bound, float(prices @ demand) / float(prices[at] @ many))
        times = float((demand[at] / many).min()) / 4
        key = tuple(sorted(config.items(), reverse=True))
        columns[key] = columns.get(key, 0.0) + times
        used += times
        covered[at] += many * times
        least = float((covered / demand).min())
        if least > 0 and used / least <= (1 + gap) * bound:
            break
    # As many sequences as hold all tokens; what a size lacks of its demand is left for best fit.
    scale = float(sizes @ demand) / float(sizes @ covered)
    return [(dict(c), x * scale) for c, x in columns.items()], bound


def plan(histogram: dict[int, int], limit: int = LIMIT, rounds: int = ROUNDS) -> list[tuple[dict[int, int], int]]:
    """(configuration, times) that together hold exactly the histogram."""
    left = {l: n for l, n in histogram.items() if n > 0}
    open_: list[tuple[dict[int, int], int, int]] = []
    if left.get(limit):
        open_.append(({limit: 1}, left.pop(limit), 0))
    if left:
        lengths = np.array(sorted(left))
        group = classes_of(lengths, np.array([left[int(l)] for l in lengths]))
        counts = np.array([left[int(l)] for l in lengths])
        mean = np.bincount(group, lengths * counts) / np.bincount(group, counts)
        # The knapsack runs over steps; a class counts as so many steps as its pieces take on average.
        step = max(1, limit // STEPS)
        sizes, class_of = np.unique(np.maximum(1, np.rint(mean / step).astype(int)), return_inverse=True)
        members = {int(s): [int(l) for l in lengths[np.isin(group, np.flatnonzero(class_of == k))]] for k, s in enumerate(sizes)}
        demand = np.array([sum(left[l] for l in members[int(s)]) for s in sizes])
        columns, _ = fractional_cover(sizes, demand, limit // step, rounds)
        order, due = lengths[lengths * FILL > limit], 0.0
        for config, x in sorted(columns, key=lambda c: sorted(c[0], reverse=True), reverse=True):
            due += x
            while due >= 1 and left:
                # Real lengths for the classes, the greatest that are left and fit; then the room that these leave.
                real: dict[int, int] = {}
                room = limit
                for size, k in sorted(config.items(), reverse=True):
                    own = members[size]
                    if own and own[0] * FILL <= limit:
                        continue
                    while own and own[-1] not in left:
                        own.pop()
                    at = len(own) - 1
                    while k > 0 and at >= 0:
                        if take := min(k, left.get(own[at], 0), room // own[at]):
                            real[own[at]] = take
                            k -= take
                            room -= take * own[at]
                        at -= 1
                if not real:
                    due -= int(due)
                    break
                real = filled(real, left, order, limit)
                n = min([int(due), *(left[l] // k for l, k in real.items())])
                due -= n
                open_.append((real, n, limit - sum(l * k for l, k in real.items())))
                for l, k in real.items():
                    left[l] -= k * n
                    if not left[l]:
                        del left[l]
                if len(order) > 2 * len(left) + 8:
                    order = np.array([l for l in sorted(left) if l * FILL > limit])
    return best_fit(open_, left, limit)


def filled(real: dict[int, int], left: dict[int, int], order: np.ndarray, limit: int) -> dict[int, int]:
    """`real`, with the room that it has filled by best fit from what is left of the lengths in `order`, sorted."""
    config = dict(real)
    room = limit - sum(l * k for l, k in config.items())
    at = int(np.searchsorted(order, room, "right")) - 1
    while at >= 0:
        l = int(order[at])
        if have := min(left.get(l, 0) - config.get(l, 0), room // l):
            config[l] = config.get(l, 0) + have
            room -= l * have
            at = min(at, int(np.searchsorted(order, room, "right")))
        at -= 1
    return config


def best_fit(open_: list[tuple[dict[int, int], int, int]], left: dict[int, int], limit: int) -> list[tuple[dict[int, int], int]]:
    """The open sequences (configuration, times, room) with all that is left put in, longest first, where the least room is."""
    rooms: dict[int, list[tuple[dict[int, int], int]]] = {}
    for config, times, room in open_:
        rooms.setdefault(room, []).append((config, times))
    order = sorted(rooms)
    done: list[tuple[dict[int, int], int]] = []

    def put(config: dict[int, int], times: int, room: int) -> None:
        if room not in rooms:
            rooms[room] = []
            bisect.insort(order, room)
        rooms[room].append((config, times))

    for l in sorted(left, reverse=True):
        n = left[l]
        while n:
            at = bisect.bisect_left(order, l)
            if at == len(order):
                put({}, -(-n // (limit // l)), limit)
                continue
            room = order[at]
            config, times = rooms[room].pop()
            if not rooms[room]:
                del rooms[room], order[at]
            k = min(n, room // l)
            m = min(times, n // k)
            if times > m:
                put(config, times - m, room)
            put({**config, l: config.get(l, 0) + k}, m, room - l * k)
            n -= k * m
    for held in rooms.values():
        done += held
    return done


def places(configs: list[tuple[dict[int, int], int]]) -> pd.DataFrame:
    """Lookup rows: pieces of `length` with ranks from `lo` go `per` a sequence, from sequence `base`, at `offset`."""
    used: dict[int, int] = {}
    base, rows = 0, []
    for config, times in configs:
        offset = 0
        for l, k in sorted(config.items(), reverse=True):
            rows.append((l, used.get(l, 0), k, base, offset))
            used[l] = used.get(l, 0) + k * times
            offset += l * k
        base += times
    return pd.DataFrame(rows, columns=["length", "lo", "per", "base", "offset"]).sort_values(["length", "lo"], ignore_index=True)


def pack(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER, limit: int = LIMIT, end_id: int = END_ID, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece of every document."""
    pieces = token_pieces(docs, id_col=id_col, text_col=text_col, tokenizer=tokenizer, limit=limit, end_id=end_id)
    pieces = staged(pieces.withColumn("mid", F.monotonically_increasing_id()), "pieces")
    # At most `limit` rows, whatever the number of documents.
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = places(plan(histogram, limit, rounds))
    shift = 44
    spark = docs.sparkSession
    # Bounded: a row for each length of each configuration, and those number a few times `limit`.
    shared = spark.sparkContext.broadcast(((table["length"].to_numpy(np.int64) << shift) + table["lo"].to_numpy(np.int64), *(table[c].to_numpy(np.int64) for c in ("lo", "per", "base", "offset"))))
    ranked = dense_rank_in(pieces, "length", max(histogram.values(), default=0))

    def place(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        keys, lo, per, base, offset = shared.value
        for lengths, ranks in batches:
            length, rank = lengths.to_numpy(np.int64), ranks.to_numpy(np.int64)
            at = np.searchsorted(keys, (length << shift) + rank, "right") - 1
            nth = rank - lo[at]
            yield pd.DataFrame({"sequence_id": base[at] + nth // per[at], "offset": offset[at] + nth % per[at] * length})

    at = F.pandas_udf(place, "sequence_id long, offset long")("length", "rank")
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", at.alias("at")).select("doc_id", "piece", "start", "length", "ids_crc32", "at.sequence_id", "at.offset")
