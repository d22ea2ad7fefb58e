"""Byte-level BPE by merge replay over all the words of a block of texts at once, and its decoding.

A text is cut by the tokenizer's pattern; its pieces ("words") are encoded each by itself, so a word
needs to be encoded once, however often and wherever it stands. A task takes its share of the corpus
block by block (an Arrow batch, some 8 MB of text): the words of the block that it doesn't know yet
replay the merges together. An inverted index leads from each token, that is from the pairs of tokens
that make it, to the places in all these words where such a pair stands; places are taken by rank,
leftmost first, and a merge touches its two neighbours only. Texts are their words' ids in order.
Nothing is shuffled, and a lost task is one share done again.

The words aren't brought together over the whole corpus: most different words of a block stand in few
others, and tables of blocks' words, shuffled to be told apart and back to their texts, took 3.4 times
the input's size of disk.

Decoding concatenates the tokens' bytes.

Edge cases: a null or empty text has no ids; texts and words of any length are worked on whole, a long
text in parts of `PART` words; repeated rows are encoded each; ids of any type stay in the JVM; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import free, picked, staged, tidied

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Words in each of the two halves of a worker's memory, and words of a long text that are looked at together.
REMEMBERED, PART = 200_000, 1_000_000


class Vocabulary:
    """Ranks and bytes of the tokens of a rank file; a token's id is its rank."""

    def __init__(self, name: str):
        import public_tokenizers
        import regex

        with open(public_tokenizers.path(name), "rb") as lines:
            pairs = (line.split() for line in lines)
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.cut = regex.compile(public_tokenizers.PATTERN)
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.single = [self.ranks[bytes([b])] for b in range(256)]
        self.rank_of: dict[tuple[int, int], int] = {}
        sizes = np.zeros(max(self.tokens) + 1, np.int64)
        for rank, token in self.tokens.items():
            sizes[rank] = len(token)
        self.sizes, self.starts = sizes, np.cumsum(sizes) - sizes
        self.flat = np.frombuffer(b"".join(self.tokens.get(r, b"") for r in range(len(sizes))), np.uint8)

    def pair(self, left: int, right: int) -> int:
        """The rank of what two tokens make, -1 if that is no token."""
        key = (left, right)
        known = self.rank_of.get(key)
        if known is None:
            known = self.rank_of[key] = self.ranks.get(self.tokens[left] + self.tokens[right], -1)
        return known

    def decode(self, ids: np.ndarray) -> bytes:
        return gathered(self.flat, self.starts[ids], self.sizes[ids]).tobytes()


_loaded: dict[str, Vocabulary] = {}


def vocabulary(name: str) -> Vocabulary:
    """One per worker."""
    if name not in _loaded:
        _loaded[name] = Vocabulary(name)
    return _loaded[name]


def gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of `flat` one behind the other."""
    ends = np.cumsum(sizes)
    return flat[np.repeat(starts - ends + sizes, sizes) + np.arange(int(ends[-1]) if len(ends) else 0)]


def replay(words: list[bytes], voc: Vocabulary) -> list[np.ndarray]:
    """The ids of each word, all merges being applied to all words in the order of their ranks."""
    raw = np.frombuffer(b"".join(words), np.uint8)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes)
    token = np.asarray(voc.single, np.int64)[raw]
    after = np.arange(1, len(raw) + 1)
    after[ends[sizes > 0] - 1] = -1
    before = np.arange(-1, len(raw) - 1)
    before[(ends - sizes)[sizes > 0]] = -1
    token, after, before = token.tolist(), after.tolist(), before.tolist()
    # The index: under the rank of what it makes, the place of a pair's first token.
    index: dict[int, list[int]] = {}
    for at, then in enumerate(after):
        if then >= 0 and (rank := voc.pair(token[at], token[then])) >= 0:
            index.setdefault(rank, []).append(at)
    order = list(index)
    heapq.heapify(order)
    while order:
        rank = heapq.heappop(order)
        places = sorted(index.pop(rank, ()))
        for k, at in enumerate(places):
            then = after[at]
            # A place may be gone, or hold another pair by now.
            if token[at] < 0 or then < 0 or voc.pair(token[at], token[then]) != rank:
                continue
            token[at], token[then] = rank, -1
            beyond, ahead, sooner = after[then], before[at], False
            after[at] = beyond
            touched = []
            if beyond >= 0:
                before[beyond] = at
                touched.append((at, voc.pair(rank, token[beyond])))
            if ahead >= 0:
                touched.append((ahead, voc.pair(token[ahead], rank)))
            for place, made in touched:
                if made >= 0:
                    if made not in index:
                        index[made] = []
                        heapq.heappush(order, made)
                    index[made].append(place)
                    sooner |= made < rank
            if sooner:
                # A merge of lower rank became possible: it comes first, and the rest of these after it.
                index[rank] = places[k + 1 :]
                heapq.heappush(order, rank)
                break
    done = np.asarray(token, np.int64)
    alive = done >= 0
    cuts = np.r_[0, np.cumsum(alive)][np.r_[0, ends]]
    ids = done[alive].astype("<u4")
    return [ids[a:b] for a, b in zip(cuts, cuts[1:])]


def encode_words(words: list[bytes], voc: Vocabulary) -> list[np.ndarray]:
    """As the library does it: a word that is a token is that token, whatever the merges."""
    whole = [voc.ranks.get(w) for w in words]
    left = replay([w for w, rank in zip(words, whole) if rank is None], voc)
    rest = iter(left)
    return [next(rest) if rank is None else np.array([rank], "<u4") for rank in whole]


class Encoder:
    """Ids of texts, by way of their words' ids, of which the latest are remembered."""

    def __init__(self, name: str):
        self.voc = vocabulary(name)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def learn(self, parts: list[list[str]]) -> None:
        """The ids of all words in lists of words; new ones replay the merges together."""
        if len(self.known) > REMEMBERED:
            # Words that are met again come over from the older half; those that aren't go with it.
            self.older, self.known = self.known, {}
        fresh = []
        for word in set().union(*parts) - self.known.keys():
            if word in self.older:
                self.known[word] = self.older[word]
            else:
                fresh.append(word)
        self.known.update(zip(fresh, (ids.tobytes() for ids in encode_words([w.encode() for w in fresh], self.voc))))

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """Little-endian 32-bit ids of each text of a block."""
        cut = self.voc.cut.findall
        words = [[] if not t or len(t) > PART else cut(t) for t in texts]
        self.learn(words)
        ids = self.known.__getitem__
        for text, own in zip(texts, words):
            if text and len(text) > PART:
                yield b"".join(self._parts(text))
            else:
                yield b"".join(map(ids, own))

    def _parts(self, text: str) -> Iterator[bytes]:
        found = (m.group() for m in self.voc.cut.finditer(text))
        while own := list(itertools.islice(found, PART)):
            short = [w for w in own if len(w) <= PART]
            self.learn([short])
            yield b"".join(self.known[w] if len(w) <= PART else encode_words([w.encode()], self.voc)[0].tobytes() for w in own)


_encoders: dict[str, Encoder] = {}


def encode(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", ranks: str = RANKS, digests: bool = False) -> DataFrame:
    """id, n_tokens, and ids (little-endian 32-bit numbers) and decoded (bytes) of every text, or only the sha256 of these two; a staged table."""
    rows = picked(docs, own_id=id_col, text=text_col)
    first, second = ("ids_sha256", "decoded_sha256") if digests else ("ids", "decoded")
    kind = "string" if digests else "binary"
    shown = (lambda raw: hashlib.sha256(raw).hexdigest()) if digests else (lambda raw: raw)

    def code(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = _encoders.setdefault(ranks, Encoder(ranks))
        for texts in tidied(batches):
            out = [(len(raw) >> 2, shown(raw), shown(own.voc.decode(np.frombuffer(raw, "<u4")))) for raw in own.encode(texts.tolist())]
            yield pd.DataFrame(out, columns=["n_tokens", first, second])

    made = F.pandas_udf(code, f"n_tokens long, {first} {kind}, {second} {kind}").asNondeterministic()("text")
    done = rows.select("own_id", made.alias("made")).select(F.col("own_id").alias(id_col), "made.*")
    return staged(done, "encoded_texts")


def decode(rows: DataFrame, *, ids_col: str = "ids", out_col: str = "decoded", ranks: str = RANKS) -> DataFrame:
    """With the bytes that the ids stand for; null ids give null."""
    out = free(out_col, rows.columns)

    def back(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        voc = vocabulary(ranks)
        for ids in batches:
            yield pd.Series([None if raw is None else voc.decode(np.frombuffer(raw, "<u4").astype(np.int64)) for raw in ids], dtype=object)

    return rows.withColumn(out, F.pandas_udf(back, "binary")(ids_col))
