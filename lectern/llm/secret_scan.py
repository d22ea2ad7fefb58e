"""Secrets in text, told from copied examples by how many repositories and owners hold them.

One scan of every whole text gives the spans of three base kinds (assign, access, hex) and of
`entropy`, long mixed-case tokens with digits and high character entropy. The value of each span is
hashed; the hashes are counted by distinct repositories and distinct owners over the whole corpus
(partial sums before the shuffle, so a value in a third of all rows is no hot key). A value that
several repositories or many owners share is a copied example; one that few hold looks live. Base
spans are always reported; an entropy span is added only where its value looks live and it overlaps
no base span.

Edge cases: a null or empty text has no spans; a null repository or owner counts as one of its own;
repeated rows are scanned alike and their ids count once as owners; an empty table gives no rows;
columns other than those named are ignored.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._store import picked, staged

KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
MIXED = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
MIN_ENTROPY = 3.5
#: From so many repositories or owners on, a value is a copied example.
EXAMPLE_REPOS = 3
EXAMPLE_OWNERS = 20
#: Values that are more than this part of all spans meet their spans by broadcast; there are at most so many.
HOT = 1000


def entropy(value: str) -> float:
    n = len(value)
    return -sum(k / n * math.log2(k / n) for k in Counter(value).values())


def live_looking(value: str) -> bool:
    return any(c.isdigit() for c in value) and value.lower() != value and value.upper() != value and entropy(value) >= MIN_ENTROPY


def spans_of(text: str) -> list[tuple[int, int, int, str]]:
    """(kind's number, start, end, value), ordered by start, then kind."""
    found: list[tuple[int, int, int, str]] = []
    low = text.lower()
    if "passw" in low or "secret" in low or "token" in low or "api" in low:
        found += [(0, m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(1, m.start(), m.end(), m[0]) for m in ACCESS.finditer(text)]
    found += [(2, m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    base = sorted((s, e) for _, s, e, _ in found)
    starts, furthest = [s for s, _ in base], list(itertools.accumulate((e for _, e in base), max))

    def free(m: re.Match) -> bool:
        """Of the base spans that begin before the match ends, none ends after it begins."""
        before = bisect.bisect_left(starts, m.end())
        return not before or furthest[before - 1] <= m.start()

    found += [(3, m.start(), m.end(), m[0]) for m in MIXED.finditer(text) if free(m) and live_looking(m[0])]
    return sorted(found, key=lambda x: (x[1], x[0]))


def joined(spans: list[tuple]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e, *_ in spans)


_SPAN = "struct<start: long, kind: int, end: long, value: binary>"


def scan(docs: DataFrame, *, id_col: str, text_col: str, repo_col: str, owner_col: str) -> DataFrame:
    """A row per document: counts and digest of the base spans, and all candidate spans with hashed values."""
    rows = picked(docs, doc_id=id_col, text=text_col, repo=repo_col, owner=owner_col)
    rows = rows.select("doc_id", F.coalesce(F.col("repo").cast("string"), F.lit("")).alias("repo"), F.coalesce(F.col("owner").cast("string"), F.lit("")).alias("owner"), "text")
    found = T.StructType([T.StructField(n, T.LongType()) for n in ("n_assign", "n_access", "n_hex")] + [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.ArrayType(T.StructType.fromDDL("start long, kind int, end long, value binary")))])

    def look(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            out = []
            for text in batch:
                spans = spans_of(text or "")
                kinds = Counter(k for k, *_ in spans)
                base = joined([x for x in spans if x[0] < 3])
                out.append((kinds[0], kinds[1], kinds[2], hashlib.sha256(base.encode()).hexdigest(), [{"start": s, "kind": k, "end": e, "value": hashlib.sha256(v.encode()).digest()[:16]} for k, s, e, v in spans]))
            yield pd.DataFrame(out, columns=[f.name for f in found.fields])

    seen = rows.withColumn("seen", F.pandas_udf(look, found)("text"))
    return seen.select("doc_id", "repo", "owner", "seen.*", F.monotonically_increasing_id().alias("row"))


def ownership(found: DataFrame) -> DataFrame:
    """value, n_repos, n_owners, n: how widely each hashed value is spread, and how often it stands anywhere."""
    each = found.select("repo", "owner", F.explode("spans").alias("span")).select("repo", "owner", F.col("span.value").alias("value"))
    return each.groupBy("value").agg(F.count_distinct("repo").alias("n_repos"), F.count_distinct("owner").alias("n_owners"), F.count(F.lit(1)).alias("n"))


def find_secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", repo_col: str = "source", owner_col: str = "doc_id", example_repos: int = EXAMPLE_REPOS, example_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example: a row per document."""
    found = staged(scan(docs, id_col=id_col, text_col=text_col, repo_col=repo_col, owner_col=owner_col), "secret_spans")
    spread = staged(ownership(found).select("value", "n", ((F.col("n_repos") >= example_repos) | (F.col("n_owners") >= example_owners)).alias("example")), "secret_values")
    each = found.select("row", F.explode("spans").alias("span")).select("row", "span", "span.value")
    # At most a thousand values can each be a thousandth of all spans; those are broadcast, so that none is a hot key.
    total = spread.agg(F.sum("n")).first()[0] or 0
    hot, cold = F.broadcast(spread.where(F.col("n") * HOT >= total).drop("n")), spread.where(F.col("n") * HOT < total).drop("n")
    told = each.join(hot, "value").union(each.join(hot, "value", "left_anti").join(cold, "value")).where("span.kind < 3 or not example")
    per_row = told.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("span.start", "span.kind", "span.end"))).alias("told"),
        F.count_if(~F.col("example")).alias("n_live"),
        F.count_if("example").alias("n_example"),
    )
    names = F.array(*[F.lit(k) for k in KINDS])
    line = F.array_join(F.transform("told", lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")
    both = found.drop("spans").join(per_row, "row", "left")
    return both.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", F.coalesce(line, F.lit("")).alias("spans"), F.coalesce("n_live", F.lit(0)).alias("n_live"), F.coalesce("n_example", F.lit(0)).alias("n_example"))
