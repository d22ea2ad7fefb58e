"""Components of near duplicates against those of all pairs at 0.85: python tests/llm/measure_near_dedup.py FOLDER.

All pairs without a sketch: a document's rarest shingles, n - ceil(0.85 n) + 1 of its n, must meet
those of any document it is linked with. Pairs that already hang together aren't compared.
"""

import math
import sys
from collections import defaultdict
from pathlib import Path

import numpy as np

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
NUM, DEN = 85, 100


def shingles(texts):
    """Sorted 64-bit numbers of each text's distinct five-word shingles; words have numbers of their own."""
    ids, out = {}, []
    mix = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
    for text in texts:
        words = (text or "").encode().lower().split()
        w = np.fromiter((ids.setdefault(x, len(ids) + 1) for x in words), np.uint64, len(words))
        w = (w * np.uint64(0xFF51AFD7ED558CCD)) ^ ((w * np.uint64(0xFF51AFD7ED558CCD)) >> np.uint64(29))
        if len(w) == 0:
            out.append(w)
            continue
        k = min(5, len(w))
        h = np.zeros(len(w) - k + 1, np.uint64)
        for j in range(k):
            h = (h ^ (w[j : j + len(h)] * mix[j])) * np.uint64(0x2545F4914F6CDD1D) + np.uint64(k)
            h ^= h >> np.uint64(31)
        out.append(np.unique(h))
    return out


def components(doc_ids, sets):
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def join(i, j):
        a, b = sorted((root(i), root(j)), key=lambda r: doc_ids[r])
        parent[b] = a

    first, links, reps = {}, 0, []
    for i, s in enumerate(sets):
        if len(s):
            same = first.setdefault(s.tobytes(), i)
            join(i, same) if same != i else reps.append(i)
    every, counts = np.unique(np.concatenate([sets[i] for i in reps]), return_counts=True)
    postings = defaultdict(list)
    for i in reps:
        s = sets[i]
        rare = s[np.lexsort((s, counts[np.searchsorted(every, s)]))]
        for t in rare[: len(s) - math.ceil(NUM * len(s) / DEN) + 1].tolist():
            postings[t].append(i)
    compared = set()
    for members in postings.values():
        for k, i in enumerate(members):
            for j in members[:k]:
                a, b = len(sets[i]), len(sets[j])
                if DEN * min(a, b) < NUM * max(a, b) or root(i) == root(j) or (j, i) in compared:
                    continue
                compared.add((j, i))
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if DEN * both >= NUM * (a + b - both):
                    join(i, j)
                    links += 1
    return [doc_ids[root(i)] for i in range(len(sets))], links, len(reps)


def main(folder):
    from pyspark.sql import SparkSession

    from lectern.llm.queries import QUERIES

    spark = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "12g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").toPandas()
    got = QUERIES["op9_setsketch_near_dedup"](spark, folder).toPandas().set_index("doc_id")
    sets = shingles(docs["text"])
    ids = docs["doc_id"].tolist()
    want, links, kinds = components(ids, sets)
    own = got.loc[ids, "component_id"].tolist()
    print("documents", len(ids), "different sets", kinds, "joining links", links, "linked documents", sum(w != i for w, i in zip(want, ids)))
    print("documents in another component", sum(a != b for a, b in zip(own, want)), "set sizes that differ", sum(len(s) != n for s, n in zip(sets, got.loc[ids, "n_shingles"])))


if __name__ == "__main__":
    main(sys.argv[1])
