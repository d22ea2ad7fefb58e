"""Merkle manifest of a dataset: one hash that vouches for every row, and a short proof for each.

A row's leaf is the hash of its fields. The leaves of a group (a language) stand in one order; every
`fanout` consecutive nodes of a level become one node of the next, until one is left, the group's
subroot. The subroots, in the order of the groups, form a tree of their own, whose top is the root.

Indices are bucketed by fanout^levels: a superblock of that many neighbouring nodes collapses `levels`
levels in one task, and its root is one node for the next round, so that a table of n rows takes
log(n) / log(fanout^levels) rounds, and no task ever holds more than one superblock. Proofs come back
down the same way: what a superblock's root has above it goes behind what each of its nodes has within.

Edge cases: null fields are hashed as `-`, so a null text differs from an empty one; a null group is
the first of all; rows of a null id stand before all others; rows that share an id are ordered by
their leaves, and equal rows get neighbouring places; a text of any length is hashed in the JVM; an
empty table has no rows and no root; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.operators.planner import with_row_number

from ._store import picked, staged

FANOUT = 2
#: Levels that one superblock collapses: 2^10 nodes of 32 bytes.
LEVELS = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def canonical(value: Column) -> Column:
    """`-` for null, else the UTF-8 byte count, a colon and the value."""
    plain = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(plain).cast("string"), F.lit(":"), plain), F.lit("-"))


def leaf_of(*fields: Column) -> Column:
    """The digest (binary) of a row's fields."""
    return F.unhex(F.sha2(F.concat(*[canonical(f) for f in fields]).cast("binary"), 256))


def joined(nodes: list[bytes]) -> bytes:
    """The node above: the hash of the nodes' hex digests, one behind the other."""
    return hashlib.sha256(b"".join(nodes).hex().encode()).digest()


def height(n: int, fanout: int) -> int:
    """Levels above n nodes until one is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // fanout), levels + 1
    return levels


def collapse(nodes: list[bytes], total: int, fanout: int, levels: int) -> list[list[bytes]]:
    """The levels of one superblock, from its nodes to its root; total: nodes of the whole level."""
    rows = [nodes]
    for _ in range(min(levels, height(total, fanout))):
        last = rows[-1]
        rows.append([joined(last[i : i + fanout]) for i in range(0, len(last), fanout)])
    return rows


def siblings(rows: list[list[bytes]], i: int, fanout: int) -> list[bytes]:
    """The others of the runs that lead from node i of a superblock to its root, level by level."""
    found: list[bytes] = []
    for level in rows[:-1]:
        at = i - i % fanout
        found += level[at:i] + level[i + 1 : at + fanout]
        i //= fanout
    return found


def folded(node: bytes, proof: list[bytes], path: list[tuple[int, int]], fanout: int) -> bytes:
    """The root that a node and its proof lead to. path: (index, nodes of its level) at the foot of each tree on the way."""
    used = 0
    for i, n in path:
        while n > 1:
            at = i - i % fanout
            others = min(fanout, n - at) - 1
            run = proof[used : used + others]
            run.insert(i - at, node)
            node, used = joined(run), used + others
            i, n = i // fanout, -(-n // fanout)
    return node


_NODES = "tree long, i long, n long, node binary"
_PROVED = "tree long, block long, proof binary, top binary"


def _reduced(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """The roots of the superblocks of a level, as the nodes of a level of their own."""
    width = fanout**levels

    def reduce(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("i")
        n = int(block["n"].iloc[0])
        root = collapse(block["node"].tolist(), n, fanout, levels)[-1][0]
        return pd.DataFrame({"tree": block["tree"].iloc[:1], "i": block["i"].iloc[:1] // width, "n": -(-n // width), "node": [root]})

    return nodes.groupBy("tree", F.floor(F.col("i") / width).alias("block")).applyInPandas(reduce, _NODES)


def _proved(nodes: DataFrame, above: DataFrame, fanout: int, levels: int) -> DataFrame:
    """For each node what stands beside it on its way to the top: its superblock's part, then that of the superblock's root."""

    def descend(block: pd.DataFrame, roots: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("i")
        rows = collapse(block["node"].tolist(), int(block["n"].iloc[0]), fanout, levels)
        rest = roots["proof"].iloc[0]
        proofs = [b"".join(siblings(rows, i, fanout)) + rest for i in range(len(block))]
        return pd.DataFrame({"tree": block["tree"], "block": block["i"], "proof": proofs, "top": roots["top"].iloc[0]})

    own = nodes.groupBy("tree", F.floor(F.col("i") / fanout**levels).alias("block"))
    return own.cogroup(above.groupBy("tree", "block")).applyInPandas(descend, _PROVED)


def trees(nodes: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """tree, block, proof, top for each superblock of `nodes` (tree, i, n, node), a staged table: what its root has above it, and the tree's top."""
    width, rounds = fanout**levels, []
    most = nodes.agg(F.max("n")).first()[0] or 0
    while True:
        nodes, most = staged(_reduced(nodes, fanout, levels), "superblocks"), -(-most // width)
        if most <= 1:
            break
        rounds.append(nodes)
    proved = nodes.select("tree", F.col("i").alias("block"), F.lit(b"").alias("proof"), F.col("node").alias("top"))
    for level in reversed(rounds):
        proved = _proved(level, proved, fanout, levels)
    return staged(proved, "upper_proofs")


def manifest(docs: DataFrame, *, id_col: str = "doc_id", by: str = "lang", fields: tuple[str, ...] = FIELDS, tampered: Column | None = None, bumped: str = "n_chars", fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """id, leaf, subroot, root, proof, folded_root, verified of every row; digests in hex, a proof as one string of them.

    folded_root is what the row as it now is leads to with its proof; verified, whether that is the root.
    `tampered` tells the rows to be changed after the manifest was made: `bumped` grows by one in them.
    """
    rows = picked(docs, **{f"f{k}": c for k, c in enumerate(fields)}, own_id=id_col, own_group=by)
    own = [F.col(f"f{k}") for k in range(len(fields))]
    changed = F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False))
    now = [c + changed.cast("long") if name == bumped else c for c, name in zip(own, fields)]
    leaves = rows.select("own_id", "own_group", leaf_of(*own).alias("leaf"), F.when(changed, leaf_of(*now)).alias("now"))
    leaves = staged(leaves, "leaves")
    groups = staged(with_row_number(leaves.groupBy("own_group").agg(F.count(F.lit(1)).alias("n")), ("own_group",)), "groups")
    n_groups = groups.count()
    # Neighbours by index meet the few rows of their groups; a group of any size is spread by its index.
    placed = with_row_number(leaves, ("own_id", "leaf"), by=("own_group",))
    dim = groups.select(F.col("own_group").alias("g"), F.col("row_number").alias("tree"), "n")
    placed = placed.join(dim, placed["own_group"].eqNullSafe(dim["g"])).select("own_id", "tree", F.col("row_number").alias("i"), "n", F.col("leaf").alias("node"), "now")
    nodes = staged(placed, "placed_leaves")
    lower = trees(nodes.select("tree", "i", "n", "node"), fanout, levels)
    # The tops of the groups are the leaves of one more tree.
    tops = staged(lower.groupBy("tree").agg(F.first("top").alias("node")), "subroots")
    crown = tops.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("i"), F.lit(n_groups).cast("long").alias("n"), "node")
    upper = _proved(crown, trees(crown, fanout, levels), fanout, levels).select(F.col("block").alias("g"), F.col("proof").alias("crown"), F.col("top").alias("root"))
    above = lower.join(upper, F.col("tree") == F.col("g")).select("tree", "block", "proof", F.col("top").alias("subroot"), "crown", "root")

    def prove(block: pd.DataFrame, roots: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("i")
        n, tree = int(block["n"].iloc[0]), int(block["tree"].iloc[0])
        levels_ = collapse(block["node"].tolist(), n, fanout, levels)
        head = roots.iloc[0]
        rest = _digests(head["proof"]) + _digests(head["crown"])
        out = []
        for k, (i, node, now) in enumerate(zip(block["i"].tolist(), block["node"].tolist(), block["now"].tolist())):
            proof = siblings(levels_, k, fanout) + rest
            root = folded(now or node, proof, [(i, n), (tree, n_groups)], fanout)
            out.append((node.hex(), b"".join(proof).hex(), root.hex()))
        made = pd.DataFrame(out, columns=["leaf", "proof", "folded_root"])
        return made.assign(own_id=block["own_id"].tolist(), subroot=head["subroot"].hex(), root=head["root"].hex())[["own_id", "leaf", "subroot", "root", "proof", "folded_root"]]

    blocks = nodes.withColumn("own_id", F.col("own_id").cast("string")).groupBy("tree", F.floor(F.col("i") / fanout**levels).alias("block"))
    done = blocks.cogroup(above.groupBy("tree", "block")).applyInPandas(prove, "own_id string, leaf string, subroot string, root string, proof string, folded_root string")
    return done.select(F.col("own_id").cast(docs.schema[id_col].dataType).alias(id_col), "leaf", "subroot", "root", "proof", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _digests(raw: bytes) -> list[bytes]:
    return [raw[k : k + 32] for k in range(0, len(raw), 32)]
