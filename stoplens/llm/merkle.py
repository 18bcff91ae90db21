"""Merkle manifest of a dataset: a tree per group, a tree over their roots, a proof per row.

Only digests are shuffled, never texts. A level is a table of nodes (tree, idx); each
node equijoins the nodes at its siblings' computed indices, the nodes at slot zero emit
the parents. Proofs are handed down from the roots, a level's siblings joined to the path
of its parents, so a row meets each level once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import ordered
from .tables import staged

FANOUT = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

STEP = "struct<left: string, right: string>"


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts' texts, one after the other."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf_digest(fields: list[Column]) -> Column:
    """Digest of a row: each field ``-`` if null, else its byte count, ``:`` and its text."""

    def framed(field: Column) -> Column:
        text = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return digest(*map(framed, fields))


def sibling_indices(idx: Column, fanout: int) -> list[Column]:
    """Indices of the other places of a node's run: XOR for binary trees, slot offsets for others."""
    if fanout == 2:
        return [idx.bitwiseXOR(F.lit(1).cast("bigint"))]
    slot = idx % fanout
    return [idx - slot + (slot + k) % fanout for k in range(1, fanout)]


def _linked(nodes: DataFrame, fanout: int) -> DataFrame:
    """Nodes (tree, idx, n, node) with left and right, their siblings' digests in order."""
    out = nodes
    for k, at in enumerate(sibling_indices(F.col("idx"), fanout)):
        other = nodes.select(F.col("tree"), F.col("idx").alias(f"at{k}"), F.col("node").alias(f"node{k}"))
        out = out.withColumn(f"at{k}", at).join(other, ["tree", f"at{k}"], "left")
    found = F.sort_array(F.array(*[F.struct(F.col(f"at{k}").alias("at"), F.col(f"node{k}").alias("node")) for k in range(fanout - 1)]))

    def side(keep) -> Column:
        there = F.filter(found, lambda x: x["node"].isNotNull() & keep(x["at"]))
        return F.array_join(F.transform(there, lambda x: x["node"]), "")

    left, right = side(lambda at: at < F.col("idx")), side(lambda at: at > F.col("idx"))
    return out.select("tree", "idx", "n", "node", left.alias("left"), right.alias("right"))


def _grow(nodes: DataFrame, height: int, fanout: int) -> tuple[list[DataFrame], DataFrame]:
    """``height`` levels above ``nodes`` -> (the levels with siblings, the roots: tree, node).

    A tree that has come to one node waits for the others as it is.
    """
    levels = []
    for _ in range(height):
        levels.append(staged(_linked(nodes, fanout), "level"))
        first = levels[-1].where(F.col("idx") % fanout == 0)
        nodes = first.select(
            "tree",
            F.expr(f"idx div {fanout}").alias("idx"),
            F.expr(f"(n + {fanout - 1}) div {fanout}").alias("n"),
            F.when(F.col("n") > 1, digest(F.col("node"), F.col("right"))).otherwise(F.col("node")).alias("node"),
        )
    return levels, staged(nodes.select("tree", "node"), "roots")


def _hand_down(levels: list[DataFrame], paths: DataFrame, fanout: int) -> DataFrame:
    """Paths of the roots (tree, root, path) -> those of the lowest level's nodes (tree, idx, root, path)."""
    paths = paths.select("tree", F.lit(0).cast("bigint").alias("idx"), "root", "path")
    for level in reversed(levels):
        above = paths.select("tree", F.col("idx").alias("parent"), "root", "path")
        step = F.when(F.col("n") > 1, F.array(F.struct("left", "right"))).otherwise(F.array().cast(f"array<{STEP}>"))
        below = level.select("tree", "idx", F.expr(f"idx div {fanout}").alias("parent"), step.alias("step"))
        paths = below.join(above, ["tree", "parent"]).select("tree", "idx", "root", F.concat("step", "path").alias("path"))
    return paths


def _height(n: int, fanout: int) -> int:
    height = 0
    while n > 1:
        n, height = -(-n // fanout), height + 1
    return height


def fold(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` and the siblings of ``path`` give."""
    return F.aggregate(path, leaf, lambda node, step: digest(step["left"], node, step["right"]))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of ``path``, from the leaf upward, each level from left to right."""
    return digest(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""))


def merkle_manifest(
    rows: DataFrame,
    leaf: Column,
    group: str = "source",
    order: str = "doc_id",
    fanout: int = FANOUT,
    keep: dict[str, Column] | None = None,
) -> DataFrame:
    """A row per row: ``group``, ``order``, leaf, the columns ``keep``, subroot, root, path.

    Leaves of a group ascend by ``order`` (null first), then leaf, so repeated rows have
    leaves of their own side by side; groups ascend by value, null first, bytewise. While a
    tree has several nodes, every ``fanout`` consecutive ones become their digest. path
    holds (left, right), the concatenated digests of siblings, for each level from the leaf
    to the root. Other columns of ``rows`` have no part and may have any names; an empty
    table gives no rows. Very long texts are digested where they are read.
    """
    kept = {f"kept_{name}": column for name, column in (keep or {}).items()}
    chosen = rows.select(
        F.col(group).alias("group"), F.col(order).alias("key"), leaf.alias("node"), *[c.alias(n) for n, c in kept.items()]
    )
    leaves, groups = ordered(chosen, "group", ["key", "node"])
    most, trees = groups.agg(F.max("group_rows"), F.count("*")).first()
    named = leaves.withColumnsRenamed({"group_index": "tree", "group_rows": "n", "index": "idx"})
    leaves = staged(named, "leaves")
    levels, subroots = _grow(leaves.select("tree", "idx", "n", "node"), _height(most or 0, fanout), fanout)
    tops = subroots.select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("idx"), F.lit(trees).alias("n"), "node")
    high, top = _grow(tops, _height(trees, fanout), fanout)
    start = top.select("tree", F.col("node").alias("root"), F.array().cast(f"array<{STEP}>").alias("path"))
    above = _hand_down(high, start, fanout).select(F.col("idx").alias("tree"), F.struct("root", "path").alias("above"))
    above = subroots.join(above, "tree").select(
        "tree", F.struct("above.root", F.col("node").alias("subroot")).alias("root"), "above.path"
    )
    paths = _hand_down(levels, above, fanout)
    return leaves.join(paths, ["tree", "idx"]).select(
        F.col("group").alias(group),
        F.col("key").alias(order),
        F.col("node").alias("leaf"),
        *[F.col(n).alias(n.removeprefix("kept_")) for n in kept],
        "root.subroot",
        "root.root",
        "path",
    )
