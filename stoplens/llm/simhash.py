"""SimHash near-duplicates: fingerprints, pigeonhole blocks, verified distance.

Fingerprints are cut into blocks. Two that differ in at most ``bits`` places
agree on all but ``bits`` of the blocks, so they share the key of some choice
of the remaining blocks: they are joined on those keys and the distance is
verified. Copies of one fingerprint take part once.

A key that many fingerprints share is not joined with itself. Its members are
given the 65 values within one bit of them; two fingerprints are within two bits
exactly if they have such a value in common, so hanging all members of a value on
its smallest keeps every link, at a cost in proportion to the members.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .tables import staged

SEED = 42
SHINGLE = 3
BITS = 2
BLOCKS = 5
# Fingerprints under one key that are still compared pair by pair.
KEY_LIMIT = 32
# Hashes whose bits are counted at a time: bounds the memory a long text needs.
CHUNK = 1 << 15


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits as a signed integer: bit i is set if over half the shingles' hashes have it.

    A-Z are lowered; words are split at the six ASCII white-space characters. Fewer
    words than a shingle give one shingle of all words; no words, or null, give zero.
    """
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    width = min(shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)
    hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype=">u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), CHUNK):
        rows = hashes[at : at + CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(rows, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big", signed=True)


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    @F.pandas_udf("bigint")
    def fingerprints(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(x, shingle) for x in texts], dtype="int64")

    return fingerprints(text)


def block_masks(bits: int, blocks: int) -> list[int]:
    """One 64-bit mask (signed) for each choice of ``blocks - bits`` blocks."""
    cuts = [round(64 * k / blocks) for k in range(blocks + 1)]
    parts = [(1 << hi) - (1 << lo) for lo, hi in zip(cuts, cuts[1:], strict=False)]
    masks = [sum(chosen) for chosen in combinations(parts, blocks - bits)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _flips() -> list[int]:
    """Zero and the 64 single bits, signed."""
    return [0, *(1 << k for k in range(63)), -(1 << 63)]


def fingerprint_links(prints: DataFrame, bits: int = BITS, blocks: int = BLOCKS) -> DataFrame:
    """``prints`` (distinct ``fp``) -> links a, b that connect what is within ``bits`` bits.

    Every pair within reach is connected by links, each of at most ``bits`` bits.
    """
    if not 0 < bits <= 2:
        raise ValueError("keys shared by many fingerprints are resolved for 1 or 2 bits")
    masks = [F.struct(F.lit(k).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for k, m in enumerate(block_masks(bits, blocks))]
    keyed = prints.select("fp", F.explode(F.array(*masks)).alias("k")).select("fp", "k.choice", "k.key")
    sizes = staged(keyed.groupBy("choice", "key").agg(F.count("*").alias("n")).where("n > 1"), "block-sizes")
    shared = staged(keyed.join(sizes, ["choice", "key"]), "shared-blocks")

    few = shared.where(F.col("n") <= KEY_LIMIT)
    left = few.select("choice", "key", F.col("fp").alias("a"))
    right = few.select("choice", "key", F.col("fp").alias("b"))
    near = (F.col("a") < F.col("b")) & (_distance(F.col("a"), F.col("b")) <= bits)
    pairs = left.join(right, ["choice", "key"]).where(near).select("a", "b")

    radius = _flips() if bits == 2 else [0]
    many = shared.where(F.col("n") > KEY_LIMIT).select("fp").distinct()
    if bits == 1:  # one of the two has the other among its own neighbours
        radius = _flips()
    values = F.array(*[F.col("fp").bitwiseXOR(F.lit(x)) for x in radius])
    around = many.select("fp", F.explode(values).alias("value"))
    hubs = staged(around.groupBy("value").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1"), "hubs")
    spokes = around.join(hubs, "value").select("a", F.col("fp").alias("b"))
    spokes = spokes.where((F.col("a") != F.col("b")) & (_distance(F.col("a"), F.col("b")) <= bits))
    return pairs.unionAll(spokes).distinct()


def _grouped(docs: DataFrame, shingle: int, bits: int) -> DataFrame:
    """A row per row of ``docs``: doc_id, mark (a hash of the text), fp, root (of its component), component_id."""
    mark = F.xxhash64("text").alias("mark")
    marks = staged(docs.select("doc_id", mark, fingerprint_column(F.col("text"), shingle).alias("fp")), "fingerprints")
    prints = staged(marks.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    found = connected_components(fingerprint_links(prints.select("fp"), bits))
    rooted = staged(
        prints.join(found, prints["fp"] == found["node"], "left").select(
            "fp", "least", F.coalesce("component", "fp").alias("root")
        ),
        "rooted",
    )
    ids = staged(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "component-ids")
    classes = staged(rooted.join(ids, "root").select("fp", "root", "component_id"), "classes")
    return marks.join(classes, "fp").select("doc_id", "mark", "fp", "root", "component_id")


def simhash_groups(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """A row per row of ``docs`` (doc_id, text): doc_id, fp, component_id, in any order.

    component_id is the smallest doc_id reachable over links of at most ``bits`` bits,
    itself included. Null, empty and blank texts have fingerprint zero and link like
    any other. Rows with a null doc_id keep it and link the rest; a component of such
    rows alone has no id. Repeated rows give repeated rows.
    """
    return _grouped(docs, shingle, bits).select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """``docs`` with one row of each component: that with the smallest doc_id, by text hash among equals.

    Rows with a null doc_id come last. Of rows that repeat id and text, one stays.
    """
    groups = staged(_grouped(docs, shingle, bits).select("doc_id", "mark", "root"), "groups")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "mark")
    # Written, so that the join below reads both sides from shuffles and a large group's can be split.
    first = staged(groups.groupBy("root").agg(F.min(order).alias("first")), "firsts")
    rows = groups.groupBy("root", "doc_id", "mark").agg(F.count("*").alias("n"))
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("mark") == F.col("first.mark"))
    judged = staged(rows.join(first, "root").select("doc_id", "mark", "n", same.alias("stays")), "judged")

    gone = staged(judged.where("NOT stays").select("doc_id", "mark"), "gone")
    often = staged(judged.where("stays AND n > 1").select("doc_id", "mark"), "often")
    names, mark = docs.columns, "mark"
    while mark in names:
        mark = f"_{mark}"
    marked = docs.withColumn(mark, F.xxhash64("text"))

    def match(side: DataFrame) -> Column:
        return marked["doc_id"].eqNullSafe(side["doc_id"]) & (marked[mark] == side["mark"])

    kept = marked.join(gone, match(gone), "left_anti")
    once = kept.join(often, match(often), "left_anti")
    repeats = kept.join(often, match(often), "left_semi").dropDuplicates(["doc_id", mark])
    return once.unionAll(repeats).select(*names)


def fingerprint_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
