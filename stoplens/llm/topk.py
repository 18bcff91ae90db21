"""Exact top-k by inner product: the threshold algorithm over sorted lists.

Each dimension of a block of vectors is a list sorted by value. A query walks its
lists from their better ends at one pace, scores every vector it meets, and adds up
the values it stands at: no vector it has not met can score more than this bound, so
it stops once the bound is below its k-th best. Queries and candidates are cut into
blocks of bounded size; each pair of blocks is one call.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import staged

K = 5
SCALE = 256
CANDIDATES = 8192
QUERIES = 2048
# Blocks of candidates at least, so that small tables use all cores.
MIN_BLOCKS = 12
FIRST_DEPTH = 4


def _finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))


def integer_vectors(table: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, floor(scale * x) of each component and a number for the row; unusable rows are left out."""
    usable = table.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
    usable = usable.where(F.forall("embedding", _finite))
    ints = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    return usable.select("vec_id", ints.alias("v"), F.monotonically_increasing_id().alias("row"))


class SortedLists:
    """A block of vectors (rows of ``values``) with each dimension sorted; ``own`` tells rows that share an id apart."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, own: np.ndarray | None = None) -> None:
        self.ids, self.values, self.own = ids, values, ids if own is None else own
        self.order = np.argsort(values, axis=0, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(values, self.order, axis=0)

    def search(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best vectors but the row ``own``, ties to smaller ids."""
        n, used = len(self.ids), np.flatnonzero(query)
        up, down = used[query[used] > 0], used[query[used] < 0]
        met, found, scores = np.zeros(n, dtype=bool), np.empty(0, dtype=np.int64), np.empty(0, dtype=query.dtype)
        lo, hi = 0, FIRST_DEPTH if len(used) else n
        while True:
            hi, now = min(hi, n), np.zeros(n, dtype=bool)
            if hi == n:
                now[:] = True
            else:
                now[self.order[n - hi : n - lo, up].ravel()] = True
                now[self.order[lo:hi, down].ravel()] = True
            new = np.flatnonzero(now & ~met & (self.own != own))
            met |= now
            found = np.concatenate((found, new))
            scores = np.concatenate((scores, self.values[new] @ query))
            if len(found) > k:
                best = np.lexsort((self.ids[found], -scores))[:k]
                found, scores = found[best], scores[best]
            if hi == n:
                break
            bound = self.sorted[n - hi, up] @ query[up] + self.sorted[hi - 1, down] @ query[down]
            if len(found) == k and bound < scores.min():
                break
            lo, hi = hi, 2 * hi
        best = np.lexsort((self.ids[found], -scores))
        return self.ids[found[best]], scores[best]


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    """Rows of ``vectors``, filled up with zeros."""
    if all(len(v) == width for v in vectors):
        return np.stack([np.asarray(v, dtype=np.int64) for v in vectors]) if len(vectors) else np.zeros((0, width), dtype=np.int64)
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for row, v in zip(out, vectors, strict=True):
        row[: len(v)] = v
    return out


def _exact(a: np.ndarray, b: np.ndarray) -> type:
    """Floats where they hold every sum exactly, as they multiply faster."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    return np.float32 if most < 2**24 else np.float64 if most < 2**53 else np.int64


def search_block(queries: pd.DataFrame, block: pd.DataFrame, k: int = K) -> pd.DataFrame:
    """The k best of ``block`` for each of ``queries`` (vec_id, v, row)."""
    out = [(np.empty(0, dtype=np.int64),) * 4]
    # A side without rows may come as the group's columns only.
    if "v" in queries and "v" in block and len(queries) and len(block):
        width = max(max(map(len, queries["v"])), max(map(len, block["v"])))
        q, x = _matrix(queries["v"], width), _matrix(block["v"], width)
        kind = _exact(q, x)
        lists = SortedLists(block["vec_id"].to_numpy(), x.astype(kind), block["row"].to_numpy())
        q = q.astype(kind)
        for query_id, own, query in zip(queries["vec_id"].tolist(), queries["row"].tolist(), q, strict=True):
            ids, scores = lists.search(own, query, k)
            out.append((np.full(len(ids), query_id), np.full(len(ids), own), ids, scores.astype(np.int64)))
    names = ("query_id", "row", "vec_id", "score")
    return pd.DataFrame({c: np.concatenate(x) for c, x in zip(names, zip(*out, strict=True), strict=True)})


def top_k(table: DataFrame, is_query: Column, k: int = K, scale: int = SCALE) -> DataFrame:
    """For each row of ``table`` (vec_id, embedding) that ``is_query`` holds for, its k best others.

    Returns query_id, rank (from 1), vec_id, score: fewer than k rows where there are
    fewer others, none for a lone vector or an empty table. Equal scores rank by smaller
    vec_id. Rows that share a vec_id are queries and candidates of their own. Missing
    components of shorter vectors are zero. Rows with a null id, or a null vector or one
    with null or non-finite components, take no part; other columns may have any names
    (``is_query`` is asked of vec_id only).
    """
    vectors = integer_vectors(table, scale)
    vectors = staged(vectors.withColumn("q", F.coalesce(is_query, F.lit(False))), "vectors")
    n, n_queries = vectors.agg(F.count("*"), F.count_if("q")).first()
    blocks = max(MIN_BLOCKS, -(-n // CANDIDATES))
    query_blocks = max(1, -(-n_queries // QUERIES))

    def dealt(parts: int, seed: int) -> Column:
        return F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(parts)).cast("int")

    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    candidates = vectors.select("vec_id", "v", "row", dealt(blocks, 0).alias("block"), every(query_blocks).alias("part"))
    queries = vectors.where("q").select("vec_id", "v", "row", every(blocks).alias("block"), dealt(query_blocks, 1).alias("part"))

    def search(asked: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        return search_block(asked, block, k)

    found = (
        queries.groupBy("block", "part")
        .cogroup(candidates.groupBy("block", "part"))
        .applyInPandas(search, "query_id bigint, row bigint, vec_id bigint, score bigint")
    )
    best = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
