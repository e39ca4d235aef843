"""Exact k-nearest-neighbour edges (Euclidean): every pair is compared, in blocks. ``lsh`` is the
form that is linear in the rows.

1. Points are dealt into blocks by a hash of their id; a task holds two blocks, one of sources and
   one of destinations, so each row is dealt once per block, not once per row of another.
2. Inside, a matrix product gives all distances up to rounding; whatever lies within that rounding
   of the k-th is summed again term by term, so distances and ties are those of the plain formula.
3. The k best of a source in every block meet in one exchange.

Memory is bounded by the block, the work (rows squared) is spread over pairs of blocks. Optional
``by`` keys restrict neighbours to the same group (e.g. a class for SMOTE). Vectors that are NULL,
hold a NULL or NaN, or differ in length have no distance.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Points of a block, about; sources compared at a time within it.
BLOCK_POINTS = 20_000
STRIDE = 256


def sq_dist(a: Column, b: Column) -> Column:
    d = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.aggregate(d, F.lit(0.0), lambda acc, v: acc + v)


def euclid(a: Column, b: Column) -> Column:
    return F.sqrt(sq_dist(a, b))


def _rows(table: pa.Table) -> np.ndarray:
    return np.asarray(table.column("v").combine_chunks().flatten()).reshape(table.num_rows, -1)


def _best(k: int, by: list[str]):
    """Sources and destinations of two blocks -> (by..., src, dst, dist): each source's k nearest there."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("id")  # equal distances go by id, whatever its type
        ids, dst = (x.column("id").to_numpy() for x in (left, right))
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if len(ids) and len(dst):
            v, w = _rows(left), _rows(right)
            long_v, long_w = (v * v).sum(1), (w * w).sum(1)
            kth = min(k, len(dst)) - 1
            for lo in range(0, len(ids), STRIDE):
                part = v[lo:lo + STRIDE]
                sq = long_v[lo:lo + STRIDE, None] + long_w[None, :] - 2 * (part @ w.T)
                sq[ids[lo:lo + STRIDE, None] == dst[None, :]] = np.inf
                far = np.partition(sq, kth, axis=1)[:, kth] + 1e-10 * (long_v[lo:lo + STRIDE] + long_w.max())
                r, c = np.nonzero((sq <= far[:, None]) & np.isfinite(sq))
                exact = np.zeros(len(r))
                for i in range(v.shape[1]):
                    exact += (part[r, i] - w[c, i]) ** 2
                exact = np.sqrt(exact)
                order = np.lexsort((c, exact, r))
                r, c, exact = r[order], c[order], exact[order]
                keep = np.arange(len(r)) - np.searchsorted(r, r) < k
                out.append((lo + r[keep], c[keep], exact[keep]))
        src, near, dist = (np.concatenate(x) for x in zip(*out))
        held = left.take(pa.array(src))
        return pa.table([*[held.column(b) for b in by], held.column("id"), right.column("id").take(pa.array(near)), pa.array(dist)],
                        names=[*by, "src", "dst", "dist"])
    return run


def knn_edges(df: DataFrame, id_col: str, vec: str, k: int = 5, by: Sequence[str] = (),
              buckets: int | None = None) -> DataFrame:
    """(by..., src, dst, rank, dist): the k nearest other points of every point. ``buckets`` is the
    number of blocks (None: by the number of points)."""
    by = list(by)
    pts = df.select(*by, F.col(id_col).alias("id"), F.col(vec).cast("array<double>").alias("v"))
    pts = pts.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x)) & (F.size("v") > 0))
    for b in by:
        pts = pts.where(F.col(b).isNotNull())
    n = buckets or max(4, -(-pts.count() // BLOCK_POINTS))
    pts = pts.withColumns({"_len": F.size("v"), "_own": F.pmod(F.xxhash64("id"), F.lit(n))})
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    keys = [*by, "_len", "_src", "_dst"]
    src = pts.withColumnRenamed("_own", "_src").withColumn("_dst", every)
    dst = pts.withColumnRenamed("_own", "_dst").withColumn("_src", every)
    kind = df.schema[id_col].dataType.simpleString()
    schema = "".join(f"`{b}` {df.schema[b].dataType.simpleString()}, " for b in by) + f"src {kind}, dst {kind}, dist double"
    found = src.groupBy(*keys).cogroup(dst.groupBy(*keys)).applyInArrow(_best(k, by), schema)
    nearest = Window.partitionBy(*by, "src").orderBy("dist", "dst")
    return (found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)
                 .select(*by, "src", "dst", "rank", "dist"))


def star_edges(nn: DataFrame) -> DataFrame:
    """Both directions of every centre-neighbour edge (one star graph per centre)."""
    out = nn.select("src", "dst", "rank", "dist", F.col("src").alias("center"))
    back = nn.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "rank", "dist",
                     F.col("src").alias("center"))
    return out.unionByName(back)
