"""Regression trees grown level by level over binned rows: forests and boosting for ``models``.

Features are cut into ``BINS`` by their quantiles, as Spark ML cuts them. Rows are kept as chunks, a
byte per feature and row, dealt evenly over the cores. Every level is one pass: each partition
sends its rows down the trees grown so far and adds up (weight, sum, sum of squares) per node,
feature and bin; the sums of all partitions choose the splits. Nothing is kept per row and tree.

What Spark ML's trees do is kept: variance as impurity, bootstrap by Poisson counts and a third of
the features per node for a forest, a share of the rows drawn per tree for boosting, whose first
tree has weight 1 and later ones the learning rate, squared or logistic loss. Draws hang on the
seed, the chunk and the tree, so a retried task draws the same. The result is a Spark ML model,
read back from the format in which Spark ML stores its models.
"""

from __future__ import annotations

import json
import math
import time
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finpanel.session import cut_lineage
from finpanel.sources.files import stage_path

#: Bins of a feature (Spark ML's ``maxBins``).
BINS = 32
#: Rows of a chunk, and of a partition, at most about.
CHUNK, PART_ROWS = 262_144, 4_000_000
#: Trees after which a boosting's running sums are written to the checkpoint folder.
CUT_EVERY = 50
#: Partitions whose sums the driver adds up itself.
NEAR = 64


def cuts_of(df: DataFrame, features: Sequence[str]) -> list[np.ndarray]:
    """Per feature its thresholds: between all values where they are few, else the quantiles."""
    at = [i / BINS for i in range(1, BINS)]
    value = {c: F.when(~F.isnan(c), F.col(c)) for c in features}
    got = df.agg(*[F.percentile_approx(value[c], at, 10_000).alias(f"q{i}") for i, c in enumerate(features)],
                 *[F.approx_count_distinct(value[c]).alias(f"n{i}") for i, c in enumerate(features)]).first()
    out = []
    for i, c in enumerate(features):
        cuts = np.unique(np.asarray(got[f"q{i}"] or [], float))
        if 0 < got[f"n{i}"] <= 2 * BINS:
            few = np.sort(np.asarray([r[0] for r in df.select(value[c].alias("v")).where("v IS NOT NULL").distinct().collect()], float))
            cuts = (few[1:] + few[:-1]) / 2 if len(few) <= BINS else cuts
        out.append(cuts)
    return out


def _chunks(cuts: list[np.ndarray], labels: tuple | None):
    """Rows (y first, then the features) -> chunks (part, chunk, n, bins, y)."""
    def run(batches):
        part, made, held, rows = TaskContext.get().partitionId(), 0, [], 0

        def packed():
            table = pa.Table.from_batches(held)
            x = [table.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(table.num_columns)]
            if np.isnan(x[0]).any() or labels is not None and not np.isin(x[0], labels).all():
                raise ValueError(f"labels must be {labels or 'numbers'}, none of them missing")
            bins = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x[1:])]).astype(np.uint8)
            return pa.record_batch({"part": pa.array([part], pa.int32()), "chunk": pa.array([made], pa.int32()),
                                    "n": pa.array([len(x[0])], pa.int32()), "bins": pa.array([bins.tobytes()]), "y": pa.array([x[0].tobytes()])})
        for b in batches:
            held.append(b)
            rows += b.num_rows
            if rows >= CHUNK:
                yield packed()
                made, held, rows = made + 1, [], 0
        if rows:
            yield packed()
    return run


def binned(df: DataFrame, y: str, features: Sequence[str], deal, labels: tuple | None = None) -> tuple[RDD, list[np.ndarray]]:
    """Chunks ((part, chunk), bins (feature, row), y) of the rows dealt by ``deal``, and the thresholds."""
    rows = df.select(F.col(y).cast("double").alias("_y"), *[F.coalesce(F.col(c).cast("double"), F.lit(math.nan)).alias(c) for c in features])
    cuts = cuts_of(rows, features)
    landed = cut_lineage(deal(rows).mapInArrow(_chunks(cuts, labels), "part int, chunk int, n int, bins binary, y binary"), "binned")
    k = len(features)
    chunks = landed.rdd.map(lambda r: ((r["part"], r["chunk"]), np.frombuffer(r["bins"], np.uint8).reshape(k, -1), np.frombuffer(r["y"])))
    return chunks.persist(StorageLevel.MEMORY_AND_DISK), cuts


def _walk(bins: np.ndarray, rows: np.ndarray, feat: np.ndarray, cut: np.ndarray, steps: int) -> np.ndarray:
    """The nodes (heap order) at which ``rows`` stand after ``steps`` steps; a leaf's rows keep to its left."""
    flat, offset, pos = bins.ravel(), feat.astype(np.int64) * bins.shape[1], np.zeros(len(rows), np.int64)
    for _ in range(steps):
        right = flat[offset[pos] + rows] > cut[pos]
        pos = 2 * pos + 1 + right
    return pos


def _sums(bins: np.ndarray, rows: np.ndarray, node: np.ndarray, open_: np.ndarray, subset: np.ndarray | None, w: np.ndarray | None, g: np.ndarray) -> np.ndarray:
    """(weight, sum, sum of squares) by (node, feature of its subset or all, bin) of the rows in open nodes."""
    if not open_.all():
        mine = np.flatnonzero(open_[node])
        rows, node, g, w = rows[mine], node[mine], g[mine], None if w is None else w[mine]
    flat, n = bins.ravel(), bins.shape[1]
    m = bins.shape[0] if subset is None else subset.shape[1]
    wg = g if w is None else w * g
    out, wgg = np.zeros((3, len(open_) * m * BINS)), wg * g
    for j in range(m):
        b = bins[j][rows] if subset is None else flat[(subset[:, j].astype(np.int64) * n)[node] + rows]
        at = node * (m * BINS) + (j * BINS) + b
        for i, x in enumerate((w, wg, wgg)):
            out[i] += np.bincount(at, x, out.shape[1])
    return out.reshape(3, len(open_), m, BINS)


def _splits(sums: np.ndarray, subset: np.ndarray | None) -> np.ndarray:
    """Per node (feature, bin, gain, left's 3 sums, right's 3 sums) of the best split; feature -1: none gains."""
    left = np.moveaxis(sums.cumsum(3), 0, -1)
    total = left[:, :, -1:, :]
    right = total - left
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (left[..., 1] ** 2 / left[..., 0] + right[..., 1] ** 2 / right[..., 0] - total[..., 1] ** 2 / total[..., 0]) / total[..., 0]
    gain = np.where((left[..., 0] >= 1) & (right[..., 0] >= 1), gain, -1.0).reshape(sums.shape[1], -1)
    best = gain.astype(np.float32).argmax(1)  # splits alike but for the order of addition: the first of them
    at = np.arange(sums.shape[1])
    j, b = best // BINS, best % BINS
    feature = j if subset is None else subset[at, j]
    picked = np.column_stack([feature, b, gain[at, best], left[at, j, b], right[at, j, b]])
    picked[picked[:, 2] <= 0, 0] = -1
    return picked


class Tree:
    """A tree in heap order while it grows: the children of node i are 2 i + 1 and 2 i + 2."""

    def __init__(self, depth: int):
        size = 2 ** (depth + 1) - 1
        self.depth, self.feat, self.cut = depth, np.zeros(size, np.uint8), np.full(size, 255, np.uint8)
        self.gain, self.stats, self.open = np.full(size, -1.0), np.zeros((size, 3)), np.zeros(size, bool)
        self.open[0] = depth > 0

    def level(self, k: int) -> slice:
        return slice(2 ** k - 1, 2 ** (k + 1) - 1)

    def grow(self, k: int, splits: np.ndarray) -> None:
        """Takes the splits of level ``k``; what cannot be split any more stays a leaf."""
        for i, s in zip(range(2 ** k - 1, 2 ** (k + 1) - 1), splits):
            if not self.open[i]:
                continue
            if k == 0:
                self.stats[0] = s[3:6] + s[6:9]
            if s[0] < 0:
                self.open[i] = False
                continue
            self.feat[i], self.cut[i], self.gain[i] = s[0], s[1], s[2]
            for c, stats in ((2 * i + 1, s[3:6]), (2 * i + 2, s[6:9])):
                self.stats[c] = stats
                self.open[c] = k + 1 < self.depth and stats[0] >= 2 and stats[2] - stats[1] ** 2 / stats[0] > 1e-14 * stats[2]

    def values(self) -> np.ndarray:
        """What rows at a node of the last level are given (a leaf above hands its own down)."""
        out = np.divide(self.stats[:, 1], self.stats[:, 0], out=np.zeros(len(self.stats)), where=self.stats[:, 0] > 0)
        for i in range(2 ** self.depth - 1):
            if self.gain[i] < 0:
                out[2 * i + 1] = out[2 * i + 2] = out[i]
        return out

    def preorder(self) -> np.ndarray:
        """The nodes that are part of the tree, a node before its left and these before its right."""
        out, todo = [], [0]
        while todo:
            i = todo.pop()
            out.append(i)
            if self.gain[i] > 0:
                todo += [2 * i + 2, 2 * i + 1]
        return np.asarray(out)


def _stored(grown: list[Tree], cuts: list[np.ndarray]) -> pa.Table:
    """The nodes as Spark ML stores them (treeID, nodeData), numbered in preorder."""
    lists = lambda lengths, x: pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)), pa.array(x))
    padded = np.asarray([np.pad(c, (0, BINS - len(c))) for c in cuts])
    parts = {k: [] for k in ("tree", "id", "stats", "gain", "left", "right", "feature", "cut")}
    for t, tree in enumerate(grown):
        at = tree.preorder()
        ids = np.full(len(tree.gain) * 2 + 1, -1, np.int64)
        ids[at] = np.arange(len(at))
        split = tree.gain[at] > 0
        for k, x in (("tree", np.full(len(at), t)), ("id", ids[at]), ("stats", tree.stats[at]), ("gain", np.where(split, tree.gain[at], -1.0)),
                     ("left", np.where(split, ids[2 * at + 1], -1)), ("right", np.where(split, ids[2 * at + 2], -1)),
                     ("feature", np.where(split, tree.feat[at], -1)), ("cut", padded[tree.feat[at], np.minimum(tree.cut[at], BINS - 1)])):
            parts[k].append(x)
    x = {k: np.concatenate(v) for k, v in parts.items()}
    n, s, q = x["stats"].T
    mean = np.divide(s, n, out=np.zeros(len(n)), where=n > 0)
    spread = np.maximum(np.divide(q, n, out=np.zeros(len(n)), where=n > 0) - mean * mean, 0.0)
    split = x["feature"] >= 0
    ints = lambda v: pa.array(v.astype(np.int32))
    how = pa.StructArray.from_arrays([ints(x["feature"]), lists(split.astype(int), x["cut"][split]), ints(np.full(len(n), -1))],
                                     ["featureIndex", "leftCategoriesOrThreshold", "numCategories"])
    node = pa.StructArray.from_arrays(
        [ints(x["id"]), pa.array(mean), pa.array(spread), lists(np.full(len(n), 3), x["stats"].ravel()), pa.array(n.astype(np.int64)),
         pa.array(x["gain"]), ints(x["left"]), ints(x["right"]), how],
        ["id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", "split"])
    return pa.table({"treeID": ints(x["tree"]), "nodeData": node})


#: Poisson counts of mean 1 by 16 random bits.
_POISSON = np.searchsorted(np.cumsum([math.exp(-1) / math.factorial(i) for i in range(12)]), (np.arange(65536) + 0.5) / 65536).astype(np.uint8)


def _drawn(seed: int, chunk: tuple, tree: int, n: int) -> np.ndarray:
    """16 random bits for every row of a chunk, for one tree."""
    return np.random.Generator(np.random.SFC64([seed, *chunk, tree])).integers(0, 65536, n, dtype=np.uint16)


def forest(chunks: RDD, features: int, trees: int, depth: int, seed: int) -> list[Tree]:
    """``trees`` trees, a pass per level for all of them."""
    grown, some = [Tree(depth) for _ in range(trees)], features if trees == 1 else math.ceil(features / 3)
    sc = chunks.context
    for k in range(depth):
        plan = {}
        for t, tree in enumerate(grown):
            if tree.open[tree.level(k)].any():
                order = np.random.default_rng([seed, t, k]).random((2 ** k, features)).argsort(1)
                plan[t] = (tree.feat[:2 ** k - 1], tree.cut[:2 ** k - 1], tree.open[tree.level(k)], np.sort(order[:, :some], axis=1).astype(np.uint8))
        if not plan:
            break
        held = sc.broadcast(plan)

        def level(part, k=k, held=held):
            total = {}
            for chunk, bins, y in part:
                for t, (feat, cut, open_, subset) in held.value.items():
                    w = _POISSON[_drawn(seed, chunk, t, len(y))] if trees > 1 else np.ones(len(y), np.uint8)
                    rows = np.flatnonzero(w)
                    node = _walk(bins, rows, feat, cut, k) - (2 ** k - 1)
                    sums = _sums(bins, rows, node, open_, subset, w[rows].astype(float), y[rows])
                    if t in total:
                        total[t] += sums
                    else:
                        total[t] = sums
            yield from total.items()

        added = chunks.mapPartitions(level).reduceByKey(np.add, min(len(plan), max(chunks.getNumPartitions(), chunks.context.defaultParallelism)))
        for t, splits in added.map(lambda x, held=held: (x[0], _splits(x[1], held.value[x[0]][3]))).collect():
            grown[t].grow(k, splits)
        held.unpersist()
    return grown


def _aim(sign: np.ndarray | None, at: np.ndarray | None, first: bool) -> np.ndarray:
    """What a tree is fitted to: the labels at first, then minus the loss's gradient, 2 (y - F) for squared loss
    (``at`` is y - F) or that of 2 log(1 + exp(-2 y F)) for signs y (``at`` is F)."""
    if sign is None:
        return at if first else 2 * at
    return sign.astype(float) if first else 4 * sign / (1 + np.exp(2 * sign * at))


def boost(chunks: RDD, features: int, trees: int, depth: int, rate: float, subsample: float, seed: int, logistic: bool) -> list[Tree]:
    """``trees`` trees one after the other. A chunk carries what is left of its rows' labels, or for logistic loss
    their signs and running sums."""
    state = chunks.map(lambda c: (c[0], c[1], *((np.where(c[2] > 0, 1, -1).astype(np.int8), np.zeros(len(c[2]))) if logistic else (None, c[2]))))
    add = (lambda r: r.reduce(np.add)) if chunks.getNumPartitions() <= NEAR else (lambda r: r.treeReduce(np.add))
    grown, before = [], []
    for t in range(trees):
        tree = Tree(depth)
        for k in range(depth):
            if not tree.open[tree.level(k)].any():
                break
            feat, cut, open_ = tree.feat[:2 ** k - 1], tree.cut[:2 ** k - 1], tree.open[tree.level(k)]

            def level(part, t=t, k=k, feat=feat, cut=cut, open_=open_):
                total = np.zeros((3, len(open_), features, BINS))
                for chunk, bins, sign, at in part:
                    rows = np.arange(len(at)) if subsample >= 1 else np.flatnonzero(_drawn(seed, chunk, t, len(at)) < subsample * 65536)
                    node = _walk(bins, rows, feat, cut, k) - (2 ** k - 1)
                    total += _sums(bins, rows, node, open_, None, None, _aim(None if sign is None else sign[rows], at[rows], t == 0))
                yield total

            tree.grow(k, _splits(add(state.mapPartitions(level)), None))
        grown.append(tree)
        if t + 1 < trees:
            feat, cut, values = tree.feat, tree.cut, tree.values() * (rate if t else 1.0)

            def moved(c, feat=feat, cut=cut, values=values):
                step = values[_walk(c[1], np.arange(len(c[3])), feat, cut, depth)]
                return c[0], c[1], c[2], c[3] - step if c[2] is None else c[3] + step

            state = state.map(moved).persist(StorageLevel.MEMORY_AND_DISK)
            if (t + 1) % CUT_EVERY == 0:
                state.checkpoint()
            before.append(state)
            if len(before) > 2:  # the one before the last is what a lost partition is made from
                before.pop(0).unpersist()
    for s in before:
        s.unpersist()
    return grown


def as_model(spark: SparkSession, est, kind: str, grown: list[Tree], cuts: list[np.ndarray], weights: Sequence[float], tree_params: dict, load):
    """The Spark ML model ``kind`` of the estimator's parameters with these trees, by Spark ML's stored form."""
    path = stage_path(spark, "trees")
    est.write().overwrite().save(f"{path}/estimator")
    meta = json.loads(spark.read.text(f"{path}/estimator/metadata").first()[0])
    meta |= {"class": kind, "timestamp": int(time.time() * 1000), "numFeatures": len(cuts), "numTrees": len(grown)}
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.text(f"{path}/model/metadata")
    nodes = _stored(grown, cuts)
    spark.createDataFrame(nodes).repartition(max(1, nodes.num_rows // 100_000), "treeID").write.parquet(f"{path}/model/data")
    one = {k: v for k, v in meta.items() if k not in ("numFeatures", "numTrees")} | {
        "class": "org.apache.spark.ml.regression.DecisionTreeRegressionModel", "paramMap": tree_params, "defaultParamMap": {
            k: v for k, v in meta["defaultParamMap"].items() if k not in (
                "maxIter", "stepSize", "lossType", "validationTol", "subsamplingRate", "featureSubsetStrategy", "bootstrap", "numTrees",
                "probabilityCol", "rawPredictionCol")}}
    spark.createDataFrame([(t, json.dumps(one | {"uid": f"dtr_{meta['uid'][-8:]}_{t}"}), float(w)) for t, w in enumerate(weights)],
                          "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/model/treesMetadata")
    return load(f"{path}/model")
