"""A network of sigmoid layers with softmax on top, fitted by L-BFGS: Spark ML's perceptron for ``models``.

Rows are kept as chunks of plain matrices, dealt evenly over the cores. Each evaluation is one pass:
a partition sends its rows through the layers ``stack`` at a time and adds up loss and gradient; the
driver holds the weights and the last steps only, as Spark ML's optimiser does. Start weights are Spark
ML's own, and the result is a Spark ML model, read back from the form in which Spark ML stores it.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finpanel.ml.trees import NEAR
from finpanel.session import cut_lineage
from finpanel.sources.files import stage_path

#: Steps that L-BFGS remembers, values that it compares for convergence, and how near they must be.
MEMORY, WINDOW, TOL = 10, 20, 1e-6


def stacked(df: DataFrame, y: str, features: Sequence[str], deal, classes: int) -> RDD:
    """Chunks (rows by features, labels) of the rows dealt by ``deal``."""
    rows = df.select(F.col(y).cast("double").alias("_y"), *[F.coalesce(F.col(c).cast("double"), F.lit(math.nan)).alias(c) for c in features])

    def run(batches):
        for b in batches:
            label, *x = (c.to_numpy(zero_copy_only=False).astype(float) for c in b.columns)
            if not np.isin(label, range(classes)).all():
                raise ValueError(f"labels must be 0 to {classes - 1}, none of them missing")
            yield pa.record_batch({"x": pa.array([np.column_stack(x).tobytes()]), "y": pa.array([label.astype(np.uint8).tobytes()])})

    landed, k = cut_lineage(deal(rows).mapInArrow(run, "x binary, y binary"), "stacked"), len(features)
    return landed.rdd.map(lambda r: (np.frombuffer(r["x"]).reshape(-1, k), np.frombuffer(r["y"], np.uint8))).persist(StorageLevel.MEMORY_AND_DISK)


def _layers(w: np.ndarray, sizes: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(matrix, bias) of every layer, views of the flat weights in Spark ML's order."""
    out, at = [], 0
    for a, b in zip(sizes, sizes[1:]):
        out.append((w[at:at + a * b].reshape(a, b), w[at + a * b:at + a * b + b]))
        at += a * b + b
    return out


def pass_of(x: np.ndarray, y: np.ndarray, w: np.ndarray, sizes: Sequence[int]) -> np.ndarray:
    """(rows, sum of cross entropies, gradient...) of some rows, the hidden layers in the precision of ``w``."""
    layers, out = _layers(w, sizes), np.zeros(len(w) + 2)
    held = [x.astype(w.dtype)]
    with np.errstate(over="ignore"):
        for m, b in layers[:-1]:
            z = held[-1] @ m
            z += b
            np.negative(z, out=z)
            np.exp(z, out=z)
            z += 1
            held.append(np.reciprocal(z, out=z))
    z = held[-1].astype(float) @ layers[-1][0] + layers[-1][1]
    z -= z.max(1, keepdims=True)
    total = np.log(np.exp(z).sum(1))
    at = np.arange(len(y))
    out[0], out[1] = len(y), (total - z[at, y]).sum()
    delta = np.exp(z - total[:, None])
    delta[at, y] -= 1
    delta = delta.astype(w.dtype)
    grads = _layers(out[2:], sizes)
    for i in range(len(layers) - 1, -1, -1):
        grads[i][0][:] = held[i].T @ delta
        grads[i][1][:] = delta.sum(0)
        if i:
            delta = delta @ layers[i][0].T
            delta *= held[i]
            delta *= 1 - held[i]
    return out


def loss_of(chunks: RDD, sizes: Sequence[int], stack: int) -> Callable:
    """weights -> (mean cross entropy, its gradient), one pass over the rows. Hidden layers are multiplied in single
    precision, as networks are; cross entropies, the sums over stacks and the weights are double."""
    def value(w: np.ndarray) -> tuple[float, np.ndarray]:
        held = chunks.context.broadcast(w)

        def part(rows):
            total, w = np.zeros(len(held.value) + 2), held.value.astype(np.float32)
            for x, y in rows:
                for lo in range(0, len(y), stack):
                    total += pass_of(x[lo:lo + stack], y[lo:lo + stack], w, sizes)
            yield total

        sums = chunks.mapPartitions(part)
        got = sums.reduce(np.add) if chunks.getNumPartitions() <= NEAR else sums.treeReduce(np.add)
        held.unpersist()
        return got[1] / got[0], got[2:] / got[0]
    return value


def _searched(value: Callable, w: np.ndarray, f: float, g: np.ndarray, d: np.ndarray, step: float):
    """(weights, value, gradient) along ``d`` where the strong Wolfe conditions hold, or the lowest place met."""
    slope, lo, hi, best = g @ d, (0.0, f, g @ d), None, None
    for _ in range(20):
        at = w + step * d
        fa, ga = value(at)
        sa = ga @ d
        if math.isfinite(fa) and (best is None or fa < best[1]):
            best = (at, fa, ga)
        if not math.isfinite(fa) or fa > f + 1e-4 * step * slope or fa >= lo[1] and lo[0] > 0:
            hi = (step, fa, sa)
        elif abs(sa) <= -0.9 * slope:
            return at, fa, ga
        else:
            if sa * ((hi[0] if hi else math.inf) - lo[0]) >= 0:
                hi = lo
            lo = (step, fa, sa)
        if hi is None:
            step *= 1.5
            continue
        a, b = lo[0], hi[0]
        bend = 2 * (hi[1] - lo[1] - lo[2] * (b - a)) if math.isfinite(hi[1]) else 0.0
        step = a - lo[2] * (b - a) ** 2 / bend if bend > 0 else (a + b) / 2
        near, far = min(a, b) + 0.1 * abs(b - a), max(a, b) - 0.1 * abs(b - a)
        step = min(max(step, near), far)
    return best if best is not None and best[1] < f else None


def minimised(value: Callable, w: np.ndarray, max_iter: int) -> np.ndarray:
    """L-BFGS: until the last values agree, the gradient vanishes or ``max_iter`` steps are made."""
    f, g = value(w)
    first, seen, past = abs(f), [f], []
    for i in range(max_iter):
        d = -g
        kept = []
        for s, r in reversed(past):
            a = (s @ d) / (s @ r)
            d = d - a * r
            kept.append(a)
        if past:
            s, r = past[-1]
            d = d * ((s @ r) / (r @ r))
        for (s, r), a in zip(past, reversed(kept)):
            d = d + s * (a - (r @ d) / (s @ r))
        found = _searched(value, w, f, g, d, 1.0 if past else 1.0 / max(np.linalg.norm(d), 1e-300)) if g @ d < 0 else None
        if found is None:
            if not past:
                break
            past = []  # what is remembered leads nowhere: once more along the gradient
            continue
        s, r = found[0] - w, found[2] - g
        if s @ r > 0:
            past = [*past, (s, r)][-MEMORY:]
        w, f, g = found
        seen = [*seen, f][-WINDOW:]
        if len(seen) > 1 and abs(f - max(seen)) <= TOL * first or np.linalg.norm(g) <= max(TOL * abs(f), 1e-8):
            break
    return w


def start_of(spark: SparkSession, est, classes: int, features: int):
    """Spark ML's model before its first step: one row per class, no iteration."""
    rows = spark.createDataFrame([(Vectors.dense([0.0] * features), float(c)) for c in range(classes)], ["features", est.getLabelCol()])
    return est.copy({est.maxIter: 0}).fit(rows)


def with_weights(spark: SparkSession, est, start, w: np.ndarray, load):
    """``start`` with other weights and the estimator's number of iterations, by Spark ML's stored form."""
    path = stage_path(spark, "network")
    start.write().overwrite().save(f"{path}/start")
    meta = json.loads(spark.read.text(f"{path}/start/metadata").first()[0])
    meta["paramMap"]["maxIter"] = est.getMaxIter()
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.text(f"{path}/model/metadata")
    spark.createDataFrame([(Vectors.dense(w),)], ["weights"]).coalesce(1).write.parquet(f"{path}/model/data")
    return load(f"{path}/model")
