"""The network's passes: gradient, start and layout are Spark ML's; the fit is as good as Spark ML's own."""

import numpy as np
import pytest
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.sql import functions as F

from finpanel.ml import models as mo
from finpanel.ml import network as nw
from finpanel.session import cut_lineage

F2 = ["a", "b"]


@pytest.fixture(scope="module")
def rings(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(1500, 2))
    rows = [(float(a), float(b), float(int(a * a + b * b > 1) + int(a * a + b * b > 2.5))) for a, b in x]
    return cut_lineage(spark.createDataFrame(rows, "a double, b double, ring double").repartition(3))


def _entropy(model, df, y):
    from pyspark.ml.functions import vector_to_array
    p = F.get(vector_to_array("probability"), F.col(y).cast("int"))
    return model.transform(df).agg(F.avg(-F.log(p)).alias("e")).first().e


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(1)
    sizes = [3, 5, 4, 3]
    n = sum(a * b + b for a, b in zip(sizes, sizes[1:]))
    x, y, w = rng.normal(size=(40, 3)), rng.integers(0, 3, 40), rng.normal(size=n)
    got = nw.pass_of(x, y, w, sizes)
    assert got[0] == 40
    for i in rng.integers(0, n, 15):
        e = np.eye(n)[i] * 1e-6
        assert (nw.pass_of(x, y, w + e, sizes)[1] - nw.pass_of(x, y, w - e, sizes)[1]) / 2e-6 == pytest.approx(got[2 + i], abs=1e-4)
    single = nw.pass_of(x, y, w.astype(np.float32), sizes)
    assert np.allclose(single, got, rtol=1e-4, atol=1e-4)


def test_loss_and_start_are_spark_mls(spark, rings):
    est = MultilayerPerceptronClassifier(labelCol="ring", layers=[2, 5, 3], maxIter=7, blockSize=mo.STACK, seed=3)
    start = nw.start_of(spark, est, 3, 2)
    chunks = nw.stacked(rings, "ring", F2, mo.dealt, 3)
    value, grad = nw.loss_of(chunks, [2, 5, 3], 100)(start.weights.toArray())
    m = mo._fitted(F2, nw.with_weights(spark, est, start, start.weights.toArray(), type(start).load))
    assert value == pytest.approx(_entropy(m, rings, "ring")) and len(grad) == len(start.weights) and m.stages[-1].getMaxIter() == 7
    chunks.unpersist()


def test_fit_is_as_good_as_spark_mls(rings):
    ours = mo.fit_mlp(rings, "ring", F2, (8, 5), 3, 60, seed=5)
    theirs = mo._pipe(F2, MultilayerPerceptronClassifier(labelCol="ring", layers=[2, 8, 5, 3], maxIter=60, blockSize=mo.STACK, seed=5)).fit(rings)
    a, b = _entropy(ours, rings, "ring"), _entropy(theirs, rings, "ring")
    assert a < max(1.1 * b, b + 0.02) and a < 0.4


def test_odd_labels_are_told(rings):
    with pytest.raises(Exception, match="labels must be"):
        mo.fit_mlp(rings, "ring", F2, (3,), 2, 5)
