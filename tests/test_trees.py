"""Trees grown over binned rows: the trees of Spark ML where nothing is drawn, its kind of forest where rows and features are."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor

from finpanel.ml import models as mo
from finpanel.ml import trees as tr
from finpanel.session import cut_lineage

F3 = ["a", "b", "c"]


@pytest.fixture(scope="module")
def few(spark):
    """Features of few values, so that all thresholds are the same as Spark ML's."""
    rng = np.random.default_rng(8)
    x = rng.integers(0, 20, size=(900, 3)) / 4
    y = np.sin(x[:, 0]) + 0.3 * x[:, 1] + 0.2 * rng.normal(size=900)
    rows = [(*map(float, v), float(t), float(t > 1)) for v, t in zip(x, y)]
    return cut_lineage(spark.createDataFrame(rows, "a double, b double, c double, y double, hit double").repartition(5))


def _values(model, df, column="prediction"):
    rows = model.transform(df).orderBy("a", "b", "c", "y").select(column).collect()
    return np.asarray([np.ravel(r[0].toArray() if hasattr(r[0], "toArray") else r[0]) for r in rows])


def test_one_tree_is_spark_mls_tree(few):
    ours = mo.fit_forest(few, "y", F3, "regression", 1, 5)
    theirs = mo._pipe(F3, DecisionTreeRegressor(labelCol="y", maxDepth=5)).fit(few)
    assert np.allclose(_values(ours, few), _values(theirs, few))
    a, b = ours.stages[-1], theirs.stages[-1]
    assert a.totalNumNodes == b.numNodes and a.trees[0].depth == b.depth
    assert np.allclose(a.featureImportances.toArray(), b.featureImportances.toArray())


@pytest.mark.parametrize("task", ["regression", "binary"])
def test_boosting_is_spark_mls_where_nothing_is_drawn(few, task):
    y, cls = ("y", GBTRegressor) if task == "regression" else ("hit", GBTClassifier)
    ours = mo.fit_gbt(few, y, F3, task, trees=6, depth=3, lr=0.2, subsample=1.0)
    theirs = mo._pipe(F3, cls(labelCol=y, maxIter=6, maxDepth=3, stepSize=0.2)).fit(few)
    column = "prediction" if task == "regression" else "rawPrediction"
    assert np.allclose(_values(ours, few, column), _values(theirs, few, column))
    m = ours.stages[-1]
    assert m.getNumTrees == 6 and m.treeWeights == theirs.stages[-1].treeWeights and m.getStepSize() == 0.2
    assert np.allclose(m.featureImportances.toArray(), theirs.stages[-1].featureImportances.toArray())


def test_forest_draws_rows_and_features_and_repeats(few, tmp_path):
    one, two = (mo.fit_forest(few, "y", F3, "regression", 12, 4, seed=7) for _ in range(2))
    assert np.allclose(_values(one, few), _values(two, few))
    trees = one.stages[-1].trees
    assert len({t.toDebugString.split("\n", 1)[1] for t in trees}) == 12
    one.write().overwrite().save(str(tmp_path / "forest"))
    again = type(one).load(str(tmp_path / "forest"))
    assert np.array_equal(_values(one, few), _values(again, few)) and again.stages[-1].getNumTrees == 12
    w = tr._POISSON[tr._drawn(7, (0, 0), 0, 200_000)]
    assert abs(w.mean() - 1) < 0.02 and abs(w.var() - 1) < 0.03


def test_a_row_is_kept_as_bytes_not_per_tree(spark, few):
    chunks, cuts = tr.binned(few, "y", F3, mo._parts)
    held = chunks.collect()
    assert sum(len(y) for _, _, y in held) == 900 and all(b.dtype == np.uint8 and b.shape == (3, len(y)) for _, b, y in held)
    assert len({c for c, _, _ in held}) == len(held) <= spark.sparkContext.defaultParallelism
    assert all(len(c) == 19 for c in cuts)
    chunks.unpersist()


def test_missing_features_stand_with_the_largest_and_odd_labels_are_told(spark):
    df = spark.createDataFrame([(float(i % 5), None if i % 5 == 4 else float(i % 5), 9.0 if i % 5 == 4 else 1.0) for i in range(50)], "a double, b double, y double")
    m = mo.fit_forest(df, "y", ["b"], "regression", 1, 2)
    got = {r.b: r.prediction for r in m.transform(df).collect()}
    assert got[None] == got[3.0] == pytest.approx(5.0) and got[0.0] == pytest.approx(1.0)
    with pytest.raises(Exception, match="labels must be"):
        mo.fit_gbt(df, "y", ["a"], "binary", trees=2, depth=2)
    flat = mo.fit_gbt(df.withColumn("y", df.a * 0 + 2.0), "y", ["a"], "regression", trees=3, depth=2)
    assert {round(r.prediction, 9) for r in flat.transform(df).collect()} == {2.0}


def test_trials_of_a_fold_share_its_bins(few, monkeypatch):
    from finpanel.ml import search as se
    from finpanel.ml.folds import fold_frames, temporal_folds
    from pyspark.sql import functions as F
    made, real = [], tr.binned
    monkeypatch.setattr(tr, "binned", lambda *a: made.append(1) or real(*a))
    df = few.withColumn("fy", (F.col("a") + 2000).cast("int")).withColumn("fp", F.lit("Q1")).withColumn("id", F.monotonically_increasing_id())
    folded = cut_lineage(temporal_folds(df, "fy", "fp", "id", 2))
    rows = se.halving_search(folded, "y", F3, {"trees": ("int", 1, 4)}, {"fit": "gbt", "depth": 2, "subsample": 1.0}, trials=4, n_folds=2).collect()
    assert len(rows) == 4 and len(made) == 2
    train, test = fold_frames(folded, 1)
    for r in (r for r in rows if r.folds_scored == 1):
        alone = mo.fit_gbt(train, "y", F3, "regression", depth=2, subsample=1.0, **eval(r.params))
        assert se._metrics(alone, test, "y", "regression")["rmse"] == pytest.approx(r.mean_score)
