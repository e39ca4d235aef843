"""Closed-form ridge, per-class boosting, cross-validation, halving search, run history, stored models."""

import json

import duckdb
import numpy as np
import pytest

from finpanel.ml import history as hi
from finpanel.ml import models as mo
from finpanel.ml import search as se
from finpanel.ml.folds import temporal_folds
from finpanel.session import cut_lineage


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 3))
    y = 2 * x[:, 0] - x[:, 1] + 0.1 * rng.normal(size=600) + 3
    cls = np.digitize(y, [2, 4])
    rows = [(i, 2000 + i // 60, f"Q{i % 4 + 1}", *map(float, a), float(b), float(c), float(c == 2)) for i, (a, b, c) in enumerate(zip(x, y, cls))]
    return cut_lineage(spark.createDataFrame(rows, "id long, fy int, fp string, a double, b double, c double, y double, cls double, hit double").repartition(3))


F3 = ["a", "b", "c"]


def test_ridge_is_the_closed_form(table):
    pdf = table.toPandas()
    x, y = pdf[F3].to_numpy(), pdf.y.to_numpy()
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + 4.0 * np.eye(3), xc.T @ yc)
    got = {r.feature: r.coefficient for r in mo.ridge(table, "y", F3, 4.0).collect()}
    assert np.allclose([got[f] for f in F3], w) and np.isclose(got["(intercept)"], y.mean() - x.mean(0) @ w)
    plain = mo.ridge(table, "y", F3, 0.0)
    err = table.select((mo.ridge_prediction(plain) - table.y).alias("e")).toPandas().e
    assert err.std() < 0.12
    linear = mo.fit_linear(table, "y", F3, 0.0).stages[-1].coefficients.toArray()
    assert np.allclose(linear, [r.coefficient for r in plain.collect()][:3], atol=1e-6)


def test_ridge_leaves_incomplete_rows_out(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (None, 9.0), (3.0, None)], "x double, y double")
    assert {r.feature: round(r.coefficient, 9) for r in mo.ridge(df, "y", ["x"], 0.0).collect()} == {"x": 2.0, "(intercept)": 0.0}


def test_boosting_of_three_classes_ranks_by_raw_scores(table):
    m = mo.fit_gbt(table, "cls", F3, "multiclass", trees=8, depth=3, lr=0.3)
    p, names = mo.class_scores(m, table)
    rows = p.select("prediction", *names).toPandas()
    assert (rows[names].to_numpy().argmax(1) == rows.prediction).all()
    assert rows[names].to_numpy().min() < 0 < rows[names].to_numpy().max()  # margins, no probabilities
    grid = {"gbt": {"fit": "gbt", "trees": 8, "depth": 3, "lr": 0.3}, "forest": {"fit": "forest", "trees": 10, "depth": 4}}
    got = se.compare_models(table, table, "cls", F3, grid, "multiclass").collect()
    assert all(r.roc_auc_ovr > 0.9 and r.score_valid > 0.8 for r in got)


def test_fits_on_a_known_line(table):
    """Bounds of the other fits on data whose rule is known."""
    assert se._metrics(mo.fit_logistic(table, "hit", F3), table, "hit", "binary")["f1"] > 0.9
    assert se._metrics(mo.fit_mlp(table, "hit", F3, (4,), 2, 60), table, "hit", "binary")["f1"] > 0.9
    forest = mo.fit_forest(table, "y", F3, "regression", 20, 6)
    imp = {r.feature: r.importance for r in mo.importance(forest, F3).collect()}
    assert imp["a"] > imp["b"] > imp["c"] and abs(sum(imp.values()) - 1) < 1e-9


def test_cross_validation_scores_every_fold(table):
    folded = table.withColumn("fold", (table.id % 5).cast("int"))
    rows = se.cross_validate(folded, "y", F3, {"fit": "linear"}).collect()
    assert [(r.fold, r.n_train, r.n_test) for r in rows] == [(k, 480, 120) for k in range(5)]
    assert all(r.r2 > 0.98 for r in rows)


def test_settings_come_from_their_ranges():
    space = {"trees": ("int", 10, 40), "depth": ("int", 2, 5), "lr": ("log", 0.02, 0.3), "subsample": ("float", 0.6, 1.0)}
    got = se.draw_settings(space, 30)
    assert len({json.dumps(s) for s in got}) == 30 and {s["depth"] for s in got} == {2, 3, 4, 5}
    sql = """SELECT 10 + floor(((t + 1) * sqrt(2)) % 1.0 * 31)::INT, 2 + floor(((t + 1) * sqrt(3)) % 1.0 * 4)::INT,
      0.02 * pow(0.3 / 0.02, ((t + 1) * sqrt(5)) % 1.0), 0.6 + 0.4 * (((t + 1) * sqrt(7)) % 1.0) FROM range(30) r(t)"""
    want = duckdb.connect().execute(sql).fetchall()
    assert [tuple(round(float(v), 9) for v in s.values()) for s in got] == [tuple(round(float(v), 9) for v in r) for r in want]


@pytest.mark.parametrize("task,y", [("regression", "y"), ("multiclass", "cls")])
def test_halving_stops_the_worse(table, task, y):
    folded = cut_lineage(temporal_folds(table, "fy", "fp", "id", 3))
    space = {"trees": ("int", 1, 6), "lr": ("log", 0.05, 0.5)}
    rows = se.halving_search(folded, y, F3, space, {"fit": "gbt", "depth": 2}, trials=6, n_folds=3, task=task).collect()
    assert sorted(r.folds_scored for r in rows) == [1, 1, 1, 1, 2, 3] and len({r.params for r in rows}) == 6
    assert rows[0].folds_scored == 3 and [r["rank"] for r in rows] == [1, 2, 3, 4, 5, 6]
    firsts = [r.mean_score for r in rows if r.folds_scored == 1]
    assert firsts == sorted(firsts, reverse=task != "regression")


def test_ablation_keeps_a_history(spark, table, tmp_path):
    folder, groups = str(tmp_path / "runs"), {"ab": ["a", "b"], "c": ["c"]}
    one = {r.feature_group: r for r in se.ablation(table, table, "y", F3, {"fit": "linear"}, groups, history=folder, run="first").collect()}
    assert one["ab"].verdict == "enough" and one["c"].verdict == "partial"
    two = {r.feature_group: r for r in se.ablation(table, table, "y", F3, {"fit": "linear"}, groups, mode="remove", history=folder, run="second").collect()}
    assert two["ab"].verdict == "helps" and two["c"].verdict == "neutral"
    earlier = hi.read(spark, folder, before="second").collect()
    assert {r.run for r in earlier} == {"first"} and {r.feature_group: r.score for r in earlier} == {g: r.score for g, r in one.items()}


def test_a_changed_model_fails_the_recheck(spark, table, tmp_path):
    folder = str(tmp_path / "registry")
    m = mo.fit_linear(table, "y", F3)
    path = hi.save_model(m, "line", F3, "y", "regression", se._metrics(m, table, "y", "regression"), folder)
    assert {r.ok for r in hi.recheck(spark, folder, table).collect()} == {True}
    mo.fit_linear(table, "y", F3, l2=5.0).write().overwrite().save(path)
    assert not any(r.ok for r in hi.recheck(spark, folder, table).collect() if r.metric in ("rmse", "r2"))


def test_gap_of_a_binary_model(table):
    m = mo.fit_forest(table, "hit", F3, "binary", 10, 4)
    rows = {r.metric: r for r in se.train_val_gap(m, table, table.where("id % 2 = 0"), "hit", "binary").collect()}
    assert {"f1", "average_precision"} <= set(rows) and all(abs(r.gap - (r.train - r.valid)) < 1e-12 for r in rows.values())


def test_trees_are_fitted_on_every_core_and_keep_their_nodes(spark, table):
    one = table.coalesce(1)
    assert mo.dealt(one).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert sorted(map(tuple, mo.dealt(one).collect())) == sorted(map(tuple, one.collect()))
    forest = mo.fit_forest(one, "y", F3, "regression", 5, 4).stages[-1]
    assert forest.getCacheNodeIds() and forest.getNumTrees == 5 and forest.getMaxDepth() == 4


def test_network_takes_rows_in_stacks(table):
    net = mo.fit_mlp(table.coalesce(1), "hit", F3, (4,), 2, 5).stages[-1]
    assert net.getBlockSize() == mo.STACK and net.getLayers() == [3, 4, 2]
