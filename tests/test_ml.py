"""Rank metrics and folds against brute force on small fixtures."""

import numpy as np

from finpanel.ml import folds as fo
from finpanel.ml import metrics as me


def _brute_auc(y, s):
    pos = [b for a, b in zip(y, s) if a == 1]
    neg = [b for a, b in zip(y, s) if a == 0]
    tot = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def _brute_ap(y, s):
    order = sorted(set(s), reverse=True)
    P, ap, prev_r = sum(y), 0.0, 0.0
    for t in order:
        tp = sum(1 for a, b in zip(y, s) if b >= t and a == 1)
        k = sum(1 for b in s if b >= t)
        r = tp / P
        ap += (r - prev_r) * tp / k
        prev_r = r
    return ap


def test_auc_and_ap_with_ties(spark):
    rng = np.random.default_rng(3)
    s = [float(v) for v in rng.integers(0, 20, 300) / 20.0]
    y = [int(v) for v in (rng.random(300) < 0.4)]
    df = spark.createDataFrame(list(zip(y, s)), "y int, s double")
    assert abs(me.roc_auc(df, "y", "s").first()["auc"] - _brute_auc(y, s)) < 1e-12
    assert abs(me.pr_auc(df, "y", "s").first()["average_precision"] - _brute_ap(y, s)) < 1e-12


def test_eval_regression(spark):
    df = spark.createDataFrame([(0.5, 0.4), (0.2, 1.3), (0.9, 0.8)], "y double, p double")
    r = me.eval_regression(df, "y", "p").first()
    p = np.clip([0.4, 1.3, 0.8], 0, 1)
    y = np.array([0.5, 0.2, 0.9])
    assert abs(r["rmse"] - np.sqrt(np.mean((y - p) ** 2))) < 1e-12
    assert abs(r["r2"] - (1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2))) < 1e-12


def test_temporal_folds_positions(spark, monkeypatch):
    from finpanel.ml import ranks
    _check_folds(spark)
    monkeypatch.setattr(ranks, "RANGE_ROWS", 5)  # many ranges
    _check_folds(spark)


def test_folds_and_splits_keep_every_row(spark):
    """NULL periods, strata and ties, repeated rows and text ids."""
    from finpanel.ml import split as sp
    rows = [(None if i % 5 == 0 else 2000 + i // 8, ["Q1", "Q4", None][i % 3], None if i % 7 == 0 else f"0001-{i % 9}", None if i % 4 == 0 else i % 2)
            for i in range(42)]
    df = spark.createDataFrame(rows, "fy int, fp string, adsh string, cls int")
    out = fo.temporal_folds(df, "fy", "fp", "adsh", 3).collect()
    assert sorted(r["pos"] for r in out) == list(range(42))
    assert [sum(r["test_fold"] == k for r in out) for k in (1, 2, 3)] == [10, 10, 10]
    s = sp.split_random(df, ["fy", "fp", "adsh"], 0.8, "cls").groupBy("cls", "split").count().collect()
    assert sum(r["count"] for r in s) == 42
    n = df.groupBy("cls").count().collect()
    assert {(r["cls"], r["count"]) for r in s if r["split"] == "train"} == {(r["cls"], round(r["count"] * 0.8)) for r in n}
    k = fo.kfold_column(df, ["fy", "fp", "adsh"], 5, "cls").groupBy("cls", "fold").count().collect()
    assert sum(r["count"] for r in k) == 42
    u = sp.undersample(df, "cls", ["fy", "fp", "adsh"]).groupBy("cls").count().collect()
    assert {r["cls"]: r["count"] for r in u} == dict.fromkeys([None, 0, 1], min(r["count"] for r in n))


def _check_folds(spark):
    rows = [(2000 + i // 8, ["Q1", "Q2", "Q3", "FY"][i % 4], i) for i in range(40)]
    df = spark.createDataFrame(rows, "fy int, fp string, adsh long")
    out = fo.temporal_folds(df, "fy", "fp", "adsh", 3).collect()
    order = sorted(rows, key=lambda r: (r[0], {"Q1": 1, "Q2": 2, "Q3": 3, "FY": 5}[r[1]], r[2]))
    pos = {r[2]: i for i, r in enumerate(order)}
    n, size = 40, 40 // 4
    for r in out:
        assert r["pos"] == pos[r["adsh"]]
        exp = (r["pos"] - (n - 3 * size)) // size + 1 if r["pos"] >= n - 3 * size else None
        assert r["test_fold"] == exp
