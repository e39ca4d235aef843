"""k-NN edges against brute force."""

import numpy as np

from finpanel.operators.knn import knn_edges
from finpanel.operators.profile import prune_corr


def test_knn_matches_brute_force(spark):
    rng = np.random.default_rng(11)
    pts = np.concatenate([rng.normal(0, 1, (60, 4)), rng.normal(5, 1, (60, 4))])
    df = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(pts)], "id long, v array<double>")
    got = {(r["src"], r["rank"]): r["dst"] for r in knn_edges(df, "id", "v", k=3, buckets=6).collect()}
    for i, p in enumerate(pts):
        d = np.sqrt(((pts - p) ** 2).sum(axis=1))
        d[i] = np.inf
        order = sorted(range(len(pts)), key=lambda j: (d[j], j))[:3]
        assert [got[(i, r)] for r in (1, 2, 3)] == order


def test_knn_deals_a_row_once_per_block(spark):
    rng = np.random.default_rng(12)
    pts = rng.normal(size=(400, 24))
    pts[200:260] = pts[7]  # copies: equal distances go by id
    rows = [(i, i % 2, [float(x) for x in p]) for i, p in enumerate(pts)] + [(900, 0, None), (901, 0, [1.0, 2.0]), (902, 1, [float("nan")] * 24)]
    out = knn_edges(spark.createDataFrame(rows, "id long, g int, v array<double>"), "id", "v", k=4, by=["g"])
    got = {}
    for r in out.collect():
        got.setdefault(r.src, {})[r["rank"]] = (r.dst, r.dist)
    assert len(got) == 400
    for i, p in enumerate(pts):
        d = np.sqrt(((pts - p) ** 2).sum(axis=1))
        order = sorted((j for j in range(400) if j != i and j % 2 == i % 2), key=lambda j: (round(d[j], 9), j))[:4]
        assert [got[i][r][0] for r in (1, 2, 3, 4)] == order and np.allclose([got[i][r][1] for r in (1, 2, 3, 4)], d[order])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "Join" not in plan


def test_prune_corr_greedy(spark):
    rng = np.random.default_rng(5)
    a = rng.normal(size=200)
    rows = [(float(x), float(2 * x + 1e-3 * rng.normal()), float(rng.normal()), float(x) if i % 4 else None, float(x))
            for i, x in enumerate(a)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, y double")
    _, dropped = prune_corr(df, ["a", "b", "c", "d"], "y", 0.95)
    # (a,b) equal coverage -> drop the one with lower |r| with y (b); (a,d) -> d has lower coverage
    assert sorted(dropped) == ["b", "d"]
