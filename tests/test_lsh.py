"""Projection index: recall against all rows, copies, ties, nulls, empty tables; SMOTE-NC on top of it."""

import numpy as np
import pyarrow as pa
import pytest

from finpanel.ml.balance import smote_nc
from finpanel.operators.knn import knn_edges
from finpanel.operators.lsh import knn_lsh, recall


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(3)
    rows = [(i, float(a), float(b), float(c), float(d), "xyz"[i % 3], "clash") for i, (a, b, c, d) in enumerate(rng.normal(size=(6000, 4)))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, d double, cat string, point string").repartition(4)


def test_recall_of_rows_divisible_by_50(cloud):
    cols = ["a", "b", "c", "d"]
    edges = knn_lsh(cloud, "id", cols, ["cat"], k=5, penalty=1.0, tables=12, block=64)
    got = recall(cloud, edges, "id", cols, ["cat"], k=5, penalty=1.0).first()
    assert got.n_queries == 120 and got.n_true == 600 and got.recall >= 0.9
    # 12 tables x 3 blocks of 64 of 6,000 rows at most
    assert 12 * 3 * 64 < 0.4 * 6000


def test_small_tables_are_exact(spark):
    rng = np.random.default_rng(4)
    pts, cats = rng.integers(0, 4, size=(90, 2)).astype(float), rng.integers(0, 2, 90)
    df = spark.createDataFrame([(i, float(p[0]), float(p[1]), str(c)) for i, (p, c) in enumerate(zip(pts, cats))], "id long, x double, y double, c string")
    got = {}
    for r in knn_lsh(df, "id", ["x", "y"], ["c"], k=4, penalty=1.5).collect():
        got.setdefault(r.src, []).append((r["rank"], r.dist, r.dst))
    for i in range(90):
        d = np.sqrt(((pts - pts[i]) ** 2).sum(1) + 1.5 ** 2 * (cats != cats[i]))
        d[i] = np.inf
        assert np.allclose([x[1] for x in sorted(got[i])], np.sort(d)[:4])
        assert all(np.isclose(d[x[2]], x[1]) for x in got[i]) and len({x[2] for x in got[i]}) == 4


def test_hot_copies_nulls_and_empty(spark):
    rows = [(i, 1.0, "a") for i in range(3000)] + [(3000 + i, float(i), "b") for i in range(40)] + [(9000, None, "a"), (9001, float("nan"), "a"), (9002, 1.0, None)]
    df = spark.createDataFrame(rows, "id long, x double, c string")
    out = knn_lsh(df, "id", ["x"], ["c"], k=3, block=32)
    rows = out.collect()
    assert {r.src for r in rows} == set(range(3040)) | {9002}
    assert all(r.dist == 0 and r.dst in (0, 1, 2, 3) for r in rows if r.src < 3000)
    assert len(rows) == 3 * 3041
    none = df.where("id < 0")
    assert knn_lsh(none, "id", ["x"], ["c"]).count() == 0 and recall(none, out, "id", ["x"], ["c"]).first().n_queries == 0
    vec = spark.createDataFrame([], "id long, v array<double>")
    assert knn_edges(vec, "id", "v").count() == 0


def test_smote_fills_every_class(spark):
    rng = np.random.default_rng(5)
    rows = [(i, float(rng.normal()), float(rng.normal()), "uvw"[i % 3], 0 if i < 60 else 1 if i < 85 else 2 if i < 96 else 3) for i in range(97)]
    rows += [(200, None, 0.0, "u", 1), (201, 0.0, 0.0, "u", None)]
    df = spark.createDataFrame(rows, "id long, x double, y double, c string, label int")
    got = smote_nc(df, "label", "id", ["x", "y"], ["c"], k=4).collect()
    n = {k: sum(r.label == k for r in got) for k in range(4)}
    assert n == {0: 0, 1: 60 - 26, 2: 60 - 11, 3: 59}
    at = {r[0]: r for r in rows}
    for r in got:
        a, b = at[r.source_id], at[r.near_id]
        assert a[4] == b[4] == r.label and r.c in "uvw"
        for v, k in ((r.x, 1), (r.y, 2)):
            assert min(a[k], b[k]) - 1e-12 <= v <= max(a[k], b[k]) + 1e-12
    again = smote_nc(df, "label", "id", ["x", "y"], ["c"], k=4).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_smote_neighbours_mind_categories(spark):
    """Equal numbers: a parent's neighbours share its category when enough of them do."""
    rows = [(i, 0.1 * (i % 7), "a" if i % 2 else "b", 1) for i in range(40)] + [(100 + i, float(i), "a", 0) for i in range(80)]
    df = spark.createDataFrame(rows, "id long, x double, c string, label int")
    for r in smote_nc(df, "label", "id", ["x"], ["c"], k=3).collect():
        assert (r.source_id % 2 == 1) == (r.c == "a")


def test_groups_deal_few_rows_twice_and_find_what_blocks_hold(spark):
    from finpanel.operators import lsh
    rng = np.random.default_rng(4)
    n, block, k = 3000, 20, 3
    v = rng.normal(size=(n, 2))
    rows = [(i, 0, i // block, v[i].tolist(), [i % 3]) for i in range(n)]
    placed = spark.createDataFrame(rows, "point long, table int, at long, v array<double>, codes array<long>").repartition(5)
    dealt = lsh._groups(placed, lsh.SPAN)
    assert n < dealt.count() <= n * (1 + 2 / lsh.SPAN)
    got = dealt.groupBy("table", "group").applyInArrow(lsh._nearby(pa.int64(), k, 0.5, lsh.SPAN), "point long, near array<long>, dist array<double>").collect()
    assert sorted(r.point for r in got) == list(range(n))
    for r in got:
        around = [j for j in range(n) if abs(j // block - r.point // block) <= 1 and j != r.point]
        d = {j: float(np.sqrt(((v[j] - v[r.point]) ** 2).sum() + 0.25 * (j % 3 != r.point % 3))) for j in around}
        assert np.allclose(sorted(r.dist), sorted(d.values())[:k]) and np.allclose([d[j] for j in r.near], r.dist)


def test_recall_query_asks_for_rows(spark):
    from finpanel.plans import registry
    registry.load_all()
    r = registry.QUERIES["knn_recall"](spark, "/root/testdata/sf0.001").first()
    assert r.n_queries > 0 and r.n_true > 0 and r.recall >= 0.9


def test_few_tables_deal_rows_few_times_and_find_them(spark):
    """Several strips and blocks: a row is dealt out tables x (1 + 2 / SPAN) times at most, the neighbours are found."""
    from pyspark.sql import functions as F
    from finpanel.operators import lsh
    assert lsh.TABLES * (1 + 2 / lsh.SPAN) < 5
    rng = np.random.default_rng(6)
    rows = [(50 * i if i % 40 == 0 else 50 * i + 1, *map(float, x), "xy"[i % 2]) for i, x in enumerate(rng.normal(size=(8000, 3)))]
    df = spark.createDataFrame(rows, "id long, a double, b double, d double, c string").repartition(4)
    edges = knn_lsh(df, "id", ["a", "b", "d"], ["c"], k=5, block=500)
    got = recall(df, edges, "id", ["a", "b", "d"], ["c"], k=5).first()
    assert got.n_queries == 200 and got.recall >= 0.9
    per = edges.groupBy("src").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("dst").alias("m"))
    assert per.count() == 8000 and per.where("n <> 5 or m <> 5").count() == 0


def test_leaves_pass_no_near_point_over(spark):
    """Far from a point, close to it in one column, alike in category or not: the leaf search finds what all pairs give."""
    from finpanel.operators import lsh
    rng = np.random.default_rng(7)
    n, k = 1500, 4
    v = rng.normal(size=(n, 3)) * [1, 0.01, 5] + (rng.random((n, 1)) < 0.02) * 50
    c = rng.integers(0, 3, n)
    t = pa.table({"point": pa.array(np.arange(n)), "table": pa.array(np.zeros(n, np.int32)), "at": pa.array(np.zeros(n, np.int64)),
                  "v": pa.array(v.tolist()), "codes": pa.array([[int(x)] for x in c]), "group": pa.array(np.zeros(n, np.int64))})
    got = lsh._nearby(pa.int64(), k, 0.7, lsh.SPAN)(t).to_pylist()
    assert sorted(r["point"] for r in got) == list(range(n))
    for r in got:
        d = np.sqrt(((v - v[r["point"]]) ** 2).sum(1) + 0.49 * (c != c[r["point"]]))
        d[r["point"]] = np.inf
        assert np.allclose(np.sort(r["dist"]), np.sort(d)[:k]) and np.allclose(d[r["near"]], r["dist"])
