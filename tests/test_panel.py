"""Panel windows and dedups."""

from pyspark.sql import functions as F

from finpanel.operators import panel as pn


def test_dedup_latest_null_filed_wins_and_tie(spark):
    df = spark.createDataFrame(
        [("a1", 1, 2020, "Q1", 20200501), ("a2", 1, 2020, "Q1", None), ("b1", 2, 2020, "Q1", 20200501),
         ("b2", 2, 2020, "Q1", 20200501), ("c1", 3, 2020, "Q1", 20200401), ("c2", 3, 2020, "Q1", 20200601)],
        "adsh string, cik int, fy int, fp string, filed int")
    out = {r["cik"]: r["adsh"] for r in pn.dedup_latest(df, ["cik", "fy", "fp"]).collect()}
    assert out == {1: "a2", 2: "b2", 3: "c2"}


def test_dedup_longest(spark):
    df = spark.createDataFrame(
        [("x", "Rev", 1, "v1", 10.0), ("x", "Rev", 4, "v2", 40.0), ("x", "Rev", 4, "v1", 41.0),
         ("x", "Assets", 0, "v1", 5.0)], "adsh string, tag string, qtrs int, version string, value double")
    out = {r["tag"]: (r["qtrs"], r["value"]) for r in pn.dedup_longest(df).collect()}
    assert out == {"Rev": (4, 41.0), "Assets": (0, 5.0)}


def test_lag_null_entity_and_pct(spark):
    df = spark.createDataFrame([(1, 1, 10.0), (1, 2, 0.0), (1, 3, 5.0), (None, 1, 3.0), (None, 2, 4.0)],
                               "cik int, t int, x double")
    out = pn.pct_delta(pn.lag1(df, "cik", ["t"], ["x"]), "cik", ["t"], ["x"]).orderBy("cik", "t").collect()
    got = [(r["cik"], r["t"], r["x_prev"], r["x_pct"]) for r in out]
    assert got[:2] == [(None, 1, None, None), (None, 2, None, None)]
    assert got[2:] == [(1, 1, None, None), (1, 2, 10.0, -1.0), (1, 3, 0.0, None)]


def test_ffill_limit_two(spark):
    rows = [(1, t, v) for t, v in enumerate([1.0, None, None, None, 2.0, None])]
    df = spark.createDataFrame(rows, "e int, t int, x double")
    out = [r["x"] for r in pn.ffill_limit(df, "e", ["t"], ["x"], 2).orderBy("t").collect()]
    assert out == [1.0, 1.0, 1.0, None, 2.0, 2.0]


def test_accel(spark):
    df = spark.createDataFrame([(1, t, float(v)) for t, v in enumerate([1, 4, 9, 16])], "e int, t int, x double")
    out = [r["x_accel"] for r in pn.accel(df, "e", ["t"], "x").orderBy("t").collect()]
    assert out == [None, None, 2.0, 2.0]


def test_rows_without_entity_share_no_task(spark):
    """A third of the rows has no entity: their lags are NULL and no partition holds them all."""
    rows = [(None if i % 3 == 0 else i % 7, i, float(i)) for i in range(3000)]
    df = spark.createDataFrame(rows, "e int, t int, x double")
    out = pn.ffill_limit(pn.lag1(df, "e", ["t"], ["x"]), "e", ["t"], ["x"], 2)
    got = out.withColumn("part", F.spark_partition_id()).collect()
    none = [r for r in got if r.e is None]
    assert len(got) == 3000 and len(none) == 1000 and all(r.x_prev is None for r in none)
    held = [r for r in got if r.e == 4]
    assert all(r.x_prev is not None for r in sorted(held, key=lambda r: r.t)[1:])
    w = pn.spread_window(df, "e", ["t"])
    plan = df.select(F.lag("x").over(w))._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64" in plan and plan.count("Window [") == 1
