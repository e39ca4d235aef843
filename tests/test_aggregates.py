"""Exact distributed quantiles against numpy, grouped and with a hot value."""

import numpy as np
from pyspark.sql import functions as F

from finpanel.operators import aggregates as ag


def test_quantiles_match_numpy_with_ties_and_hot_value(spark):
    rng = np.random.default_rng(7)
    vals = np.concatenate([rng.normal(size=500), np.full(400, 3.25), rng.integers(0, 5, 300)]).astype(float)
    rows = [(int(i % 3), float(v)) for i, v in enumerate(vals)] + [(0, None)]
    df = spark.createDataFrame(rows, "g int, x double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0]
    got = {r["p"]: r["value"] for r in ag.quantiles(df, ["x"], probs).collect()}
    for p in probs:
        assert abs(got[p] - np.percentile(vals, p * 100)) < 1e-9
    grp = ag.quantiles(df, ["x"], [0.5], by=["g"]).collect()
    for r in grp:
        sub = np.array([v for i, v in enumerate(vals) if i % 3 == r["g"]])
        assert abs(r["value"] - np.median(sub)) < 1e-9


def test_coverage_and_value_counts(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (3, "a"), (None, "b")], "x int, s string")
    cov = {r["column"]: r["pct_coverage"] for r in ag.coverage(df, ["x", "s"]).collect()}
    assert cov == {"x": 75.0, "s": 75.0}
    vc = {r["s"]: (r["n"], r["share"]) for r in ag.value_counts(df, "s").collect()}
    assert vc["a"] == (2, 0.5) and vc[None] == (1, 0.25)


def test_pivot_wide_keeps_all_tags(spark):
    df = spark.createDataFrame([("f1", "A", 1.0, 0), ("f1", "B", 2.0, 4), ("f2", "A", 3.0, 1)],
                               "adsh string, tag string, value double, qtrs int")
    out = ag.pivot_wide(df, "adsh", "tag", ["A", "B", "C"]).orderBy("adsh").collect()
    assert out[0].asDict() == {"adsh": "f1", "A": 1.0, "B": 2.0, "C": None, "A_qtrs": 0, "B_qtrs": 4, "C_qtrs": None}


def test_pivot_wide_narrow_and_wide_agree(spark, monkeypatch):
    """Few columns are grouped by id alone; nulls, unlisted tags and ids without a listed tag as in Spark's pivot."""
    rows = [(f"f{k % 40}", None if k % 11 == 0 else "ABCZ"[k % 4], None if k % 7 == 0 else 1.0 * (k % 40), None if k % 5 == 0 else k % 40)
            for k in range(160)] + [("only z", "Z", 1.0, 1), (None, "A", 5.0, None), ("empty", None, 1.0, 2)]
    df = spark.createDataFrame(rows, "adsh string, tag string, value double, qtrs int")
    for dur in ("qtrs", None):
        monkeypatch.setattr(ag, "NARROW_PIVOT", 32)
        narrow = ag.pivot_wide(df, "adsh", "tag", ["A", "B", "C", "x y.z"], dur=dur)
        # One table of ids in a task, none of (id, tag).
        assert narrow._jdf.queryExecution().sparkPlan().toString().count("HashAggregate") == 2
        monkeypatch.setattr(ag, "NARROW_PIVOT", 0)
        wide = ag.pivot_wide(df, "adsh", "tag", ["A", "B", "C", "x y.z"], dur=dur)
        assert narrow.dtypes == wide.dtypes
        assert sorted(narrow.collect(), key=repr) == sorted(wide.collect(), key=repr)


def test_missing_by_group_drops_null_keys(spark):
    df = spark.createDataFrame([(1, None), (1, 1.0), (2, 1.0), (2, 1.0), (None, None)], "g int, x double")
    r = ag.missing_by_group(df, "g", ["x"]).collect()[0]
    assert abs(r["std_missing"] - np.std([50.0, 0.0], ddof=1)) < 1e-9
    assert r["pct_coverage"] == 60.0 and r["structural"] is True
    assert ag.grouped_medians(df, ["g"], ["x"]).where(F.col("g") == 2).first()["x_median"] == 1.0


def test_quantiles_beyond_the_sketch_and_null_groups(spark):
    """More rows than the sketch keeps apart; a group key of NULL is a group."""
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.lognormal(size=60_000), np.full(30_000, 0.5)])
    g = [None if k % 3 == 0 else int(k % 3) for k in range(len(x))]
    df = spark.createDataFrame(list(zip(g, x.tolist())), "g int, x double")
    for r in ag.quantiles(df, ["x"], [0.01, 0.5, 0.99], by=["g"]).collect():
        part = x[[k for k in range(len(x)) if g[k] == r["g"]]]
        assert abs(r["value"] - np.percentile(part, r["p"] * 100)) < 1e-12
    assert ag.quantiles(df, ["x"], [0.5], by=["g"]).count() == 3


def test_correlations_as_numpy(spark):
    from finpanel.operators import profile as pf
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 4)) * [1, 1e6, 1e-3, 1] + [0, 1e9, 5, 0]
    x[:, 1] += x[:, 0] * 5e5
    rows = [(*[None if rng.random() < 0.1 else float(v) for v in r], 7.25) for r in x]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, k double").repartition(3)
    for r in pf.corr_matrix(df, list("abcdk")).collect():
        pair = [(p["abcdk".index(r["a"])], p["abcdk".index(r["b"])]) for p in rows]
        pair = np.array([p for p in pair if None not in p])
        assert r["n"] == len(pair)
        if "k" in (r["a"], r["b"]):
            assert r["r"] is None
        else:
            assert abs(r["r"] - np.corrcoef(pair.T)[0, 1]) < 1e-9


def _heavy(spark):
    rng = np.random.default_rng(9)
    vals = {"u": rng.lognormal(0, 3, 4000), "hot": np.concatenate([np.full(1900, 1.0), rng.uniform(1, 2, 150), np.full(1950, 2.0)])}
    rows = [(int(i % 2), float(a), float(b)) for i, (a, b) in enumerate(zip(vals["u"], vals["hot"]))]
    return vals, spark.createDataFrame(rows, "g int, u double, hot double").repartition(5)


def test_quantiles_narrow_brackets_until_they_fit(spark, monkeypatch):
    """A bracket of at most three rows: the grid passes do the work, heavy ends included."""
    vals, df = _heavy(spark)
    sizes = []
    plain = ag._selected
    monkeypatch.setattr(ag, "BRACKET_ROWS", 3)
    monkeypatch.setattr(ag, "GRID", 20)
    monkeypatch.setattr(ag, "_selected", lambda placed, G: (sizes.append(placed.where("side = 0").groupBy(*G, "p").agg(F.count_distinct("x").alias("d")).agg(F.max("d")).first()[0]), plain(placed, G))[1])
    probs = [0.0, 0.01, 0.4801, 0.5, 0.99, 1.0]
    got = {(r["column"], r["p"]): r["value"] for r in ag.quantiles(df, ["u", "hot"], probs).collect()}
    for c, x in vals.items():
        for p in probs:
            assert abs(got[c, p] - np.percentile(x, 100 * p)) < 1e-9
    assert max(sizes) <= 12  # counted one by one: the bound, up to the grid's rank error


def test_quantiles_widen_a_wrong_bracket(spark, monkeypatch):
    """Brackets that lie beside the wanted rank on purpose: below, above, and too small."""
    vals, df = _heavy(spark)
    plain = ag._sketched
    for lo, hi in ((-5.0, -4.0), (1e9, 2e9), (0.001, 0.002), (1.5, 1.5)):
        monkeypatch.setattr(ag, "_sketched", lambda *a, lo=lo, hi=hi: plain(*a).withColumns({"lo": F.lit(lo), "hi": F.lit(hi)}))
        got = {(r["column"], r["p"]): r["value"] for r in ag.quantiles(df, ["u", "hot"], [0.05, 0.5, 0.77]).collect()}
        for c, x in vals.items():
            for p in (0.05, 0.5, 0.77):
                assert abs(got[c, p] - np.percentile(x, 100 * p)) < 1e-9


def test_quantiles_read_their_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    df = spark.range(500).selectExpr("cast(id as double) AS x").mapInArrow(count, "x double")
    assert [r["value"] for r in ag.quantiles(df, ["x"], [0.5]).collect()] == [249.5]
    assert seen.value == 500
