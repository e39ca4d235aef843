"""Correlation, column classification, leakage checks and greedy redundancy pruning.

Pearson r is pairwise-complete (rows where both sides are present), NULL for constant or
too-short columns. All pairs are evaluated in one pass of masked matrix products over
centred columns; the shuffle carries one row per pair and partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finpanel import schema as S
from finpanel.operators.aggregates import coverage
from finpanel.session import cut_lineage


#: Relative standard deviation up to which a column counts as constant.
CONSTANT = 1e-10
#: Variance, relative to the squares about the column's mean, up to which the rows of a pair count as constant.
FLAT = 1e-13


def _cross_sums(cols: Sequence[str], means: Sequence[float]):
    """Per partition the sums over rows complete in (i, j), all pairs at once by matrix products."""
    import numpy as np
    import pandas as pd
    i, j = np.triu_indices(len(cols), 1)

    def sums(parts):
        total = None
        for pdf in parts:
            x = pdf.to_numpy(dtype=float, na_value=np.nan) - np.asarray(means)
            m = ~np.isnan(x)
            x, m = np.where(m, x, 0.0), m.astype(float)
            got = np.stack([m.T @ m, x.T @ m, m.T @ x, (x * x).T @ m, m.T @ (x * x), x.T @ x])
            total = got if total is None else total + got
        if total is not None:
            yield pd.DataFrame({"ia": i, "ib": j, **{n: t[i, j] for n, t in zip(("n", "x", "y", "xx", "yy", "xy"), total)}})

    return sums


def corr_pairs(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(a, b, n, r) for each requested column pair.

    The columns are landed once, centred on their means (one pass), then each partition reduces
    its rows to k x k matrices of sums over complete pairs (numpy products on Arrow batches);
    one row per pair and partition is shuffled."""
    return _pairs_of(stored(df, [c for p in pairs for c in p]), pairs)


def stored(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The columns alone, landed: several passes over them evaluate their lineage once."""
    return cut_lineage(df.select(*[f"`{c}`" for c in dict.fromkeys(cols)]), "profile")


def _pairs_of(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    cols = list(dict.fromkeys(c for p in pairs for c in p))
    typed = df.select(*[F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)).alias(c) for c in cols])
    moments = typed.agg(*[f(F.col(f"`{c}`")) for c in cols for f in (F.avg, F.stddev_pop)]).first()
    means, spreads = [m or 0.0 for m in moments[::2]], [s or 0.0 for s in moments[1::2]]
    sums = typed.mapInPandas(_cross_sums(cols, means),
                             "ia int, ib int, n double, x double, y double, xx double, yy double, xy double")
    at = {c: k for k, c in enumerate(cols)}
    # Rounding alone gives a constant column a spread.
    varies = [s > CONSTANT * abs(m) for m, s in zip(means, spreads)]
    flip = [(a, b, i, j, varies[i] and varies[j]) for a, b in pairs for i, j in [sorted((at[a], at[b]))]]
    wanted = F.broadcast(df.sparkSession.createDataFrame(
        flip, "a string, b string, ia int, ib int, varies boolean"))  # the caller's list
    agg = sums.groupBy("ia", "ib").agg(*[F.sum(c).alias(c) for c in ("n", "x", "y", "xx", "yy", "xy")])

    def spread(square, total):
        v = F.col(square) - F.try_divide(F.col(total) * F.col(total), F.col("n"))
        return F.when(v > F.col(square) * FLAT, v)

    r = ((F.col("xy") - F.try_divide(F.col("x") * F.col("y"), F.col("n")))
         / F.sqrt(spread("xx", "x") * spread("yy", "y")))
    return wanted.join(agg, ["ia", "ib"]).select("a", "b", F.col("n").cast("long").alias("n"), F.when((F.col("n") > 1) & F.col("varies"), r).alias("r"))


def corr_with_target(df: DataFrame, cols: Sequence[str], targets: Sequence[str], landed: bool = False) -> DataFrame:
    """(feature, target, n, r, abs_r) for every feature x target. ``landed``: ``df`` is a stored table already."""
    pairs = [(c, t) for t in targets for c in cols if c != t]
    out = (_pairs_of if landed else corr_pairs)(df, pairs)
    return out.select(F.col("a").alias("feature"), F.col("b").alias("target"), "n", "r",
                      F.abs("r").alias("abs_r"))


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Upper triangle (a before b in ``cols`` order) of |r|, with pair positions."""
    pos = {c: i for i, c in enumerate(cols)}
    pairs = [(cols[i], cols[j]) for j in range(len(cols)) for i in range(j)]
    out = corr_pairs(df, pairs)
    pmap = F.create_map(*[x for c, i in pos.items() for x in (F.lit(c), F.lit(i))])
    return out.select("a", "b", "n", "r", F.abs("r").alias("abs_r"),
                      pmap[F.col("a")].alias("ia"), pmap[F.col("b")].alias("ib"))


def persistence_corr(df: DataFrame, a: str, b: str) -> DataFrame:
    """corr(score_t, score_t+1) over rows with both."""
    return corr_pairs(df, [(a, b)]).select("n", "r")


def family_class(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, family) by name prefix — a table over the schema, no data scan."""
    cols = list(cols or df.columns)
    return df.sparkSession.createDataFrame([(c, S.family_of(c)) for c in cols], "column string, family string")


def keep_drop(df: DataFrame, cols: Sequence[str] | None = None,
              redundant: Sequence[str] = tuple(S.DROP_REDUNDANT),
              forbidden: Sequence[str] = tuple(S.FEATURES_A_FORBIDDEN),
              autoregressive: Sequence[str] = tuple(S.FEATURES_B_AUTOREGRESSIVE)) -> DataFrame:
    """(column, family, decision, category): raw XBRL and redundant columns dropped;
    kept columns classed META / A_PROHIBIDA / B_AUTOREGRESIVA / C_LIBRE."""
    fam = family_class(df, cols)
    decision = (F.when(F.col("family") == "xbrl_raw", "DROP_XBRL_RAW")
                 .when(F.col("column").isin(list(redundant)), "DROP_REDUNDANTE").otherwise("KEEP"))
    cat = (F.when(F.col("decision") != "KEEP", "-")
            .when(F.col("family") == "meta", "META")
            .when(F.col("column").isin(list(forbidden)), "A_PROHIBIDA")
            .when(F.col("column").isin(list(autoregressive)), "B_AUTOREGRESIVA")
            .otherwise("C_LIBRE"))
    return fam.withColumn("decision", decision).withColumn("category", cat)


def leakage_check(df: DataFrame, features: Sequence[str], target: str,
                  forbidden: Sequence[str] = tuple(S.FEATURES_A_FORBIDDEN),
                  class_c: Sequence[str] | None = None, max_r: float = S.LEAKAGE_MAX_R,
                  raise_on_fail: bool = False) -> DataFrame:
    """Rows (check, feature, value, ok): forbidden names among the features, and class-C
    features whose |r| with the target exceeds ``max_r``."""
    spark = df.sparkSession
    bad_names = [f for f in features if f in set(forbidden)]
    names = spark.createDataFrame([("forbidden_name", f, None, False) for f in bad_names] or
                                  [("forbidden_name", None, None, True)],
                                  "check string, feature string, value double, ok boolean")
    cc = [c for c in (class_c if class_c is not None else features) if c not in set(forbidden) and c != target]
    cr = corr_with_target(df, cc, [target])
    corr_rows = cr.select(F.lit("class_c_corr").alias("check"), "feature", F.col("abs_r").alias("value"),
                          F.coalesce(F.col("abs_r") <= max_r, F.lit(True)).alias("ok"))
    out = names.unionByName(corr_rows)
    if raise_on_fail and (bad_names or corr_rows.where(~F.col("ok")).limit(1).count() > 0):
        raise ValueError("leakage check failed")
    return out


def prune_corr(df: DataFrame, cols: Sequence[str], target: str, max_r: float = S.PRUNE_CORR_MAX,
               prefix: str = "_REDUNDANTE_") -> tuple[DataFrame, list[str]]:
    """Greedy redundancy pruning.

    Pairs with |r| > max_r are visited column-major over the upper triangle (the order
    of ``cols``); a pair is skipped once either side is already dropped; otherwise the
    lower-coverage side is dropped, ties broken by lower |r| with the target (equal ->
    the second). All correlations come from one pass, the coverage of the columns in
    question from another; only the <= k^2/2 pair statistics reach the driver for the sequential greedy walk."""
    held = stored(df, [*cols, target])
    stats = _pairs_of(held, [(a, b) for k, b in enumerate(cols) for a in cols[:k]] + [(c, target) for c in cols if c != target]).collect()
    pos = {c: k for k, c in enumerate(cols)}
    tr = {s["a"]: abs(s["r"]) for s in stats if s["b"] == target and s["r"] is not None}
    pairs = sorted(((pos[s["a"]], pos[s["b"]], s["a"], s["b"]) for s in stats
                    if s["a"] in pos and s["b"] in pos and s["r"] is not None and abs(s["r"]) > max_r
                    and pos[s["a"]] < pos[s["b"]]), key=lambda t: (t[1], t[0]))
    if not pairs:
        return df, []
    involved = sorted({p for _, _, a, b in pairs for p in (a, b)})
    cov = {r["column"]: r["pct_coverage"] for r in coverage(held, involved).collect()}
    dropped: list[str] = []
    for _, _, a, b in pairs:
        if a in dropped or b in dropped:
            continue
        if cov[a] < cov[b]:
            dropped.append(a)
        elif cov[b] < cov[a]:
            dropped.append(b)
        else:
            ra, rb = tr.get(a), tr.get(b)
            dropped.append(a if (ra is not None and rb is not None and ra < rb) else b)
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in dropped}), dropped


def family_summary(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """Per family: columns, mean coverage %, mean and max |r| with the target."""
    df = stored(df, [*cols, target])
    cov = coverage(df, cols).select("column", "pct_coverage")
    cr = corr_with_target(df, cols, [target], landed=True).select(F.col("feature").alias("column"), "abs_r")
    fam = family_class(df, cols)
    j = fam.join(cov, "column").join(cr, "column", "left")
    return j.groupBy("family").agg(F.count(F.lit(1)).alias("n_cols"),
                                   F.avg("pct_coverage").alias("coverage_avg"),
                                   F.avg("abs_r").alias("abs_r_avg"), F.max("abs_r").alias("abs_r_max"))
