"""Model metrics as aggregates (each a single small result row or table).

Regression: RMSE, MAE, R2, MAPE (y > 0.001), predictions clipped to a range first.
Binary: accuracy, precision, recall, F1 (0 when undefined), ROC-AUC by average ranks
(Mann-Whitney, ties averaged — equal to the trapezoid ROC area), average precision
with tied scores grouped. Multiclass: accuracy, macro/weighted F1, macro precision and
recall, one-vs-rest macro AUC. Ranks come from ``value_prefix``: no global sort in one
task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finpanel.functions.scalar import clip
from finpanel.ml.ranks import value_prefix


def eval_regression(df: DataFrame, y: str, yhat: str | Column, clip_range: tuple[float, float] | None = (0.0, 1.0),
                    mape_floor: float = 0.001) -> DataFrame:
    p = F.col(yhat) if isinstance(yhat, str) else yhat
    if clip_range is not None:
        p = clip(p, *clip_range)
    d = df.select(F.col(y).cast("double").alias("y"), p.cast("double").alias("p")).where(
        F.col("y").isNotNull() & F.col("p").isNotNull())
    err = F.col("y") - F.col("p")
    one = d.agg(F.count(F.lit(1)).alias("n"), F.avg(err * err).alias("mse"), F.avg(F.abs(err)).alias("mae"),
                F.sum(err * err).alias("ss_res"), F.var_pop("y").alias("var_y"),
                F.avg(F.when(F.col("y") > mape_floor, F.abs(err) / F.abs(F.col("y")))).alias("mape"))
    return one.select("n", F.sqrt("mse").alias("rmse"), "mae",
                      (F.lit(1.0) - F.try_divide(F.col("ss_res"), F.col("var_y") * F.col("n"))).alias("r2"), "mape")


def _confusion_counts(df: DataFrame, y: str, yhat: str) -> DataFrame:
    yy, pp = F.col(y).cast("int"), F.col(yhat).cast("int")
    return df.agg(F.count_if((yy == 1) & (pp == 1)).alias("tp"), F.count_if((yy == 0) & (pp == 1)).alias("fp"),
                  F.count_if((yy == 1) & (pp == 0)).alias("fn"), F.count_if((yy == 0) & (pp == 0)).alias("tn"))


def _zdiv(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def roc_auc(df: DataFrame, y: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Rank AUC per group: (sum of positive average ranks - P(P+1)/2) / (P N)."""
    yy = F.col(y).cast("int")
    d = df.where(F.col(y).isNotNull() & F.col(score).isNotNull())
    vp = value_prefix(d, score, {"pos": (yy == 1).cast("long"), "all": F.lit(1).cast("long")}, by)
    avg_rank = F.col("all_below") + (F.col("all") + 1) / 2.0
    s = vp.groupBy(*by).agg(F.sum(F.col("pos") * avg_rank).alias("rsum"), F.first("pos_total").alias("P"),
                            F.first("all_total").alias("T"))
    pp, tt = F.col("P").cast("double"), F.col("T").cast("double")
    return s.select(*by, F.try_divide(F.col("rsum") - pp * (pp + 1) / 2.0, pp * (tt - pp)).alias("auc"))


def pr_auc(df: DataFrame, y: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Average precision over distinct thresholds (descending) and the prevalence."""
    yy = F.col(y).cast("int")
    d = df.where(F.col(y).isNotNull() & F.col(score).isNotNull())
    vp = value_prefix(d, score, {"pos": (yy == 1).cast("long"), "all": F.lit(1).cast("long")}, by)
    # rows with score >= this value: total - below
    tp = F.col("pos_total") - F.col("pos_below")
    k = F.col("all_total") - F.col("all_below")
    contrib = (F.col("pos") / F.col("pos_total")) * (tp / k)
    return vp.groupBy(*by).agg(F.sum(F.when(F.col("pos_total") > 0, contrib)).alias("average_precision"),
                               (F.first("pos_total") / F.first("all_total")).alias("prevalence"))


def eval_binary(df: DataFrame, y: str, yhat: str, prob: str | None = None) -> DataFrame:
    """One metric row. The (y, yhat, prob) projection is persisted for the two passes
    (confusion counts, rank AUC); both results are single rows."""
    src = df.select(*[c for c in (y, yhat, prob) if c]).persist()
    try:
        c = _confusion_counts(src, y, yhat)
        n = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
        prec, rec = _zdiv(F.col("tp"), F.col("tp") + F.col("fp")), _zdiv(F.col("tp"), F.col("tp") + F.col("fn"))
        row = c.select(_zdiv(F.col("tp") + F.col("tn"), n).alias("accuracy"), prec.alias("precision"),
                       rec.alias("recall"),
                       _zdiv(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1")).first()
        auc = roc_auc(src, y, prob).first()["auc"] if prob else None
    finally:
        src.unpersist()
    vals = [row["accuracy"], row["precision"], row["recall"], row["f1"]]
    schema = "accuracy double, precision double, recall double, f1 double"
    if prob:
        return df.sparkSession.createDataFrame([(*vals, auc)], schema + ", roc_auc double")
    return df.sparkSession.createDataFrame([tuple(vals)], schema)


def per_class(df: DataFrame, y: str, yhat: str, classes: Sequence[int]) -> DataFrame:
    """(class, support, precision, recall, f1) with zero_division = 0."""
    yy, pp = F.col(y).cast("int"), F.col(yhat).cast("int")
    aggs = []
    for k in classes:
        aggs += [F.count_if((yy == k) & (pp == k)).alias(f"tp_{k}"), F.count_if(pp == k).alias(f"pp_{k}"),
                 F.count_if(yy == k).alias(f"sup_{k}")]
    one = df.agg(*aggs)
    rows = one.select(F.explode(F.array(*[F.struct(
        F.lit(k).alias("cls"), F.col(f"sup_{k}").alias("support"),
        _zdiv(F.col(f"tp_{k}"), F.col(f"pp_{k}")).alias("precision"),
        _zdiv(F.col(f"tp_{k}"), F.col(f"sup_{k}")).alias("recall"),
        _zdiv(2 * F.col(f"tp_{k}"), F.col(f"pp_{k}") + F.col(f"sup_{k}")).alias("f1")) for k in classes])).alias("s"))
    return rows.select("s.*")


def eval_multiclass(df: DataFrame, y: str, yhat: str, classes: Sequence[int] = (0, 1, 2),
                    probs: Sequence[str] | None = None) -> DataFrame:
    src = df.select(y, yhat, *(probs or [])).persist()
    try:
        return _eval_multiclass(src, df.sparkSession, y, yhat, classes, probs)
    finally:
        src.unpersist()


def _eval_multiclass(df: DataFrame, spark, y: str, yhat: str, classes: Sequence[int],
                     probs: Sequence[str] | None) -> DataFrame:
    pc = per_class(df, y, yhat, classes)
    acc = df.agg(_zdiv(F.count_if(F.col(y).cast("int") == F.col(yhat).cast("int")), F.count(F.lit(1)))
                 .alias("accuracy"))
    s = pc.agg(F.avg("f1").alias("f1_macro"),
               _zdiv(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("f1_weighted"),
               F.avg("precision").alias("precision_macro"), F.avg("recall").alias("recall_macro"))
    a, m = acc.first(), s.first()  # two one-row aggregates
    out = spark.createDataFrame([(a["accuracy"], m["f1_macro"], m["f1_weighted"], m["precision_macro"],
                                            m["recall_macro"])],
                                          "accuracy double, f1_macro double, f1_weighted double, "
                                          "precision_macro double, recall_macro double")
    if probs:
        # one-vs-rest in ONE pass: each row expands to (class, is_class, its score)
        long = df.select(F.inline(F.array(*[F.struct(
            F.lit(k).alias("_k"), (F.col(y).cast("int") == k).cast("int").alias("_yk"),
            F.col(pcol).cast("double").alias("_pk")) for k, pcol in zip(classes, probs)])))
        got = {r["_k"]: r["auc"] for r in roc_auc(long, "_yk", "_pk", by=["_k"]).collect()}
        aucs = [got.get(k) for k in classes]
        vals = [v for v in aucs if v is not None]
        out = out.withColumn("roc_auc_ovr", F.lit(sum(vals) / len(vals) if len(vals) == len(aucs) else None)
                             .cast("double"))
    return out


def confusion(df: DataFrame, y: str, yhat: str, classes: Sequence[int], normalize: bool = False) -> DataFrame:
    """Rows = true class, one column per predicted class; optionally row-normalised."""
    t = df.where(F.col(y).isNotNull()).groupBy(F.col(y).cast("int").alias("y")).pivot(
        yhat, list(classes)).agg(F.count(F.lit(1)))
    names = [str(k) for k in classes]
    t = t.select("y", *[F.coalesce(F.col(f"`{n}`"), F.lit(0)).alias(f"pred_{n}") for n in names])
    if normalize:
        tot = sum((F.col(f"pred_{n}") for n in names), F.lit(0))
        t = t.select("y", *[_zdiv(F.col(f"pred_{n}"), tot).alias(f"pred_{n}") for n in names])
    return t


def baseline_persistence(df: DataFrame, y: str, score: str, delta: str | None = None) -> DataFrame:
    """Persistence (next = now) and persistence + last change, both clipped to [0, 1]."""
    a = eval_regression(df, y, score).withColumn("baseline", F.lit("persistence"))
    if delta is None:
        return a
    b = eval_regression(df, y, F.col(score) + F.col(delta)).withColumn("baseline", F.lit("persistence_delta"))
    return a.unionByName(b)


def baseline_gain(model: DataFrame, base: DataFrame, threshold: float = 0.05) -> DataFrame:
    """% RMSE gain and R2 gain of a model over a baseline; verdict at 5 %."""
    m, rows = model.first(), base.collect()  # one metric row each
    spark = model.sparkSession
    out = []
    for b in rows:
        gain = (b["rmse"] - m["rmse"]) / b["rmse"] * 100 if b["rmse"] else None
        verdict = ("value" if m["rmse"] < b["rmse"] * (1 - threshold) else
                   "narrow" if m["rmse"] < b["rmse"] else "no_gain")
        out.append((b["baseline"], gain, m["r2"] - b["r2"] if m["r2"] is not None and b["r2"] is not None else None,
                    verdict))
    return spark.createDataFrame(out, "baseline string, rmse_gain_pct double, r2_gain double, verdict string")
