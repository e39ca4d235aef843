"""2.12 splits, scaling, balancing, folds, metrics and baselines (oracle-checked) and the
Spark ML fits / searches (rows-only)."""

from __future__ import annotations

from pyspark.sql import functions as F

from finpanel.ml import folds as fo
from finpanel.ml import metrics as me
from finpanel.ml import models as mo
from finpanel.ml import search as se
from finpanel.ml import split as sp
from finpanel.operators.panel import lag_expr
from finpanel.operators.prepare import impute_backstop
from finpanel.operators.targets import score_class
from finpanel.operators.topk import model_ranking, topk_importance
from finpanel.plans.catalog_panel import RISK_SQL, risk_panel
from finpanel.session import cut_lineage
from finpanel.plans.registry import register, rounded

M_SQL = RISK_SQL + """,
M AS (SELECT *, risk - LAG(risk) OVER (PARTITION BY cik ORDER BY fy, fp_ord) AS risk_delta,
      CASE WHEN risk >= 0.5 THEN 1 ELSE 0 END AS pred_distress,
      CASE WHEN risk < 0.35 THEN 0 WHEN risk < 0.65 THEN 1 WHEN risk IS NOT NULL THEN 2 END AS pred_class,
      1 - risk AS p0, 1 - ABS(risk - 0.5) * 2 AS p1, risk AS p2,
      CASE WHEN target_score_next IS NULL THEN NULL WHEN target_score_next >= 0.5 THEN 1 ELSE 0 END AS target_distress_next,
      CASE WHEN target_score_next < 0.35 THEN 0 WHEN target_score_next < 0.65 THEN 1
           WHEN target_score_next IS NOT NULL THEN 2 END AS target_class_next FROM W)"""
CUT = 1998


def m_view(spark, d):
    from finpanel.plans.catalog_panel import E, O
    p = risk_panel(spark, d)
    return p.withColumns({
        "risk_delta": F.col("risk") - lag_expr(E, O, "risk"),
        "pred_distress": F.when(F.col("risk").isNotNull(), (F.col("risk") >= 0.5).cast("int")).otherwise(0),
        "pred_class": score_class("risk"),
        "p0": 1 - F.col("risk"), "p1": 1 - F.abs(F.col("risk") - 0.5) * 2, "p2": F.col("risk")})


REG_SQL = """SELECT COUNT(*) AS n, ROUND(SQRT(AVG((y - p) * (y - p))), 6) AS rmse, ROUND(AVG(ABS(y - p)), 6) AS mae,
  ROUND(1 - SUM((y - p) * (y - p)) / NULLIF(VAR_POP(y) * COUNT(*), 0), 6) AS r2,
  ROUND(AVG(CASE WHEN y > 0.001 THEN ABS(y - p) / ABS(y) END), 6) AS mape FROM"""


def _reg_src(pred):
    return (f"(SELECT target_score_next AS y, CASE WHEN ({pred}) IS NULL THEN NULL ELSE GREATEST(0.0, LEAST(1.0, {pred})) END AS p "
            f"FROM M WHERE target_score_next IS NOT NULL AND ({pred}) IS NOT NULL)")


@register("eval_regression", M_SQL + REG_SQL + _reg_src("risk"))
def q_eval_regression(spark, d):
    return rounded(me.eval_regression(m_view(spark, d), "target_score_next", "risk"))


BASE_SQL = M_SQL + f""", B AS ({REG_SQL} {_reg_src('risk')}), BD AS ({REG_SQL} {_reg_src('risk + risk_delta')})"""


@register("baseline_persistence", BASE_SQL + """
SELECT *, 'persistence' AS baseline FROM B UNION ALL SELECT *, 'persistence_delta' FROM BD""")
def q_baseline_persistence(spark, d):
    return rounded(me.baseline_persistence(m_view(spark, d), "target_score_next", "risk", "risk_delta"))


@register("baseline_gain", BASE_SQL + """
SELECT 'persistence' AS baseline, ROUND((B.rmse - BD.rmse) / B.rmse * 100, 4) AS rmse_gain_pct,
  ROUND(BD.r2 - B.r2, 4) AS r2_gain,
  CASE WHEN BD.rmse < B.rmse * 0.95 THEN 'value' WHEN BD.rmse < B.rmse THEN 'narrow' ELSE 'no_gain' END AS verdict
FROM B, BD""")
def q_baseline_gain(spark, d):
    m = m_view(spark, d)
    model = me.eval_regression(m, "target_score_next", F.col("risk") + F.col("risk_delta"))
    base = me.eval_regression(m, "target_score_next", "risk").withColumn("baseline", F.lit("persistence"))
    out = me.baseline_gain(rounded(model), rounded(base))
    return rounded(out, 4)


AUC_SQL = """(SELECT SUM(CASE WHEN yb = 1 THEN rk END) AS rsum, SUM(yb) AS P, COUNT(*) AS T FROM (
  SELECT yb, RANK() OVER (ORDER BY s) + (COUNT(*) OVER (PARTITION BY s) - 1) / 2.0 AS rk
  FROM (SELECT {y} AS yb, {s} AS s FROM M WHERE {y} IS NOT NULL AND {s} IS NOT NULL)))"""


def _auc(y, s):
    return (f"(SELECT (rsum - P * (P + 1) / 2.0) / NULLIF(P * (T - P), 0) FROM "
            + AUC_SQL.format(y=y, s=s) + ")")


@register("eval_binary", M_SQL + f""", C AS (SELECT
  COUNT(*) FILTER (WHERE target_distress_next = 1 AND pred_distress = 1) AS tp,
  COUNT(*) FILTER (WHERE target_distress_next = 0 AND pred_distress = 1) AS fp,
  COUNT(*) FILTER (WHERE target_distress_next = 1 AND pred_distress = 0) AS fn,
  COUNT(*) FILTER (WHERE target_distress_next = 0 AND pred_distress = 0) AS tn FROM M)
SELECT ROUND(COALESCE((tp + tn) / NULLIF(tp + fp + fn + tn, 0), 0), 6) AS accuracy,
  ROUND(COALESCE(tp / NULLIF(tp + fp, 0), 0), 6) AS precision, ROUND(COALESCE(tp / NULLIF(tp + fn, 0), 0), 6) AS recall,
  ROUND(COALESCE(2 * tp / NULLIF(2 * tp + fp + fn, 0), 0), 6) AS f1,
  ROUND({_auc('target_distress_next', 'risk')}, 6) AS roc_auc FROM C""")
def q_eval_binary(spark, d):
    return rounded(me.eval_binary(m_view(spark, d), "target_distress_next", "pred_distress", "risk"))


@register("roc_auc", M_SQL + f"SELECT fp, ROUND(auc, 6) AS auc FROM (" + " UNION ALL ".join(
    f"SELECT '{fp}' AS fp, (SELECT (rsum - P * (P + 1) / 2.0) / NULLIF(P * (T - P), 0) FROM (SELECT SUM(CASE WHEN yb = 1 THEN rk END) AS rsum, SUM(yb) AS P, COUNT(*) AS T FROM (SELECT yb, RANK() OVER (ORDER BY s) + (COUNT(*) OVER (PARTITION BY s) - 1) / 2.0 AS rk FROM (SELECT target_distress_next AS yb, risk AS s FROM M WHERE fp = '{fp}' AND target_distress_next IS NOT NULL AND risk IS NOT NULL)))) AS auc"
    for fp in ["Q1", "Q2", "Q3", "FY"]) + ")")
def q_roc_auc(spark, d):
    return rounded(me.roc_auc(m_view(spark, d), "target_distress_next", "risk", by=["fp"]))


@register("pr_auc", M_SQL + """, G AS (SELECT risk AS s, SUM(target_distress_next) AS pos, COUNT(*) AS cnt FROM M
  WHERE target_distress_next IS NOT NULL AND risk IS NOT NULL GROUP BY risk),
K AS (SELECT *, SUM(pos) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS tp,
             SUM(cnt) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS k,
             SUM(pos) OVER () AS P, SUM(cnt) OVER () AS N FROM G)
SELECT ROUND(SUM(pos / P * tp / k), 6) AS average_precision, ROUND(MAX(P) / MAX(N), 6) AS prevalence FROM K""")
def q_pr_auc(spark, d):
    return rounded(me.pr_auc(m_view(spark, d), "target_distress_next", "risk"))


def _mc_sql():
    per = " UNION ALL ".join(
        f"""SELECT {k} AS cls, COUNT(*) FILTER (WHERE target_class_next = {k}) AS sup,
  COUNT(*) FILTER (WHERE pred_class = {k}) AS pp,
  COUNT(*) FILTER (WHERE target_class_next = {k} AND pred_class = {k}) AS tp FROM M""" for k in range(3))
    aucs = " + ".join(_auc(f"CAST(target_class_next = {k} AS INTEGER)", f"p{k}") for k in range(3))
    return M_SQL + f""", PC AS ({per}),
PM AS (SELECT *, COALESCE(tp / NULLIF(pp, 0), 0) AS prec, COALESCE(tp / NULLIF(sup, 0), 0) AS rec,
              COALESCE(2 * tp / NULLIF(pp + sup, 0), 0) AS f1 FROM PC)
SELECT ROUND((SELECT COALESCE(COUNT(*) FILTER (WHERE target_class_next = pred_class) / NULLIF(COUNT(*), 0), 0) FROM M), 6) AS accuracy,
  ROUND(AVG(f1), 6) AS f1_macro, ROUND(COALESCE(SUM(f1 * sup) / NULLIF(SUM(sup), 0), 0), 6) AS f1_weighted,
  ROUND(AVG(prec), 6) AS precision_macro, ROUND(AVG(rec), 6) AS recall_macro,
  ROUND(({aucs}) / 3.0, 6) AS roc_auc_ovr FROM PM"""


@register("eval_multiclass", _mc_sql())
def q_eval_multiclass(spark, d):
    return rounded(me.eval_multiclass(m_view(spark, d), "target_class_next", "pred_class", (0, 1, 2),
                                      ["p0", "p1", "p2"]))


@register("confusion", M_SQL + """SELECT CAST(target_class_next AS INTEGER) AS y,
  COUNT(*) FILTER (WHERE pred_class = 0) AS pred_0, COUNT(*) FILTER (WHERE pred_class = 1) AS pred_1,
  COUNT(*) FILTER (WHERE pred_class = 2) AS pred_2 FROM M WHERE target_class_next IS NOT NULL GROUP BY 1""")
def q_confusion(spark, d):
    return me.confusion(m_view(spark, d), "target_class_next", "pred_class", [0, 1, 2])


@register("confusion_normalized", M_SQL + """SELECT y, ROUND(COALESCE(a / NULLIF(a + b + c, 0), 0), 6) AS pred_0,
  ROUND(COALESCE(b / NULLIF(a + b + c, 0), 0), 6) AS pred_1, ROUND(COALESCE(c / NULLIF(a + b + c, 0), 0), 6) AS pred_2
FROM (SELECT CAST(target_class_next AS INTEGER) AS y, COUNT(*) FILTER (WHERE pred_class = 0) AS a,
  COUNT(*) FILTER (WHERE pred_class = 1) AS b, COUNT(*) FILTER (WHERE pred_class = 2) AS c FROM M
  WHERE target_class_next IS NOT NULL GROUP BY 1)""")
def q_confusion_normalized(spark, d):
    return rounded(me.confusion(m_view(spark, d), "target_class_next", "pred_class", [0, 1, 2], normalize=True))


@register("split_temporal", M_SQL + f"""SELECT CASE WHEN fy <= {CUT} THEN 'train' ELSE 'validation' END AS split,
  COUNT(*) AS n FROM M GROUP BY 1""")
def q_split_temporal(spark, d):
    tr, va = sp.split_temporal(m_view(spark, d), "fy", CUT)
    return (tr.agg(F.count(F.lit(1)).alias("n")).withColumn("split", F.lit("train"))
            .unionByName(va.agg(F.count(F.lit(1)).alias("n")).withColumn("split", F.lit("validation"))))


@register("split_random", M_SQL + """, C AS (SELECT target_class_next AS cls, COUNT(*) AS n FROM M GROUP BY 1)
SELECT cls, 'train' AS split, CAST(ROUND(n * 0.8) AS BIGINT) AS n FROM C UNION ALL
SELECT cls, 'test', n - CAST(ROUND(n * 0.8) AS BIGINT) FROM C""")
def q_split_random(spark, d):
    m = m_view(spark, d)  # rows without a class are a stratum of their own
    s = sp.split_random(m, ["cik", "fy", "fp"], 0.8, strata="target_class_next")
    return s.groupBy(F.col("target_class_next").alias("cls"), "split").agg(F.count(F.lit(1)).alias("n"))


B_COLS = ["target_distress_next", "pred_distress", "target_class_next", "n_orders"]


@register("binary_split", M_SQL + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", COUNT(*) FILTER (WHERE {c} IS NOT NULL AND {c} NOT IN (0, 1)) = 0 AS is_binary FROM M"
    for c in B_COLS))
def q_binary_split(spark, d):
    binary, _ = sp.binary_split(m_view(spark, d), B_COLS)
    return spark.createDataFrame([(c, c in binary) for c in B_COLS], "column string, is_binary boolean")


@register("standardise", M_SQL + f""", ST AS (SELECT AVG(revenue) AS m1, STDDEV_POP(revenue) AS s1,
  AVG(n_orders) AS m2, STDDEV_POP(n_orders) AS s2 FROM M WHERE fy <= {CUT})
SELECT cik, fy, fp, ROUND((revenue - m1) / COALESCE(NULLIF(s1, 0), 1), 6) AS revenue,
  ROUND((n_orders - m2) / COALESCE(NULLIF(s2, 0), 1), 6) AS n_orders FROM M, ST""")
def q_standardise(spark, d):
    m = m_view(spark, d).select("cik", "fy", "fp", "revenue", "n_orders")
    tr, va = sp.split_temporal(m, "fy", CUT)
    a, b = sp.standardise(tr, [va], ["revenue", "n_orders"])
    return rounded(a.unionByName(b))


@register("undersample", M_SQL + """, C AS (SELECT target_class_next AS cls, COUNT(*) AS n FROM M GROUP BY 1)
SELECT cls, (SELECT MIN(n) FROM C) AS n FROM C""")
def q_undersample(spark, d):
    u = sp.undersample(m_view(spark, d), "target_class_next", ["cik", "fy", "fp"])
    return u.groupBy(F.col("target_class_next").alias("cls")).agg(F.count(F.lit(1)).alias("n"))


@register("class_balance", M_SQL + """, C AS (SELECT target_class_next AS target_class_next, COUNT(*) AS n FROM M GROUP BY 1)
SELECT target_class_next, n AS n_before, (SELECT MIN(n) FROM C) AS n_after FROM C""")
def q_class_balance(spark, d):
    m = m_view(spark, d)
    u = sp.undersample(m, "target_class_next", ["cik", "fy", "fp"])
    return sp.class_balance(m, u, "target_class_next")


@register("temporal_folds", M_SQL + """, TX AS (SELECT cik, fy, fp, ROW_NUMBER() OVER (ORDER BY fy,
  CASE fp WHEN 'Q1' THEN 1 WHEN 'Q2' THEN 2 WHEN 'Q3' THEN 3 WHEN 'Q4' THEN 4 WHEN 'FY' THEN 5 ELSE 99 END, cik) - 1 AS pos,
  COUNT(*) OVER () AS n FROM M), TY AS (SELECT *, n // 4 AS sz, n - 3 * (n // 4) AS first FROM TX)
SELECT cik, fy, fp, pos, CASE WHEN pos >= first AND sz > 0 THEN CAST((pos - first) // sz + 1 AS INTEGER) END AS test_fold FROM TY""")
def q_temporal_folds(spark, d):
    m = m_view(spark, d).select("cik", "fy", "fp")
    return fo.temporal_folds(m, "fy", "fp", "cik", 3).select("cik", "fy", "fp", "pos", "test_fold")


@register("kfold_cv", M_SQL + """, C AS (SELECT target_class_next AS cls, COUNT(*) AS n FROM M GROUP BY 1), F AS (SELECT UNNEST(range(5)) AS fold)
SELECT cls, CAST(fold AS INTEGER) AS fold, CAST((n - 1 - fold) // 5 + 1 AS BIGINT) AS n FROM C, F WHERE fold < n""")
def q_kfold_cv(spark, d):
    m = m_view(spark, d)
    k = fo.kfold_column(m, ["cik", "fy", "fp"], 5, strata="target_class_next")
    return k.groupBy(F.col("target_class_next").alias("cls"), "fold").agg(F.count(F.lit(1)).alias("n"))


@register("dataset_checks", M_SQL + """, A AS (SELECT COUNT(*) AS r, COUNT(DISTINCT cik) AS e, MIN(fy) AS lo, MAX(fy) AS hi,
  COUNT(*) FILTER (WHERE risk IS NULL) AS nr FROM M)
SELECT 'rows' AS "check", CAST(r AS DOUBLE) AS value, r > 0 AS ok FROM A UNION ALL
SELECT 'entities', CAST(e AS DOUBLE), e > 0 FROM A UNION ALL
SELECT 'fy_min', CAST(lo AS DOUBLE), lo >= 1995 FROM A UNION ALL
SELECT 'fy_max', CAST(hi AS DOUBLE), hi <= 2001 FROM A UNION ALL
SELECT 'nulls_risk', CAST(nr AS DOUBLE), nr = 0 FROM A""")
def q_dataset_checks(spark, d):
    return se.dataset_checks(m_view(spark, d), fy_range=(1995, 2001), no_null=["risk"])


@register("model_ranking", BASE_SQL + """
SELECT baseline AS model, rmse, CAST(ROW_NUMBER() OVER (ORDER BY rmse, baseline) AS INTEGER) AS rank FROM (
  SELECT *, 'persistence' AS baseline FROM B UNION ALL SELECT *, 'persistence_delta' FROM BD)""")
def q_model_ranking(spark, d):
    b = rounded(me.baseline_persistence(m_view(spark, d), "target_score_next", "risk", "risk_delta"))
    return model_ranking(b.select(F.col("baseline").alias("model"), "rmse"), "rmse", ascending=True)


# -- Spark ML fits (rows-only) ------------------------------------------------------

FEATS = ["price_sum", "revenue", "disc_avg", "n_orders", "revenue_qoq", "risk", "risk_delta"]


def _train_valid(spark, d):
    """Customer-quarter panel with next-quarter targets; NULL features back-stopped;
    materialised once in the checkpoint folder so every fit reads the small table."""
    m = m_view(spark, d).where(F.col("target_score_next").isNotNull())
    m = m.select("cik", "fy", "fp", "fp_ord", *FEATS, "target_score_next",
                 F.col("target_distress_next").cast("double").alias("target_distress_next"),
                 F.col("target_class_next").cast("double").alias("target_class_next"))
    m = cut_lineage(impute_backstop(m, FEATS))
    return sp.split_temporal(m, "fy", CUT)


def _fit_query(fit):
    def fn(spark, d):
        tr, va = _train_valid(spark, d)
        model, y, task = fit(tr)
        p = mo.predict(model, va)
        m = (me.eval_regression(p, y, "prediction", None) if task == "regression" else
             me.eval_binary(p, y, "prediction", "prob" if "prob" in p.columns else None))
        return m
    return fn


register("fit_linear")(_fit_query(lambda tr: (mo.fit_linear(tr, "target_score_next", FEATS, 1.0, 0.0),
                                              "target_score_next", "regression")))
register("fit_logistic")(_fit_query(lambda tr: (mo.fit_logistic(tr, "target_distress_next", FEATS),
                                                "target_distress_next", "binary")))
register("fit_forest")(_fit_query(lambda tr: (mo.fit_forest(tr, "target_score_next", FEATS, "regression", 200, 10),
                                              "target_score_next", "regression")))
register("fit_gbt")(_fit_query(lambda tr: (mo.fit_gbt(tr, "target_distress_next", FEATS, "binary", 300, 6, 0.05, 0.8),
                                           "target_distress_next", "binary")))
register("fit_mlp")(_fit_query(lambda tr: (mo.fit_mlp(tr, "target_distress_next", FEATS, (256, 128, 64), 2, 100),
                                           "target_distress_next", "binary")))


@register("importance")
def q_importance(spark, d):
    tr, _ = _train_valid(spark, d)
    return mo.importance(mo.fit_forest(tr, "target_score_next", FEATS, "regression", 200, 10), FEATS)


@register("topk_importance")
def q_topk_importance(spark, d):
    return topk_importance(q_importance(spark, d), 5)


@register("compare_models")
def q_compare_models(spark, d):
    tr, va = _train_valid(spark, d)
    return se.compare_models(tr, va, "target_score_next", FEATS, mo.MODEL_GRID, "regression", clip_range=(0.0, 1.0))


@register("compare_models_class")
def q_compare_models_class(spark, d):
    """Three risk classes, boosting among the models; ranked by one-vs-rest scores."""
    tr, va = _train_valid(spark, d)
    grid = {"logistic": {"fit": "logistic", "family": "multinomial"}, "random_forest": {"fit": "forest", "trees": 50, "depth": 8},
            "gbt": {"fit": "gbt", "trees": 30, "depth": 4, "lr": 0.1, "subsample": 0.8}}
    return se.compare_models(tr, va, "target_class_next", FEATS, grid, "multiclass")


@register("compare_models_residual")
def q_compare_models_residual(spark, d):
    """The change of the score as target, predictions clipped to (-1, 1)."""
    tr, va = [x.withColumn("target_residual", F.col("target_score_next") - F.col("risk")) for x in _train_valid(spark, d)]
    grid = {k: v for k, v in mo.MODEL_GRID.items() if v["fit"] == "linear"} | {
        "random_forest": {"fit": "forest", "trees": 50, "depth": 8}, "gbt": {"fit": "gbt", "trees": 40, "depth": 4, "lr": 0.1, "subsample": 0.8}}
    return se.compare_models(tr, va, "target_residual", FEATS, grid, "regression", clip_range=(-1.0, 1.0))


@register("train_val_gap")
def q_train_val_gap(spark, d):
    tr, va = _train_valid(spark, d)
    m = mo.fit_forest(tr, "target_score_next", FEATS, "regression", 200, 10)
    return se.train_val_gap(m, tr, va, "target_score_next", clip_range=(0.0, 1.0))


@register("train_val_gap_class")
def q_train_val_gap_class(spark, d):
    """F1 and average precision of the distress model on both sides."""
    tr, va = _train_valid(spark, d)
    m = mo.fit_forest(tr, "target_distress_next", FEATS, "binary", 50, 8)
    return se.train_val_gap(m, tr, va, "target_distress_next", "binary")


def _gap_sql(where):
    return f"""SELECT (SELECT COALESCE(2 * COUNT(*) FILTER (WHERE y = 1 AND p = 1) / NULLIF(COUNT(*) FILTER (WHERE y = 1) + COUNT(*) FILTER (WHERE p = 1), 0), 0) FROM
  (SELECT target_distress_next AS y, pred_distress AS p FROM M WHERE {where} AND target_distress_next IS NOT NULL)) AS f1,
  (SELECT SUM(pos / P * tp / k) FROM (SELECT *, SUM(pos) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS tp, SUM(cnt) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS k,
    SUM(pos) OVER () AS P FROM (SELECT risk AS s, SUM(target_distress_next) AS pos, COUNT(*) AS cnt FROM M
    WHERE {where} AND target_distress_next IS NOT NULL AND risk IS NOT NULL GROUP BY risk))) AS ap"""


@register("prediction_gap", M_SQL + f""", T AS ({_gap_sql(f"fy <= {CUT}")}), V AS ({_gap_sql(f"fy > {CUT}")})
SELECT 'f1' AS metric, ROUND(T.f1, 6) AS train, ROUND(V.f1, 6) AS valid, ROUND(T.f1 - V.f1, 6) AS gap FROM T, V
UNION ALL SELECT 'average_precision', ROUND(T.ap, 6), ROUND(V.ap, 6), ROUND(T.ap - V.ap, 6) FROM T, V""")
def q_prediction_gap(spark, d):
    """The same metrics of a stored prediction: today's risk for the next period."""
    tr, va = sp.split_temporal(m_view(spark, d), "fy", CUT)
    out = se.prediction_gap(tr, va, "target_distress_next", "pred_distress", "risk")
    return rounded(out.where(F.col("metric").isin("f1", "average_precision")))


RIDGE_SETS = {"one": ["risk"], "two": ["risk", "revenue_qoq"]}


@register("ridge", M_SQL + f""", RG AS (SELECT CAST(target_score_next AS DOUBLE) AS y, CAST(risk AS DOUBLE) AS a, CAST(revenue_qoq AS DOUBLE) AS b FROM M WHERE fy <= {CUT}),
S1 AS (SELECT AVG(y) AS my, AVG(a) AS ma, COVAR_POP(a, y) * COUNT(*) AS ay, VAR_POP(a) * COUNT(*) + 2.5 AS aa FROM RG WHERE y IS NOT NULL AND a IS NOT NULL),
S2 AS (SELECT AVG(y) AS my, AVG(a) AS ma, AVG(b) AS mb, COVAR_POP(a, y) * COUNT(*) AS ay, COVAR_POP(b, y) * COUNT(*) AS b_y, COVAR_POP(a, b) * COUNT(*) AS ab,
  VAR_POP(a) * COUNT(*) + 2.5 AS aa, VAR_POP(b) * COUNT(*) + 2.5 AS bb FROM RG WHERE y IS NOT NULL AND a IS NOT NULL AND b IS NOT NULL),
W2 AS (SELECT *, (ay * bb - b_y * ab) / (aa * bb - ab * ab) AS wa, (b_y * aa - ay * ab) / (aa * bb - ab * ab) AS wb FROM S2)
SELECT 'one' AS model, 'risk' AS feature, ROUND(ay / aa, 6) AS coefficient FROM S1
UNION ALL SELECT 'one', '(intercept)', ROUND(my - ma * ay / aa, 6) FROM S1
UNION ALL SELECT 'two', 'risk', ROUND(wa, 6) FROM W2 UNION ALL SELECT 'two', 'revenue_qoq', ROUND(wb, 6) FROM W2
UNION ALL SELECT 'two', '(intercept)', ROUND(my - wa * ma - wb * mb, 6) FROM W2""")
def q_ridge(spark, d):
    """Penalised least squares from cross sums, with one and two features."""
    m = cut_lineage(m_view(spark, d).where(F.col("fy") <= CUT).select("target_score_next", "risk", "revenue_qoq"))
    parts = [mo.ridge(m, "target_score_next", f, 2.5).select(F.lit(n).alias("model"), "feature", "coefficient") for n, f in RIDGE_SETS.items()]
    return rounded(parts[0].unionByName(parts[1]))


@register("kfold_scores")
def q_kfold_scores(spark, d):
    """A ridge model fitted and scored per fold (folds of equal class shares)."""
    m = m_view(spark, d).where(F.col("target_score_next").isNotNull()).select("cik", "fy", "fp", *FEATS, "target_score_next", "target_class_next")
    m = cut_lineage(impute_backstop(m, FEATS))
    folded = cut_lineage(fo.kfold_column(m, ["cik", "fy", "fp"], 5, strata="target_class_next"))
    return se.cross_validate(folded, "target_score_next", FEATS, mo.MODEL_GRID["ridge"], clip_range=(0.0, 1.0))


@register("metric_recheck")
def q_metric_recheck(spark, d):
    """Two models stored with their metrics, then loaded and scored again."""
    from finpanel.ml import history as hi
    from finpanel.sources.files import stage_path
    tr, va = _train_valid(spark, d)
    folder = stage_path(spark, "models")
    for name, y, task, m in (("ridge", "target_score_next", "regression", mo.fit_linear(tr, "target_score_next", FEATS, 1.0, 0.0)),
                             ("forest", "target_distress_next", "binary", mo.fit_forest(tr, "target_distress_next", FEATS, "binary", 30, 6))):
        hi.save_model(m, name, FEATS, y, task, se._metrics(m, va, y, task), folder)
    return hi.recheck(spark, folder, va).drop("run")


@register("ablation")
def q_ablation(spark, d):
    """Each feature group alone, then without it; both runs recorded, the second reads the first."""
    from finpanel.ml import history as hi
    from finpanel.sources.files import stage_path
    tr, va = _train_valid(spark, d)
    groups = {"size": ["price_sum", "revenue", "n_orders"], "momentum": ["revenue_qoq", "risk_delta"], "level": ["risk", "disc_avg"]}
    folder = stage_path(spark, "ablation")
    for mode in ("keep", "remove"):
        se.ablation(tr, va, "target_score_next", FEATS, mo.MODEL_GRID["ridge"], groups, mode=mode, history=folder, run=mode)
    return hi.read(spark, folder).drop("recorded_at")


@register("param_search")
def q_param_search(spark, d):
    tr, _ = _train_valid(spark, d)
    folded = cut_lineage(fo.temporal_folds(tr, "fy", "fp", "cik", 3))
    space = {"l2": [0.001, 0.01, 0.1, 1.0], "l1_ratio": [0.0, 0.5, 1.0]}
    return se.param_search(folded, "target_score_next", FEATS, space, {"fit": "linear"}, trials=30, n_folds=3)


#: Ranges of the boosting search.
GBT_SPACE = {"trees": ("int", 5, 20), "depth": ("int", 2, 4), "lr": ("log", 0.02, 0.3), "subsample": ("float", 0.6, 1.0)}


@register("param_search_gbt")
def q_param_search_gbt(spark, d):
    """30 settings of boosting from ranges; the worse two thirds stop after each fold."""
    tr, _ = _train_valid(spark, d)
    folded = cut_lineage(fo.temporal_folds(tr, "fy", "fp", "cik", 3))
    return se.halving_search(folded, "target_score_next", FEATS, GBT_SPACE, {"fit": "gbt"}, trials=30, n_folds=3)


# -- neighbours and oversampling ----------------------------------------------------------

NEAR = ["price_sum", "revenue", "disc_avg", "n_orders", "risk", "revenue_qoq"]


def _near_rows(spark, d):
    """Scaled features of every panel row, with a long id of its own."""
    m = cut_lineage(impute_backstop(m_view(spark, d).select("cik", "fy", "fp", "fp_ord", *NEAR), NEAR))
    m = m.withColumn("row_id", (F.col("cik").cast("long") * 10_000 + F.col("fy")) * 10 + F.col("fp_ord"))
    return cut_lineage(sp.standardise(m, [], NEAR)[0].select("row_id", *NEAR, "fp"))


@register("knn_edges")
def q_knn_edges(spark, d):
    """Five neighbours of every panel row by features and fiscal period, through the projection index."""
    from finpanel.operators.lsh import knn_lsh
    return knn_lsh(_near_rows(spark, d), "row_id", NEAR, ["fp"], 5)


@register("knn_recall")
def q_knn_recall(spark, d):
    """What the index finds of the true neighbours of rows whose id is divisible by 50."""
    from finpanel.operators.lsh import knn_lsh, recall
    # A row id ends in its quarter, 1 to 4, so none is divisible by 50: here quarters count from 0 in fours.
    m = _near_rows(spark, d).withColumn("row_id", F.expr("row_id div 10 * 4 + row_id % 10 - 1"))
    edges = cut_lineage(knn_lsh(m, "row_id", NEAR, ["fp"], 5))
    return recall(m, edges, "row_id", NEAR, ["fp"], 5)


@register("knn_edges_exact", """WITH E AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
D AS (SELECT a.vec_id AS src, b.vec_id AS dst, list_distance(a.v, b.v) AS dist FROM E a JOIN E b ON a.vec_id <> b.vec_id)
SELECT src, dst, CAST(rank AS INTEGER) AS rank, ROUND(dist, 6) AS dist FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY src ORDER BY dist, dst) AS rank FROM D) WHERE rank <= 5""")
def q_knn_edges_exact(spark, d):
    from finpanel.operators.knn import knn_edges
    from finpanel.sources.driver import vectors
    return rounded(knn_edges(vectors(spark, d), "vec_id", "embedding", 5))


SMOTE_CONT = ["revenue", "disc_avg", "revenue_qoq", "risk"]


def _smote(spark, d):
    tr, _ = _train_valid(spark, d)
    tr = tr.withColumn("row_id", (F.col("cik").cast("long") * 10_000 + F.col("fy")) * 10 + F.col("fp_ord"))
    tr = cut_lineage(sp.standardise(tr, [], SMOTE_CONT)[0])
    from finpanel.ml.balance import smote_nc
    return tr, smote_nc(tr, "target_class_next", "row_id", SMOTE_CONT, ["fp"], k=5, seed=42)


@register("smote_nc")
def q_smote_nc(spark, d):
    """Synthetic rows of every class below the largest."""
    return _smote(spark, d)[1]


@register("smote_balance", M_SQL + f""", C AS (SELECT target_class_next AS cls, COUNT(*) AS n FROM M
  WHERE target_score_next IS NOT NULL AND fy <= {CUT} AND target_class_next IS NOT NULL GROUP BY 1)
SELECT CAST(cls AS INTEGER) AS cls, n AS n_real, (SELECT MAX(n) FROM C) - n AS n_synthetic, 0 AS n_outside FROM C""")
def q_smote_balance(spark, d):
    """Rows per class before and added, and synthetic rows that do not lie between their two parents."""
    tr, made = _smote(spark, d)
    ends = [tr.select(F.col("row_id").alias(i), *[F.col(c).alias(f"{x}_{c}") for c in SMOTE_CONT]) for i, x in (("source_id", "a"), ("near_id", "b"))]
    beside = F.lit(False)
    for c in SMOTE_CONT:
        a, b = F.col(f"a_{c}"), F.col(f"b_{c}")
        beside = beside | (F.col(c) < F.least(a, b) - 1e-9) | (F.col(c) > F.greatest(a, b) + 1e-9)
    made = made.join(ends[0], "source_id").join(ends[1], "near_id")
    added = made.groupBy("target_class_next").agg(F.count(F.lit(1)).alias("n_synthetic"), F.count_if(beside).alias("n_outside"))
    real = tr.groupBy("target_class_next").agg(F.count(F.lit(1)).alias("n_real"))
    return real.join(added, "target_class_next", "left").select(
        F.col("target_class_next").cast("int").alias("cls"), "n_real", F.coalesce("n_synthetic", F.lit(0)).alias("n_synthetic"),
        F.coalesce("n_outside", F.lit(0)).cast("int").alias("n_outside"))


@register("feature_select", M_SQL + """, T AS (
SELECT cik, fy, fp, fp_ord, price_sum, revenue, disc_avg, n_orders, revenue_qoq, risk, risk_delta,
  target_score_next, target_distress_next, target_class_next FROM M WHERE fy <= """ + str(CUT) + """)
SELECT column_name AS feature, n_present FROM (UNPIVOT (SELECT COUNT(COLUMNS(*)) FROM T) ON COLUMNS(*) INTO NAME column_name VALUE n_present)
WHERE column_name NOT IN ('cik', 'fy', 'fp', 'fp_ord') AND NOT starts_with(column_name, 'target_')""")
def q_feature_select(spark, d):
    """The features of the training rows, with how many rows hold a value of each."""
    from finpanel.operators.aggregates import coverage
    tr, _ = sp.split_temporal(m_view(spark, d).select(
        "cik", "fy", "fp", "fp_ord", *FEATS, "target_score_next", "target_distress_next", "target_class_next"), "fy", CUT)
    cols = sp.feature_select(tr, exclude=["cik", "fy", "fp", "fp_ord"], exclude_prefixes=["target_"])
    return coverage(tr, cols).select(F.col("column").alias("feature"), F.col("n_non_null").alias("n_present"))
