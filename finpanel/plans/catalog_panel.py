"""Panel windows: flagship risk panel, dedups, lag/lead/diff/pct/accel, ffill, checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from finpanel.functions.scalar import sigmoid_score
from finpanel.operators import panel as pn
from finpanel.operators.targets import targets
from finpanel.plans import sql as q
from finpanel.plans.registry import register, rounded
from finpanel.sources import driver as dv

E, O = "cik", ["fy", "fp_ord"]


def risk_panel(spark, d):
    """Customer-quarter revenue, QoQ change clipped +-5, sigmoid risk, next-quarter targets."""
    p = dv.customer_quarter_panel(spark, d)
    p = p.withColumns({
        "revenue_prev": pn.lag_expr(E, O, "revenue"),
        "revenue_qoq": pn.pct_delta_expr(E, O, "revenue", 5.0),
    })
    p = p.withColumn("risk", sigmoid_score("revenue_qoq", 1.23))
    return targets(p, E, O, "risk")


RISK_COLS = ["cik", "fy", "fp", "n_orders", "revenue", "revenue_prev", "revenue_qoq", "risk",
             "target_score_next", "target_distress_next", "target_class_next", "target_residual"]


RISK_SQL = q.with_(q.H, q.R, q.P, """X AS (
  SELECT *, LAG(revenue) OVER (PARTITION BY cik ORDER BY fy, fp_ord) AS revenue_prev FROM P),
Y AS (
  SELECT *, CASE WHEN revenue IS NULL OR revenue_prev IS NULL OR revenue_prev = 0 THEN NULL
                 ELSE GREATEST(-5.0, LEAST(5.0, (revenue - revenue_prev) / ABS(revenue_prev))) END AS revenue_qoq
  FROM X),
Z AS (SELECT *, 1.0 / (1.0 + EXP(revenue_qoq - 1.23)) AS risk FROM Y),
W AS (SELECT *, LEAD(risk) OVER (PARTITION BY cik ORDER BY fy, fp_ord) AS target_score_next FROM Z)""")


@register("panel_risk", RISK_SQL + """
SELECT cik, fy, fp, n_orders, ROUND(revenue, 6) AS revenue, ROUND(revenue_prev, 6) AS revenue_prev,
       ROUND(revenue_qoq, 6) AS revenue_qoq, ROUND(risk, 6) AS risk,
       ROUND(target_score_next, 6) AS target_score_next,
       CASE WHEN target_score_next IS NULL THEN NULL WHEN target_score_next >= 0.5 THEN 1 ELSE 0 END AS target_distress_next,
       CASE WHEN target_score_next < 0.35 THEN 0 WHEN target_score_next < 0.65 THEN 1
            WHEN target_score_next IS NOT NULL THEN 2 END AS target_class_next,
       ROUND(target_score_next - risk, 6) AS target_residual
FROM W""")
def q_panel_risk(spark, d):
    return rounded(risk_panel(spark, d).select(*RISK_COLS))


@register("dedup_latest", q.with_(q.H) + """
SELECT adsh, cik, fy, fp, filed FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY cik, fy, fp ORDER BY filed DESC NULLS FIRST, adsh DESC) AS rn FROM H)
WHERE rn = 1""")
def q_dedup_latest(spark, d):
    h = dv.header(spark, d)
    # the winning row travels inside the aggregate, so name the columns it must carry
    return pn.dedup_latest(h, ["cik", "fy", "fp"], by="filed", tie=["adsh"], cols=["adsh", "filed"]).select(
        "adsh", "cik", "fy", "fp", "filed")


@register("dedup_longest", q.with_(q.N) + """
SELECT adsh, tag, qtrs, version, supp, value FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY adsh, tag ORDER BY qtrs DESC NULLS LAST, version, supp, value) AS rn FROM N)
WHERE rn = 1""")
def q_dedup_longest(spark, d):
    n = dv.facts(spark, d)
    return pn.dedup_longest(n, ["adsh", "tag"], by="qtrs", tie=["version", "supp", "value"],
                            cols=["qtrs", "version", "supp", "value"]).select(
        "adsh", "tag", "qtrs", "version", "supp", "value")


@register("dedup_last_by_id", q.with_(q.N) + """
SELECT adsh, ddate, qtrs, version, supp, value FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY adsh ORDER BY ddate DESC NULLS LAST, qtrs DESC, version DESC,
                                                        supp DESC, value DESC) AS rn FROM N)
WHERE rn = 1""")
def q_dedup_last_by_id(spark, d):
    n = dv.facts(spark, d)
    return pn.dedup_last_by_id(n, "adsh", by="ddate", tie=["qtrs", "version", "supp", "value"],
                               cols=["ddate", "qtrs", "version", "supp", "value"]).select(
        "adsh", "ddate", "qtrs", "version", "supp", "value")


@register("lag1", q.with_(q.T) + """
SELECT user_id, day, ROUND(value, 6) AS value,
       ROUND(LAG(value) OVER (PARTITION BY user_id ORDER BY day), 6) AS value_prev,
       LAG(n_events) OVER (PARTITION BY user_id ORDER BY day) AS n_events_prev
FROM T""")
def q_lag1(spark, d):
    t = dv.time_panel(spark, d)
    return rounded(pn.lag1(t, "user_id", ["day"], ["value", "n_events"]).select(
        "user_id", "day", "value", "value_prev", "n_events_prev"))


@register("lead1", q.with_(q.H, q.R, q.P) + """
SELECT cik, fy, fp, ROUND(price_sum, 6) AS price_sum,
       ROUND(LEAD(price_sum) OVER (PARTITION BY cik ORDER BY fy, fp_ord), 6) AS price_sum_next,
       LEAD(n_orders) OVER (PARTITION BY cik ORDER BY fy, fp_ord) AS n_orders_next
FROM P""")
def q_lead1(spark, d):
    p = dv.customer_quarter_panel(spark, d)
    return rounded(pn.lead1(p, E, O, ["price_sum", "n_orders"]).select(
        "cik", "fy", "fp", "price_sum", "price_sum_next", "n_orders_next"))


@register("diff1", q.with_(q.T) + """
SELECT user_id, day, ROUND(value - LAG(value) OVER (PARTITION BY user_id ORDER BY day), 6) AS value_diff,
       n_events - LAG(n_events) OVER (PARTITION BY user_id ORDER BY day) AS n_events_diff
FROM T""")
def q_diff1(spark, d):
    t = dv.time_panel(spark, d)
    return rounded(pn.diff1(t, "user_id", ["day"], ["value", "n_events"]).select(
        "user_id", "day", "value_diff", "n_events_diff"))


@register("pct_delta", q.with_(q.H, q.R, q.P) + """
SELECT cik, fy, fp, ROUND(CASE WHEN p IS NULL OR p = 0 OR price_sum IS NULL THEN NULL
                  ELSE GREATEST(-5.0, LEAST(5.0, (price_sum - p) / ABS(p))) END, 6) AS price_sum_pct,
       ROUND(CASE WHEN r IS NULL OR r = 0 OR revenue IS NULL THEN NULL
                  ELSE GREATEST(-5.0, LEAST(5.0, (revenue - r) / ABS(r))) END, 6) AS revenue_pct
FROM (SELECT *, LAG(price_sum) OVER w AS p, LAG(revenue) OVER w AS r
      FROM P WINDOW w AS (PARTITION BY cik ORDER BY fy, fp_ord))""")
def q_pct_delta(spark, d):
    p = dv.customer_quarter_panel(spark, d)
    return rounded(pn.pct_delta(p, E, O, ["price_sum", "revenue"], bound=5.0).select(
        "cik", "fy", "fp", "price_sum_pct", "revenue_pct"))


@register("accel", q.with_(q.T) + """
SELECT user_id, day, ROUND((value - LAG(value, 1) OVER w) - (LAG(value, 1) OVER w - LAG(value, 2) OVER w), 6) AS value_accel
FROM T WINDOW w AS (PARTITION BY user_id ORDER BY day)""")
def q_accel(spark, d):
    t = dv.time_panel(spark, d)
    return rounded(pn.accel(t, "user_id", ["day"], "value").select("user_id", "day", "value_accel"))


@register("worsened_flag", q.with_(q.H, q.R, q.P) + """
SELECT cik, fy, fp, CASE WHEN dd IS NULL THEN NULL WHEN dd > 0 THEN 1 ELSE 0 END AS revenue_worse
FROM (SELECT *, revenue - LAG(revenue) OVER (PARTITION BY cik ORDER BY fy, fp_ord) AS dd FROM P)""")
def q_worsened_flag(spark, d):
    p = dv.customer_quarter_panel(spark, d)
    p = pn.diff1(p, E, O, ["revenue"])
    return p.select("cik", "fy", "fp", pn.worsened_flag("revenue_diff").alias("revenue_worse"))


@register("ffill_limit", q.with_(q.H, q.R, q.P) + """
SELECT cik, fy, fp, ROUND(COALESCE(revenue, LAST_VALUE(revenue IGNORE NULLS) OVER (
    PARTITION BY cik ORDER BY fy, fp_ord ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)), 6) AS revenue
FROM P""")
def q_ffill_limit(spark, d):
    p = dv.customer_quarter_panel(spark, d)
    return rounded(pn.ffill_limit(p, E, O, ["revenue"], limit=2).select("cik", "fy", "fp", "revenue"))


@register("delta_check", q.with_(q.H, q.R, q.P) + """
, D AS (SELECT *, price_sum - LAG(price_sum) OVER (PARTITION BY cik ORDER BY fy, fp_ord) AS rec FROM P),
  E AS (SELECT *, ROUND(rec, 2) AS stored FROM D)
SELECT COUNT(*) FILTER (WHERE rec IS NOT NULL AND stored IS NOT NULL) AS n_compared,
       COUNT(*) FILTER (WHERE rec IS NOT NULL AND stored IS NOT NULL AND ABS(rec - stored) > 0.004) AS n_mismatch,
       ROUND(MAX(CASE WHEN rec IS NOT NULL AND stored IS NOT NULL THEN ABS(rec - stored) END), 3) AS max_abs_diff
FROM E""")
def q_delta_check(spark, d):
    p = dv.customer_quarter_panel(spark, d)
    p = pn.diff1(p, E, O, ["price_sum"]).withColumn("stored", F.round("price_sum_diff", 2))
    out = pn.delta_check(p, E, O, "price_sum", "stored", tol=0.004)
    return out.withColumn("max_abs_diff", F.round("max_abs_diff", 3))


@register("panel_sort", q.with_(q.H, q.R, q.P) + """
SELECT cik, fy, fp, n_orders FROM P ORDER BY cik, fy, fp_ord""")
def q_panel_sort(spark, d):
    p = dv.customer_quarter_panel(spark, d)
    return pn.panel_sort(p, E, O).select("cik", "fy", "fp", "n_orders")
