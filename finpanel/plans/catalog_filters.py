"""2.3 filters and the cleaning audit on the driver views."""

from __future__ import annotations

from pyspark.sql import functions as F

from finpanel.operators import filters as fl
from finpanel.operators.targets import filter_has_target
from finpanel.plans import sql as q
from finpanel.plans.catalog_panel import RISK_SQL, risk_panel
from finpanel.plans.registry import register, rounded
from finpanel.sources import driver as dv

NCOLS = ["adsh", "tag", "qtrs", "version", "supp", "value"]
NSQL = ", ".join(NCOLS)


@register("filter_in", q.with_(q.N) + f"SELECT {NSQL} FROM N WHERE tag IN ('AF', 'NO')")
def q_filter_in(spark, d):
    return fl.filter_in(dv.facts(spark, d), "tag", ["AF", "NO"]).select(*NCOLS)


@register("filter_blank", q.with_(q.N) + f"SELECT {NSQL} FROM N WHERE segments IS NULL OR TRIM(segments) = ''")
def q_filter_blank(spark, d):
    return fl.filter_blank(dv.facts(spark, d), "segments").select(*NCOLS)


@register("filter_uom", q.with_(q.N) + f"""SELECT {NSQL} FROM N
WHERE (tag IN ('AF', 'AO', 'NF', 'NO') AND uom = 'USD') OR (tag IN ('RF', 'RO') AND uom = 'shares')""")
def q_filter_uom(spark, d):
    return fl.filter_uom(dv.facts(spark, d), {"USD": dv.USD_TAGS, "shares": dv.SHARE_TAGS}).select(*NCOLS)


@register("filter_current", q.with_(q.N, q.H) + f"""SELECT N.adsh, tag, qtrs, version, supp, value, fy
FROM N JOIN H ON N.adsh = H.adsh WHERE N.dyear = H.fy""")
def q_filter_current(spark, d):
    from finpanel.operators.joins import join_num_sub
    j = join_num_sub(dv.facts(spark, d), dv.header(spark, d), "adsh", ["fy"])
    return fl.filter_current(j, "dyear", "fy").select(*NCOLS, "fy")


def _fp2():
    m = (F.col("period") % 10000) / 100
    return (F.when(F.floor(m) == 12, "Q4").when(F.col("period") % 100 == 1, F.lit(None))
             .otherwise(F.col("fp")))


FP2_SQL = ("CASE WHEN (period % 10000) // 100 = 12 THEN 'Q4' WHEN period % 100 = 1 THEN NULL "
           "ELSE fp END")


@register("filter_not_q4", q.with_(q.H) + f"""SELECT adsh, fp2 FROM (SELECT adsh, {FP2_SQL} AS fp2 FROM H)
WHERE fp2 IS DISTINCT FROM 'Q4'""")
def q_filter_not_q4(spark, d):
    h = dv.header(spark, d).select("adsh", _fp2().alias("fp2"))
    return fl.filter_not_q4(h, "fp2")


@register("filter_positive", q.with_(q.S) + "SELECT cik, balance FROM S WHERE balance > 0")
def q_filter_positive(spark, d):
    return fl.filter_positive(dv.sector(spark, d), "balance").select("cik", "balance")


@register("filter_range", q.with_(q.H) + "SELECT adsh, fy FROM H WHERE fy BETWEEN 1996 AND 1999")
def q_filter_range(spark, d):
    return fl.filter_range(dv.header(spark, d), "fy", 1996, 1999).select("adsh", "fy")


@register("filter_min", q.with_(q.H, q.R, q.P) + """SELECT cik, fy, fp FROM P
WHERE price_sum >= 300000 AND COALESCE(revenue, 0) >= 100000""")
def q_filter_min(spark, d):
    p = dv.customer_quarter_panel(spark, d)
    p = fl.filter_min(p, "price_sum", 300000)
    return fl.filter_min(p, "revenue", 100000, null_as_zero=True).select("cik", "fy", "fp")


@register("filter_min_group", q.with_(q.H, q.R, q.P) + """SELECT cik, fy, fp FROM (
  SELECT *, COUNT(revenue) OVER (PARTITION BY cik) AS n FROM P) WHERE n >= 10""")
def q_filter_min_group(spark, d):
    p = dv.customer_quarter_panel(spark, d)
    return fl.filter_min_group(p, "cik", "revenue", 10).select("cik", "fy", "fp")


@register("filter_has_target", RISK_SQL + """SELECT cik, fy, fp, ROUND(target_score_next, 6) AS target_score_next
FROM W WHERE target_score_next IS NOT NULL""")
def q_filter_has_target(spark, d):
    return rounded(filter_has_target(risk_panel(spark, d), ["target_score_next"]).select(
        "cik", "fy", "fp", "target_score_next"))


@register("step_audit", q.with_(q.H, q.R, q.P) + """, A AS (
  SELECT *, CASE WHEN NOT COALESCE(revenue IS NOT NULL, false) THEN 0
                 WHEN NOT COALESCE(price_sum >= 100000, false) THEN 1
                 WHEN NOT COALESCE(fy >= 1996, false) THEN 2 ELSE 3 END AS step_no FROM P)
SELECT CAST(step_no AS INTEGER) AS step_no,
       CASE step_no WHEN 0 THEN 'has_revenue' WHEN 1 THEN 'min_price' WHEN 2 THEN 'recent' ELSE 'kept' END AS step,
       COUNT(*) AS rows_out, COUNT(DISTINCT cik) AS entities_out
FROM A GROUP BY step_no""")
def q_step_audit(spark, d):
    p = dv.customer_quarter_panel(spark, d)
    steps = [("has_revenue", F.col("revenue").isNotNull()),
             ("min_price", F.col("price_sum") >= 100000),
             ("recent", F.col("fy") >= 1996)]
    return fl.step_audit(p, steps, entity="cik")
