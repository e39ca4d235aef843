"""2.5 aggregations, 2.7 top-k and sorting reports on the driver views."""

from __future__ import annotations

from pyspark.sql import functions as F

from finpanel import schema as S
from finpanel.operators import aggregates as ag
from finpanel.operators import panel as pn
from finpanel.operators import topk as tk
from finpanel.operators.filters import filter_uom
from finpanel.plans import sql as q
from finpanel.plans.catalog_panel import RISK_SQL, risk_panel
from finpanel.plans.registry import register, rounded
from finpanel.sources import driver as dv

PQ = q.with_(q.H, q.R, q.P)
P_COLS = ["price_sum", "revenue", "disc_avg"]


def _describe_sql(cols, src="P"):
    parts = []
    for c in cols:
        parts.append(
            f"""SELECT '{c}' AS "column", COUNT({c}) AS n, ROUND(AVG({c}), 6) AS mean,
  ROUND(STDDEV_SAMP({c}), 6) AS std, ROUND(CAST(MIN({c}) AS DOUBLE), 6) AS "min",
  ROUND(CAST(MAX({c}) AS DOUBLE), 6) AS "max", ROUND(QUANTILE_CONT({c}, 0.25), 6) AS p25,
  ROUND(QUANTILE_CONT({c}, 0.5), 6) AS p50, ROUND(QUANTILE_CONT({c}, 0.75), 6) AS p75 FROM {src}""")
    return "\nUNION ALL\n".join(parts)


@register("describe", PQ + _describe_sql(P_COLS))
def q_describe(spark, d):
    return rounded(ag.describe(dv.customer_quarter_panel(spark, d), P_COLS))


@register("quantiles_grouped", PQ + """SELECT fy, fp, ROUND(QUANTILE_CONT(price_sum, 0.1), 6) AS p10,
  ROUND(QUANTILE_CONT(price_sum, 0.9), 6) AS p90 FROM P GROUP BY fy, fp""")
def q_quantiles_grouped(spark, d):
    qs = ag.quantiles(dv.customer_quarter_panel(spark, d), ["price_sum"], [0.1, 0.9], by=["fy", "fp"])
    w = qs.groupBy("fy", "fp").pivot("p", [0.1, 0.9]).agg(F.first("value"))
    return rounded(w.select("fy", "fp", F.col("`0.1`").alias("p10"), F.col("`0.9`").alias("p90")))


@register("group_stats", PQ + """SELECT fy, COUNT(*) AS n, ROUND(MEDIAN(revenue), 6) AS revenue_median,
  ROUND(STDDEV_SAMP(revenue), 6) AS revenue_std, ROUND(AVG(CAST(COALESCE(n_orders > 1, false) AS DOUBLE)), 6) AS multi_share
FROM P GROUP BY fy HAVING COUNT(*) >= 100""")
def q_group_stats(spark, d):
    p = dv.customer_quarter_panel(spark, d)
    st = ag.group_stats(p, ["fy"], {"revenue_std": F.stddev_samp("revenue"),
                                    "multi_share": ag.conditional_share(F.col("n_orders") > 1)}, min_n=100)
    med = ag.grouped_medians(p, ["fy"], ["revenue"])
    return rounded(st.join(med, "fy", "left").select("fy", "n", "revenue_median", "revenue_std", "multi_share"))


@register("value_counts", q.with_(q.H) + """SELECT form, COUNT(*) AS n, ROUND(COUNT(*) / SUM(COUNT(*)) OVER (), 6) AS share
FROM H GROUP BY form""")
def q_value_counts(spark, d):
    return rounded(ag.value_counts(dv.header(spark, d), "form"))


@register("dominant_share", q.with_(q.H) + """, L AS (
  SELECT 'form' AS "column", form AS value FROM H UNION ALL
  SELECT 'status', status FROM H UNION ALL SELECT 'fp', fp FROM H),
C AS (SELECT "column", value, COUNT(*) AS n FROM L WHERE value IS NOT NULL GROUP BY ALL)
SELECT "column", ROUND(MAX(n) / SUM(n), 6) AS top_share, COUNT(*) AS n_levels FROM C GROUP BY "column" """)
def q_dominant_share(spark, d):
    return rounded(ag.dominant_share(dv.header(spark, d), ["form", "status", "fp"]))


@register("count_distinct", q.with_(q.H) + """SELECT COUNT(DISTINCT cik) AS n_distinct_cik,
  COUNT(DISTINCT form) AS n_distinct_form, COUNT(DISTINCT fy) AS n_distinct_fy FROM H""")
def q_count_distinct(spark, d):
    return ag.count_distinct(dv.header(spark, d), ["cik", "form", "fy"])


@register("min_max", PQ + """SELECT ROUND(MIN(price_sum), 6) AS price_sum_min, ROUND(MAX(price_sum), 6) AS price_sum_max,
  ROUND(MIN(revenue), 6) AS revenue_min, ROUND(MAX(revenue), 6) AS revenue_max,
  MIN(n_orders) AS n_orders_min, MAX(n_orders) AS n_orders_max FROM P""")
def q_min_max(spark, d):
    return rounded(ag.min_max(dv.customer_quarter_panel(spark, d), ["price_sum", "revenue", "n_orders"]))


COV_COLS = ["revenue", "disc_avg", "price_sum", "n_lines"]


def _coverage_sql(cols, src="P"):
    parts = [f"""SELECT '{c}' AS "column", COUNT({c}) AS n_non_null,
  ROUND(COUNT({c}) * 100.0 / COUNT(*), 6) AS pct_coverage, COUNT(*) - COUNT({c}) AS n_null FROM {src}"""
             for c in cols]
    return "\nUNION ALL\n".join(parts)


@register("coverage", PQ + _coverage_sql(COV_COLS))
def q_coverage(spark, d):
    return rounded(ag.coverage(dv.customer_quarter_panel(spark, d), COV_COLS))


@register("topk_coverage", PQ + "SELECT * FROM (" + _coverage_sql(COV_COLS) + """)
ORDER BY pct_coverage DESC, "column" LIMIT 3""")
def q_topk_coverage(spark, d):
    cov = ag.coverage(dv.customer_quarter_panel(spark, d), COV_COLS)
    return rounded(tk.topk_coverage(cov, 3))


INV = [("cik", "bigint", "meta"), ("fy", "int", "meta"), ("fp", "string", "meta"),
       ("revenue", "double", "xbrl_raw"), ("n_orders", "bigint", "xbrl_raw")]


@register("column_inventory", PQ + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", '{t}' AS dtype, '{fam}' AS family,
  ROUND(100.0 - COUNT({c}) * 100.0 / COUNT(*), 6) AS pct_null, COUNT(DISTINCT {c}) AS n_distinct FROM P"""
    for c, t, fam in INV))
def q_column_inventory(spark, d):
    return rounded(ag.column_inventory(dv.customer_quarter_panel(spark, d), [c for c, _, _ in INV]))


BLOCKS = {"ids": ["cik", "fy", "fp"], "measures": ["revenue", "disc_avg", "price_sum"],
          "counts": ["n_orders", "n_lines"]}


@register("null_by_block", PQ + """, C AS (
""" + "\nUNION ALL\n".join(
    f"SELECT '{b}' AS block, '{c}' AS col, 100.0 - COUNT({c}) * 100.0 / COUNT(*) AS pct_null FROM P"
    for b, cs in BLOCKS.items() for c in cs) + """)
SELECT block, COUNT(*) AS n_cols, ROUND(AVG(pct_null), 6) AS pct_null_avg,
  COUNT(*) FILTER (WHERE pct_null < 20) AS n_low,
  COUNT(*) FILTER (WHERE pct_null >= 20 AND pct_null < 50) AS n_mid,
  COUNT(*) FILTER (WHERE pct_null >= 50) AS n_high FROM C GROUP BY block""")
def q_null_by_block(spark, d):
    return rounded(ag.null_by_block(dv.customer_quarter_panel(spark, d), BLOCKS))


@register("class_share_by_key", RISK_SQL + """, K AS (
  SELECT fy, CASE WHEN target_score_next < 0.35 THEN 0 WHEN target_score_next < 0.65 THEN 1
                  WHEN target_score_next IS NOT NULL THEN 2 END AS cls FROM W)
SELECT fy, COUNT(*) AS n, ROUND(COUNT(*) FILTER (WHERE cls = 0) * 100.0 / COUNT(*), 6) AS pct_0,
  ROUND(COUNT(*) FILTER (WHERE cls = 1) * 100.0 / COUNT(*), 6) AS pct_1,
  ROUND(COUNT(*) FILTER (WHERE cls = 2) * 100.0 / COUNT(*), 6) AS pct_2
FROM K WHERE cls IS NOT NULL GROUP BY fy HAVING COUNT(*) >= 50""")
def q_class_share_by_key(spark, d):
    return rounded(ag.class_share_by_key(risk_panel(spark, d), "fy", "target_class_next", (0, 1, 2), 50))


@register("unstack", RISK_SQL + """SELECT fy,
  COUNT(*) FILTER (WHERE target_class_next = 0) AS "0", COUNT(*) FILTER (WHERE target_class_next = 1) AS "1",
  COUNT(*) FILTER (WHERE target_class_next = 2) AS "2"
FROM (SELECT fy, CASE WHEN target_score_next < 0.35 THEN 0 WHEN target_score_next < 0.65 THEN 1
                      WHEN target_score_next IS NOT NULL THEN 2 END AS target_class_next FROM W)
GROUP BY fy""")
def q_unstack(spark, d):
    from finpanel.operators.reshape import unstack
    return unstack(risk_panel(spark, d), "fy", "target_class_next", [0, 1, 2])


@register("period_summary", RISK_SQL + """, K AS (
  SELECT fp, target_score_next AS s, CASE WHEN target_score_next IS NULL THEN NULL
         WHEN target_score_next >= 0.5 THEN 1 ELSE 0 END AS dist,
         CASE WHEN target_score_next < 0.35 THEN 0 WHEN target_score_next < 0.65 THEN 1
              WHEN target_score_next IS NOT NULL THEN 2 END AS cls FROM W)
SELECT fp, COUNT(*) AS n, ROUND(MEDIAN(s), 6) AS score_next_median, ROUND(AVG(dist) * 100, 6) AS pct_distress,
  ROUND(AVG(CAST(COALESCE(cls = 1, false) AS DOUBLE)) * 100, 6) AS pct_grey,
  ROUND(AVG(CAST(COALESCE(cls = 0, false) AS DOUBLE)) * 100, 6) AS pct_safe
FROM K GROUP BY fp""")
def q_period_summary(spark, d):
    r = risk_panel(spark, d)
    st = ag.group_stats(r, ["fp"], {
        "pct_distress": F.avg("target_distress_next") * 100,
        "pct_grey": ag.conditional_share(F.col("target_class_next") == 1) * 100,
        "pct_safe": ag.conditional_share(F.col("target_class_next") == 0) * 100})
    med = ag.grouped_medians(r, ["fp"], ["target_score_next"]).withColumnRenamed(
        "target_score_next_median", "score_next_median")
    return rounded(st.join(med, "fp", "left").select(
        "fp", "n", "score_next_median", "pct_distress", "pct_grey", "pct_safe"))


@register("conditional_share", RISK_SQL + """SELECT fy,
  ROUND(AVG(CAST(COALESCE(target_score_next < 0.35, false) AS DOUBLE)), 6) AS share_safe FROM W GROUP BY fy""")
def q_conditional_share(spark, d):
    r = risk_panel(spark, d)
    return rounded(r.groupBy("fy").agg(ag.conditional_share(F.col("target_class_next") == 0).alias("share_safe")))


@register("band_distribution", RISK_SQL + """, B AS (SELECT CASE
  WHEN risk >= 0 AND risk < 0.2 THEN 'bajo' WHEN risk >= 0.2 AND risk < 0.45 THEN 'moderado_bajo'
  WHEN risk >= 0.45 AND risk < 0.65 THEN 'moderado_alto' WHEN risk >= 0.65 AND risk < 0.85 THEN 'alto'
  WHEN risk >= 0.85 AND risk < 1.01 THEN 'critico' END AS band FROM W)
SELECT band, COUNT(*) AS n, ROUND(COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (), 6) AS pct FROM B GROUP BY band""")
def q_band_distribution(spark, d):
    return rounded(ag.band_distribution(risk_panel(spark, d), "risk", S.RISK_EDGES, S.RISK_LABELS))


@register("group_median", q.with_(q.S) + """, M AS (SELECT sector, MEDIAN(measure) AS measure_median FROM S
  WHERE measure IS NOT NULL GROUP BY sector)
SELECT sector, ROUND(measure_median, 6) AS measure_median,
  ROUND(STDDEV_SAMP(measure_median) OVER (), 6) AS median_spread FROM M""")
def q_group_median(spark, d):
    med = ag.grouped_medians(dv.sector(spark, d), ["sector"], ["measure"])
    spread = med.agg(F.stddev_samp("measure_median").alias("median_spread"))
    return rounded(ag.attach_scalar(med, spread))


@register("missing_by_group", PQ + """, J AS (SELECT P.*, sector FROM P JOIN (SELECT c_custkey AS cik, c_nationkey AS sector FROM customer) USING (cik)),
G AS (SELECT sector, AVG(CAST(revenue IS NULL AS DOUBLE)) * 100 AS m_rev,
             AVG(CAST(disc_avg IS NULL AS DOUBLE)) * 100 AS m_disc FROM J WHERE sector IS NOT NULL GROUP BY sector)
SELECT 'revenue' AS "column", ROUND((SELECT COUNT(revenue) * 100.0 / COUNT(*) FROM J), 6) AS pct_coverage,
  ROUND(STDDEV_SAMP(m_rev), 6) AS std_missing, COALESCE(STDDEV_SAMP(m_rev) > 15, false) AS structural FROM G
UNION ALL
SELECT 'disc_avg', ROUND((SELECT COUNT(disc_avg) * 100.0 / COUNT(*) FROM J), 6),
  ROUND(STDDEV_SAMP(m_disc), 6), COALESCE(STDDEV_SAMP(m_disc) > 15, false) FROM G""")
def q_missing_by_group(spark, d):
    p = dv.customer_quarter_panel(spark, d).join(dv.sector(spark, d).select("cik", "sector"), "cik")
    return rounded(ag.missing_by_group(p, "sector", ["revenue", "disc_avg"], 15.0))


@register("dup_groups", q.with_(q.H) + """SELECT adsh, cik, fy, fp, dup_n FROM (
  SELECT *, COUNT(*) OVER (PARTITION BY cik, fy, fp) AS dup_n FROM H) WHERE dup_n > 1""")
def q_dup_groups(spark, d):
    return ag.dup_groups(dv.header(spark, d), ["cik", "fy", "fp"]).select("adsh", "cik", "fy", "fp", "dup_n")


@register("year_counts", q.with_(q.H) + """SELECT fy, COUNT(*) AS n,
  CASE WHEN fy <= 1998 THEN 'train' ELSE 'validation' END AS split FROM H GROUP BY fy""")
def q_year_counts(spark, d):
    return ag.year_counts(dv.header(spark, d), "fy", 1998)


@register("pivot_wide", q.with_(q.N) + """, F AS (
  SELECT * FROM N WHERE (tag IN ('AF', 'AO', 'NF', 'NO') AND uom = 'USD') OR (tag IN ('RF', 'RO') AND uom = 'shares')),
D AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY adsh, tag ORDER BY qtrs DESC NULLS LAST, version, supp, value) AS rn FROM F) WHERE rn = 1)
SELECT adsh, """ + ", ".join(f"MAX(CASE WHEN tag = '{t}' THEN value END) AS {t}" for t in dv.DRIVER_TAGS) + ", " +
          ", ".join(f"MAX(CASE WHEN tag = '{t}' THEN qtrs END) AS {t}_qtrs" for t in dv.DRIVER_TAGS) +
          " FROM D GROUP BY adsh")
def q_pivot_wide(spark, d):
    n = filter_uom(dv.facts(spark, d), {"USD": dv.USD_TAGS, "shares": dv.SHARE_TAGS})
    n = pn.dedup_longest(n, ["adsh", "tag"], "qtrs", ["version", "supp", "value"], cols=["qtrs", "value"])
    return ag.pivot_wide(n, "adsh", "tag", dv.DRIVER_TAGS, "value", "qtrs")


@register("sample_rows", q.with_(q.H) + """SELECT * FROM H ORDER BY md5('42|' || CAST(adsh AS VARCHAR)), adsh LIMIT 100""")
def q_sample_rows(spark, d):
    return tk.sample_rows(dv.header(spark, d), "adsh", 100, seed=42)
