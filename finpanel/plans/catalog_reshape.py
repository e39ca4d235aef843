"""2.8 set operations and reshaping, 2.1 column housekeeping."""

from __future__ import annotations

from pyspark.sql import functions as F

from finpanel import functions as fx
from finpanel import schema as S
from finpanel.operators import reshape as rs
from finpanel.plans import sql as q
from finpanel.plans.catalog_scalar import SIC_SQL, _division_sql, _prefix_sql, _sic
from finpanel.plans.registry import register, rounded
from finpanel.sources import driver as dv

PQ = q.with_(q.H, q.R, q.P)


@register("union_quarters", q.with_(q.H) + """SELECT adsh, cik, price, CAST(NULL AS VARCHAR) AS status FROM H WHERE fy <= 1997
UNION ALL SELECT adsh, cik, CAST(NULL AS DOUBLE) AS price, status FROM H WHERE fy > 1997""")
def q_union_quarters(spark, d):
    h = dv.header(spark, d)
    a = h.where(F.col("fy") <= 1997).select("adsh", "cik", "price")
    b = h.where(F.col("fy") > 1997).select("adsh", "cik", "status")
    return rs.union_quarters([a, b])


@register("union_all", q.with_(q.H) + """SELECT adsh, status FROM H WHERE status = 'F'
UNION ALL SELECT adsh, status FROM H WHERE status = 'O'""")
def q_union_all(spark, d):
    h = dv.header(spark, d).select("adsh", "status")
    return rs.union_all(h.where(F.col("status") == "F"), h.where(F.col("status") == "O"))


@register("melt", PQ + """SELECT cik, fy, fp, 'price_sum' AS variable, ROUND(price_sum, 6) AS value FROM P
UNION ALL SELECT cik, fy, fp, 'revenue', ROUND(revenue, 6) FROM P""")
def q_melt(spark, d):
    p = dv.customer_quarter_panel(spark, d)
    return rounded(rs.melt(p, ["cik", "fy", "fp"], ["price_sum", "revenue"]))


@register("one_hot", q.with_(q.H) + "SELECT adsh, " + ", ".join(
    f"CAST(CAST(({_division_sql(_prefix_sql(SIC_SQL))}) = '{lv}' AS INTEGER) AS TINYINT) AS \"fe_sic_div_{lv}\""
    for lv in S.SIC_DIVISION_LABELS) + " FROM H")
def q_one_hot(spark, d):
    h = dv.header(spark, d).withColumn("division", fx.range_code(fx.code_prefix(_sic()), S.SIC_DIVISIONS))
    out = rs.one_hot(h, "division", S.SIC_DIVISION_LABELS, "fe_sic_div_")
    return out.select("adsh", *[f"fe_sic_div_{lv}" for lv in S.SIC_DIVISION_LABELS])


@register("drop_dup_suffix", q.with_(q.H) + "SELECT adsh, cik, price FROM H")
def q_drop_dup_suffix(spark, d):
    h = dv.header(spark, d).select("adsh", "cik", "price", F.col("price").alias("price.1"),
                                   F.col("cik").alias("cik.2"))
    return rs.drop_dup_suffix(h)


@register("order_columns", PQ + "SELECT cik, fy, fp, n_orders, n_lines, ROUND(price_sum, 6) AS price_sum, "
          "ROUND(revenue, 6) AS revenue FROM P")
def q_order_columns(spark, d):
    p = dv.customer_quarter_panel(spark, d).select("revenue", "n_lines", "fp", "cik", "price_sum", "fy", "n_orders")
    return rounded(rs.order_columns(p, [["cik", "fy", "fp"], "sorted:^n_", "sorted:.*"]))


@register("rename_cols", PQ + """SELECT cik AS entity, fy, fp, ROUND(revenue, 6) AS "_PODADA_revenue",
  ROUND(disc_avg, 6) AS "_PODADA_disc_avg" FROM P""")
def q_rename_cols(spark, d):
    p = dv.customer_quarter_panel(spark, d).select("cik", "fy", "fp", "revenue", "disc_avg")
    return rounded(rs.rename_cols(p, {"cik": "entity"}, prefix="_PODADA_", cols=["revenue", "disc_avg"]))


@register("column_contract", """""" + PQ.replace("SELECT", "SELECT", 1).rstrip() + """ SELECT * FROM (WITH C AS (
  SELECT column_name, n_present FROM (UNPIVOT (SELECT COUNT(COLUMNS(*)) FROM P) ON COLUMNS(*) INTO NAME column_name VALUE n_present)),
Req AS (SELECT * FROM (VALUES ('cik'), ('fy'), ('fp'), ('revenue'), ('Assets')) t(c))
SELECT c AS "column", 'missing' AS status, CAST(0 AS BIGINT) AS n_present FROM Req WHERE c NOT IN (SELECT column_name FROM C)
UNION ALL SELECT column_name, 'extra', n_present FROM C WHERE column_name NOT IN (SELECT c FROM Req)
  AND regexp_matches(column_name, '^n_')
UNION ALL SELECT column_name, 'ok', n_present FROM C WHERE column_name IN (SELECT c FROM Req))""")
def q_column_contract(spark, d):
    p = dv.customer_quarter_panel(spark, d)
    from finpanel.operators.aggregates import coverage
    found = rs.column_contract(p, ["cik", "fy", "fp", "revenue", "Assets"], pattern="^n_")
    present = coverage(p, p.columns).select("column", F.col("n_non_null").alias("n_present"))
    return found.join(present, "column", "left").fillna(0, ["n_present"])
