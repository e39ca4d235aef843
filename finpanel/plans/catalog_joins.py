"""2.4 joins on the driver views."""

from __future__ import annotations

from pyspark.sql import functions as F

from finpanel.operators import joins as jn
from finpanel.plans import sql as q
from finpanel.plans.registry import register, rounded
from finpanel.sources import driver as dv


@register("join_num_sub", q.with_(q.N, q.H) + """SELECT N.adsh, tag, qtrs, version, supp, value, period
FROM N JOIN H ON N.adsh = H.adsh""")
def q_join_num_sub(spark, d):
    j = jn.join_num_sub(dv.facts(spark, d), dv.header(spark, d), "adsh", ["period"])
    return j.select("adsh", "tag", "qtrs", "version", "supp", "value", "period")


@register("join_meta", q.with_(q.H, q.R) + """SELECT adsh, cik, fy, fp, ROUND(line_revenue, 6) AS line_revenue, n_lines
FROM R JOIN H USING (adsh)""")
def q_join_meta(spark, d):
    j = jn.join_meta(dv.order_revenue(spark, d), dv.header(spark, d).select("adsh", "cik", "fy", "fp"))
    return rounded(j.select("adsh", "cik", "fy", "fp", "line_revenue", "n_lines"))


@register("join_outer_align", q.with_(q.H) + """, A AS (SELECT cik, COUNT(*) AS n_f FROM H WHERE status = 'F' AND fy <= 1997 GROUP BY cik),
B AS (SELECT cik, COUNT(*) AS n_o FROM H WHERE status = 'O' AND fy >= 1999 GROUP BY cik)
SELECT COALESCE(A.cik, B.cik) AS cik, n_f, n_o FROM A FULL OUTER JOIN B ON A.cik = B.cik""")
def q_join_outer_align(spark, d):
    h = dv.header(spark, d)
    a = h.where((F.col("status") == "F") & (F.col("fy") <= 1997)).groupBy("cik").agg(F.count(F.lit(1)).alias("n_f"))
    b = h.where((F.col("status") == "O") & (F.col("fy") >= 1999)).groupBy("cik").agg(F.count(F.lit(1)).alias("n_o"))
    return jn.join_outer_align(a, b, "cik").select("cik", "n_f", "n_o")


@register("join_left_lookup", q.with_(q.S) + """SELECT cik, sector, n_name
FROM S LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) n ON S.sector = n.n_nationkey""")
def q_join_left_lookup(spark, d):
    nat = dv.table(spark, d, "nation").where(F.col("n_regionkey") != 2).select(
        F.col("n_nationkey").alias("sector"), "n_name")
    return jn.join_left_lookup(dv.sector(spark, d), nat, "sector").select("cik", "sector", "n_name")


@register("semi_anti_groups", q.with_(q.H, q.S) + """SELECT adsh, cik FROM H
WHERE cik NOT IN (SELECT cik FROM S WHERE balance < 0)""")
def q_semi_anti_groups(spark, d):
    keys = dv.sector(spark, d).where(F.col("balance") < 0).select("cik")
    return jn.semi_anti_groups(dv.header(spark, d), keys, "cik", how="anti").select("adsh", "cik")


@register("semi_groups", q.with_(q.H, q.S) + """SELECT adsh, cik FROM H
WHERE cik IN (SELECT cik FROM S WHERE balance < 0)""")
def q_semi_groups(spark, d):
    keys = dv.sector(spark, d).where(F.col("balance") < 0).select("cik")
    return jn.semi_anti_groups(dv.header(spark, d), keys, "cik", how="semi").select("adsh", "cik")


@register("concat_columns", q.with_(q.H) + """SELECT adsh,
  CAST(CAST(status = 'F' AS INTEGER) AS TINYINT) AS st_F,
  CAST(CAST(status = 'O' AS INTEGER) AS TINYINT) AS st_O,
  CAST(CAST(status = 'P' AS INTEGER) AS TINYINT) AS st_P FROM H""")
def q_concat_columns(spark, d):
    h = dv.header(spark, d)
    out = jn.concat_columns(h, {f"st_{s}": (F.col("status") == s).cast("int").cast("byte") for s in "FOP"})
    return out.select("adsh", "st_F", "st_O", "st_P")
