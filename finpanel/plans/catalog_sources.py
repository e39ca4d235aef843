"""2.1 sources and sinks: round trips of driver-derived tables through the readers.

Each query writes a table Spark derives from the driver tables into the shared
checkpoint folder (``spark.checkpoint.dir``/stages) and reads it back through the
operator under test.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from finpanel.plans import sql as q
from finpanel.plans.registry import register, rounded
from finpanel.sources import driver as dv
from finpanel.sources import files as fs

QTR_SQL = "CAST(fy AS VARCHAR) || 'Q' || CAST(quarter(strptime(CAST(period AS VARCHAR), '%Y%m%d')) AS VARCHAR)"


def _header_with_quarter(spark, d):
    h = dv.header(spark, d)
    return h.withColumn("quarter", fs.quarter_label(F.to_date(F.col("period").cast("string"), "yyyyMMdd")))


def _stage(spark, d, name):
    tag = d.rstrip("/").split("/")[-1]
    return fs.stage_path(spark, f"{name}_{tag}")


@register("quarter_range", """SELECT CAST(year(d) AS VARCHAR) || 'Q' || CAST(quarter(d) AS VARCHAR) AS quarter
FROM (SELECT UNNEST(generate_series(date_trunc('quarter', MIN(o_orderdate)), date_trunc('quarter', MAX(o_orderdate)),
                                    INTERVAL 3 MONTH)) AS d FROM orders)""")
def q_quarter_range(spark, d):
    return fs.quarter_range_of(dv.table(spark, d, "orders"), "o_orderdate")


@register("read_tsv", q.with_(q.H) + """SELECT adsh, cik, form, period, fy, fp, price,
  """ + QTR_SQL + " AS quarter FROM H")
def q_read_tsv(spark, d):
    path = _stage(spark, d, "header_tsv")
    fs.write_tsv(_header_with_quarter(spark, d).drop("filed", "status"), path, ["quarter"])
    t = fs.read_tsv(spark, path)
    return t.select(F.col("adsh").try_cast("bigint").alias("adsh"), F.col("cik").try_cast("bigint").alias("cik"),
                    "form", F.col("period").try_cast("int").alias("period"),
                    F.col("fy").try_cast("int").alias("fy"), "fp",
                    F.col("price").try_cast("double").alias("price"), F.col("quarter").cast("string").alias("quarter"))


@register("read_sub", q.with_(q.H) + """SELECT CAST(adsh AS VARCHAR) AS adsh, CAST(cik AS VARCHAR) AS cik,
  CAST(NULL AS VARCHAR) AS name, CAST(NULL AS VARCHAR) AS sic, form, period, filed, fy, fp,
  CAST(NULL AS VARCHAR) AS fye, CAST(NULL AS VARCHAR) AS countryba, CAST(NULL AS VARCHAR) AS stprba
FROM H WHERE form IN ('1-URGENT', '2-HIGH')""")
def q_read_sub(spark, d):
    path = _stage(spark, d, "sub_tsv")
    fs.write_tsv(dv.header(spark, d).select("adsh", "cik", "form", "period", "filed", "fy", "fp"), path)
    return fs.read_sub(spark, path, forms=["1-URGENT", "2-HIGH"])


@register("read_num", q.with_(q.N) + """SELECT CAST(adsh AS VARCHAR) AS adsh, tag, CAST(version AS VARCHAR) AS version,
  ddate, qtrs, uom, value, segments, CAST(NULL AS VARCHAR) AS coreg FROM N""")
def q_read_num(spark, d):
    path = _stage(spark, d, "num_parquet")
    n = dv.facts(spark, d)
    raw = n.select(F.col("adsh").cast("string").alias("adsh"), "tag", F.col("version").cast("string").alias("version"),
                   F.col("ddate").cast("string").alias("ddate"), F.col("qtrs").cast("string").alias("qtrs"), "uom",
                   F.col("value").cast("string").alias("value"), "segments",
                   fs.quarter_label(F.to_date(F.col("ddate").cast("string"), "yyyyMMdd")).alias("quarter"))
    fs.write_converted(raw, path)
    return fs.read_num(spark, path).select(*[c for c in
                                             ["adsh", "tag", "version", "ddate", "qtrs", "uom", "value", "segments", "coreg"]])


@register("quarter_scan", q.with_(q.H) + """SELECT adsh, fy, quarter FROM (SELECT adsh, fy, """ + QTR_SQL +
          """ AS quarter FROM H) WHERE quarter BETWEEN '1996Q1' AND '1997Q4'""")
def q_quarter_scan(spark, d):
    path = _stage(spark, d, "header_by_quarter")
    fs.write_converted(_header_with_quarter(spark, d).select("adsh", "fy", "quarter"), path)
    return fs.quarter_scan(spark, path, "1996Q1", "1997Q4").select("adsh", "fy", F.col("quarter").cast("string"))


@register("write_converted", q.with_(q.H) + "SELECT " + QTR_SQL + " AS quarter, COUNT(*) AS n FROM H GROUP BY 1")
def q_write_converted(spark, d):
    path = _stage(spark, d, "header_converted")
    fs.write_converted(_header_with_quarter(spark, d), path)
    t = spark.read.parquet(path)
    return t.groupBy(F.col("quarter").cast("string").alias("quarter")).agg(F.count(F.lit(1)).alias("n"))


@register("read_panel", q.with_(q.H, q.R, q.P) + """SELECT cik, fy, fp, n_orders, ROUND(price_sum, 6) AS price_sum,
  ROUND(revenue, 6) AS revenue FROM P""")
def q_read_panel(spark, d):
    path = _stage(spark, d, "panel_by_fy")
    fs.write_panel(dv.customer_quarter_panel(spark, d).select("cik", "fy", "fp", "n_orders", "price_sum", "revenue"),
                   path, partition_by=["fy"])
    p = fs.read_panel(spark, path)
    return rounded(p.select("cik", F.col("fy").cast("int").alias("fy"), "fp", "n_orders", "price_sum", "revenue"))


@register("write_panel", q.with_(q.H, q.R, q.P) + """SELECT cik, fy, fp, n_orders, ROUND(price_sum, 6) AS price_sum,
  ROUND(revenue, 6) AS revenue, n_lines, ROUND(disc_avg, 6) AS disc_avg, filed, fp_ord FROM P""")
def q_write_panel(spark, d):
    """CSV sink (partitioned by fy) read back with the panel's own schema."""
    path = _stage(spark, d, "panel_csv")
    p = dv.customer_quarter_panel(spark, d)
    fs.write_panel(p, path, fmt="csv", partition_by=["fy"])
    back = fs.read_panel(spark, path, schema=p.drop("fy").schema, fmt="csv")
    return rounded(back.select(*[F.col(c).cast("int").alias(c) if c == "fy" else F.col(c) for c in p.columns]))


@register("read_tag_pre", """SELECT p_name AS tag, p_brand AS version, CAST(NULL AS VARCHAR) AS custom,
  CAST(NULL AS VARCHAR) AS abstract, p_type AS datatype, p_name AS tlabel, CAST(NULL AS VARCHAR) AS doc FROM part""")
def q_read_tag_pre(spark, d):
    path = _stage(spark, d, "tag_tsv")
    p = dv.table(spark, d, "part")
    fs.write_tsv(p.select(F.col("p_name").alias("tag"), F.col("p_brand").alias("version"),
                          F.col("p_type").alias("datatype"), F.col("p_name").alias("tlabel")), path)
    return fs.read_tag_pre(spark, path, "tag")


@register("ingest_manifest", q.with_(q.H) + "SELECT " + QTR_SQL + """ AS quarter, COUNT(*) AS "rows",
  10 AS "columns", 'ok' AS status FROM H GROUP BY 1""")
def q_ingest_manifest(spark, d):
    """Per-file manifest of a converted table, summed per quarter (file names and byte
    sizes depend on the writer, rows and columns do not)."""
    path = _stage(spark, d, "manifest_src")
    fs.write_converted(_header_with_quarter(spark, d), path)
    m = fs.ingest_manifest(spark.read.parquet(path), path, "quarter")
    return (m.groupBy(F.col("quarter").cast("string").alias("quarter"))
             .agg(F.sum("rows").alias("rows"), F.max("columns").alias("columns"),
                  F.when(F.min(F.col("status") == "ok"), "ok").otherwise("empty").alias("status")))


@register("write_metrics", q.with_(q.H, q.R, q.P) + """SELECT 'coverage' AS section, 'revenue' AS name,
  ROUND(COUNT(revenue) * 100.0 / COUNT(*), 6) AS value FROM P UNION ALL
SELECT 'coverage', 'disc_avg', ROUND(COUNT(disc_avg) * 100.0 / COUNT(*), 6) FROM P UNION ALL
SELECT 'coverage', 'price_sum', ROUND(COUNT(price_sum) * 100.0 / COUNT(*), 6) FROM P UNION ALL
SELECT 'rows', 'header', CAST(COUNT(*) AS DOUBLE) FROM H""")
def q_write_metrics(spark, d):
    from finpanel.operators.aggregates import coverage
    cov = coverage(dv.customer_quarter_panel(spark, d), ["revenue", "disc_avg", "price_sum"])
    m1 = cov.select(F.lit("coverage").alias("section"), F.col("column").alias("name"),
                    F.col("pct_coverage").alias("value"))
    m2 = dv.header(spark, d).agg(F.count(F.lit(1)).cast("double").alias("value")).select(
        F.lit("rows").alias("section"), F.lit("header").alias("name"), "value")
    path = _stage(spark, d, "metrics")
    fs.write_metrics([m1, m2], path)
    return rounded(spark.read.parquet(path))
