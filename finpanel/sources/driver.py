"""The driver tables viewed as filing panels (FIXTURES.md part B).

Each view is a projection over one parquet table (column pruning and filters reach
the scan). The mapping is fixed here once and mirrored by the oracle SQL.

  header  (H)  orders   -> one filing per order
  facts   (N)  lineitem -> long facts per order line
  sector  (S)  customer -> sector = nation, measure = balance (negative -> NULL)
  time    (T)  events   -> user x day panel
  vectors (V)  embeddings
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finpanel.functions.scalar import date_to_yyyymmdd

# FIXED VALUES — driver-view mapping
USD_TAGS = ["AF", "AO", "NF", "NO"]
SHARE_TAGS = ["RF", "RO"]
DRIVER_TAGS = USD_TAGS + SHARE_TAGS
SEGMENT_QTY = 40.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fiscal_period(ts) -> "F.Column":
    q = F.quarter(ts)
    return (F.when(q == 1, "Q1").when(q == 2, "Q2").when(q == 3, "Q3").otherwise("FY"))


def header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H: adsh=o_orderkey, cik=o_custkey, form=o_orderpriority, period=filed=yyyymmdd."""
    o = table(spark, sf_dir, "orders")
    ymd = date_to_yyyymmdd(F.col("o_orderdate"))
    return o.select(
        F.col("o_orderkey").alias("adsh"),
        F.col("o_custkey").alias("cik"),
        F.col("o_orderpriority").alias("form"),
        ymd.alias("period"),
        ymd.alias("filed"),
        F.year("o_orderdate").alias("fy"),
        fiscal_period(F.col("o_orderdate")).alias("fp"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderstatus").alias("status"),
    )


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N: one fact per order line; tag = returnflag||linestatus, qtrs = line number."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("adsh"),
        F.concat(F.col("l_returnflag"), F.col("l_linestatus")).alias("tag"),
        F.col("l_partkey").alias("version"),
        F.col("l_suppkey").alias("supp"),
        date_to_yyyymmdd(F.col("l_shipdate")).alias("ddate"),
        F.year("l_shipdate").alias("dyear"),
        F.col("l_linenumber").alias("qtrs"),
        F.when(F.col("l_suppkey") % 2 == 0, "USD").otherwise("shares").alias("uom"),
        F.col("l_extendedprice").alias("value"),
        F.when(F.col("l_quantity") > SEGMENT_QTY, "seg").alias("segments"),
        F.col("l_discount").alias("discount"),
    )


def sector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S: entity = customer, sector = nation, measure = balance with negatives as NULL."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("cik"),
        F.col("c_nationkey").alias("sector"),
        F.col("c_mktsegment").alias("segment"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("measure"),
        F.col("c_acctbal").alias("balance"),
    )


def time_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T: user x day, summed value and event count."""
    e = table(spark, sf_dir, "events")
    return (e.groupBy(F.col("user_id"), F.to_date("ts").alias("day"))
             .agg(F.sum("value").alias("value"), F.count(F.lit(1)).alias("n_events")))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")


def order_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line revenue per order: partial aggregate before any join (4 lines -> 1 row)."""
    li = table(spark, sf_dir, "lineitem")
    return (li.groupBy(F.col("l_orderkey").alias("adsh"))
              .agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("line_revenue"),
                   F.sum("l_discount").alias("disc_sum"),
                   F.count(F.lit(1)).alias("n_lines")))


def customer_quarter_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P: one row per (customer, fiscal year, fiscal period).

    lineitem is reduced to one row per order first, left-joined to orders (orders
    without lines keep NULL revenue), then grouped by (cik, fy, fp).
    """
    h = header(spark, sf_dir)
    rev = order_revenue(spark, sf_dir)
    j = h.join(rev, "adsh", "left")
    return (j.groupBy("cik", "fy", "fp")
             .agg(F.count(F.lit(1)).alias("n_orders"),
                  F.sum("price").alias("price_sum"),
                  F.sum("line_revenue").alias("revenue"),
                  F.sum("n_lines").alias("n_lines"),
                  F.try_divide(F.sum("disc_sum"), F.sum("n_lines")).alias("disc_avg"),
                  F.max("filed").alias("filed"))
             .withColumn("fp_ord", F.when(F.col("fp") == "Q1", 1).when(F.col("fp") == "Q2", 2)
                         .when(F.col("fp") == "Q3", 3).when(F.col("fp") == "FY", 4)))
