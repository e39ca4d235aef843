"""DuckDB oracle building blocks: the driver views as CTEs (mirror of sources/driver.py)."""

H = """H AS (
  SELECT o_orderkey AS adsh, o_custkey AS cik, o_orderpriority AS form,
         CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS period,
         CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS filed,
         CAST(year(o_orderdate) AS INTEGER) AS fy,
         CASE quarter(o_orderdate) WHEN 1 THEN 'Q1' WHEN 2 THEN 'Q2' WHEN 3 THEN 'Q3' ELSE 'FY' END AS fp,
         o_totalprice AS price, o_orderstatus AS status
  FROM orders)"""

N = """N AS (
  SELECT l_orderkey AS adsh, l_returnflag || l_linestatus AS tag, l_partkey AS version,
         l_suppkey AS supp, CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS ddate,
         CAST(year(l_shipdate) AS INTEGER) AS dyear, l_linenumber AS qtrs,
         CASE WHEN l_suppkey % 2 = 0 THEN 'USD' ELSE 'shares' END AS uom,
         l_extendedprice AS value,
         CASE WHEN l_quantity > 40 THEN 'seg' END AS segments, l_discount AS discount
  FROM lineitem)"""

S = """S AS (
  SELECT c_custkey AS cik, c_nationkey AS sector, c_mktsegment AS segment,
         CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS measure, c_acctbal AS balance
  FROM customer)"""

R = """R AS (
  SELECT l_orderkey AS adsh, SUM(l_extendedprice * (1 - l_discount)) AS line_revenue,
         SUM(l_discount) AS disc_sum, COUNT(*) AS n_lines
  FROM lineitem GROUP BY l_orderkey)"""

P = """P AS (
  SELECT cik, fy, fp, COUNT(*) AS n_orders, SUM(price) AS price_sum,
         SUM(line_revenue) AS revenue, CAST(SUM(n_lines) AS BIGINT) AS n_lines,
         SUM(disc_sum) / NULLIF(SUM(n_lines), 0) AS disc_avg, MAX(filed) AS filed,
         CASE fp WHEN 'Q1' THEN 1 WHEN 'Q2' THEN 2 WHEN 'Q3' THEN 3 WHEN 'FY' THEN 4 END AS fp_ord
  FROM H LEFT JOIN R USING (adsh)
  GROUP BY cik, fy, fp)"""

T = """T AS (
  SELECT user_id, CAST(ts AS DATE) AS day, SUM(value) AS value, COUNT(*) AS n_events
  FROM events GROUP BY user_id, CAST(ts AS DATE))"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def r(expr: str, digits: int = 6) -> str:
    return f"ROUND({expr}, {digits})"
