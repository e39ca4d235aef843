"""The driver tables run through Entry 1 and mapped onto financial tag names.

orders -> filing header, lineitem -> facts (6 tags), consolidate, keep the latest
filing per (customer, fiscal year, period), then name the tag columns after the XBRL
roles the feature blocks read. Unmapped tags stay absent (read as NULL).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finpanel.plans.consolidate import clean_panel, consolidate
from finpanel.sources import driver as dv

# FIXED VALUES — driver filing panel: valid "forms", meta columns, role mapping
DRIVER_FORMS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]
DRIVER_META = ["adsh", "cik", "form", "period", "filed", "fy", "fp", "price"]
# role -> (driver expression in Spark terms, DuckDB expression)
ROLES = {
    "Assets": ("price", "price"),
    "AssetsCurrent": ("AF", "AF"),
    "LiabilitiesCurrent": ("AO", "AO"),
    "Liabilities": ("NF", "NF"),
    "StockholdersEquity": ("NO - NF", "NO - NF"),
    "RetainedEarningsAccumulatedDeficit": ("AF - AO", "AF - AO"),
    "CashAndCashEquivalentsAtCarryingValue": ("NO", "NO"),
    "InventoryNet": ("AO * 0.25", "AO * 0.25"),
    "Revenues": ("NO", "NO"),
    "Revenues_qtrs": ("NO_qtrs", "NO_qtrs"),
    "RevenueFromContractWithCustomerExcludingAssessedTax": ("AF", "AF"),
    "RevenueFromContractWithCustomerExcludingAssessedTax_qtrs": ("AF_qtrs", "AF_qtrs"),
    "NetIncomeLoss": ("NO - AO", "NO - AO"),
    "NetIncomeLoss_qtrs": ("NO_qtrs", "NO_qtrs"),
    "OperatingIncomeLoss": ("AF - NF", "AF - NF"),
    "OperatingIncomeLoss_qtrs": ("AF_qtrs", "AF_qtrs"),
    "GrossProfit": ("AF * 0.4", "AF * 0.4"),
    "GrossProfit_qtrs": ("AF_qtrs", "AF_qtrs"),
    "NetCashProvidedByUsedInOperatingActivities": ("NF - NO", "NF - NO"),
    "NetCashProvidedByUsedInOperatingActivities_qtrs": ("NF_qtrs", "NF_qtrs"),
    "NetCashProvidedByUsedInInvestingActivities": ("AO - AF", "AO - AF"),
    "NetCashProvidedByUsedInInvestingActivities_qtrs": ("AO_qtrs", "AO_qtrs"),
    "InterestExpense": ("AO * 0.05", "AO * 0.05"),
    "DepreciationAndAmortization": ("NF * 0.1", "NF * 0.1"),
    "LongTermDebt": ("AO", "AO"),
    "DebtCurrent": ("NF * 0.2", "NF * 0.2"),
    "PaymentsToAcquirePropertyPlantAndEquipment": ("RO * 0.1", "RO * 0.1"),
    "CommonStockSharesOutstanding": ("RF", "RF"),
    "WeightedAverageNumberOfSharesOutstandingBasic": ("RF", "RF"),
    "WeightedAverageNumberOfDilutedSharesOutstanding": ("RO", "RO"),
}
SIC_EXPR = ("lpad(cast((cik * 37) % 10000 as string), 4, '0')",
            "lpad(CAST((cik * 37) % 10000 AS VARCHAR), 4, '0')")


def raw_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entry 1 on the driver tables: one row per order with its 6 tag values + durations."""
    return consolidate(
        dv.facts(spark, sf_dir), dv.header(spark, sf_dir), tags=dv.DRIVER_TAGS,
        unit_rules={"USD": dv.USD_TAGS, "shares": dv.SHARE_TAGS}, forms=DRIVER_FORMS,
        meta_cols=DRIVER_META, current=("dyear", "fy"), join_cols=("fy",),
        tie=("version", "supp", "value"))


_ANY = "coalesce(AF, NO, AO, NF)"
_ANY_QTRS = "coalesce(AF_qtrs, NO_qtrs, AO_qtrs, NF_qtrs)"
#: Of the tags above an order seldom has more than one or two, so no row would have all five
#: Altman parts. For the modelling entries these roles come from whichever tag it has.
DENSE_ROLES = {r: e for r, (e, _) in ROLES.items()} | {
    "AssetsCurrent": f"{_ANY} * (0.5 + 0.01 * {_ANY_QTRS})", "LiabilitiesCurrent": f"{_ANY} * 0.4",
    "Liabilities": f"{_ANY} * 0.8", "StockholdersEquity": f"price - {_ANY} * 0.8",
    "RetainedEarningsAccumulatedDeficit": f"price * 0.2 - {_ANY} * 0.3",
    "OperatingIncomeLoss": f"{_ANY} - price * 0.3", "OperatingIncomeLoss_qtrs": _ANY_QTRS,
    "Revenues": _ANY, "Revenues_qtrs": _ANY_QTRS,
}


def financial_panel(spark: SparkSession, sf_dir: str, roles: dict[str, str] | None = None) -> DataFrame:
    """Latest filing per (customer, fy, fp) with XBRL-named columns (``roles``: role -> expression)."""
    roles = roles or {r: e for r, (e, _) in ROLES.items()}
    p = clean_panel(raw_panel(spark, sf_dir))
    return p.select("adsh", "cik", "form", "period", "filed", "fy", "fp",
                    F.expr(SIC_EXPR[0]).alias("sic"),
                    *[F.expr(e).alias(r) for r, e in roles.items()])


RAW_SQL_CTES = """N AS (
  SELECT l_orderkey AS adsh, l_returnflag || l_linestatus AS tag, l_partkey AS version,
         l_suppkey AS supp, CAST(year(l_shipdate) AS INTEGER) AS dyear, l_linenumber AS qtrs,
         CASE WHEN l_suppkey % 2 = 0 THEN 'USD' ELSE 'shares' END AS uom,
         l_extendedprice AS value, CASE WHEN l_quantity > 40 THEN 'seg' END AS segments
  FROM lineitem),
H AS (
  SELECT o_orderkey AS adsh, o_custkey AS cik, o_orderpriority AS form,
         CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS period,
         CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS filed,
         CAST(year(o_orderdate) AS INTEGER) AS fy,
         CASE quarter(o_orderdate) WHEN 1 THEN 'Q1' WHEN 2 THEN 'Q2' WHEN 3 THEN 'Q3' ELSE 'FY' END AS fp,
         o_totalprice AS price
  FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED')),
FN AS (
  SELECT N.* FROM N JOIN H ON N.adsh = H.adsh
  WHERE N.tag IN ('AF', 'AO', 'NF', 'NO', 'RF', 'RO') AND (N.segments IS NULL OR TRIM(N.segments) = '')
    AND ((N.tag IN ('AF', 'AO', 'NF', 'NO') AND N.uom = 'USD') OR (N.tag IN ('RF', 'RO') AND N.uom = 'shares'))
    AND N.dyear = H.fy),
DL AS (
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY adsh, tag
                 ORDER BY qtrs DESC NULLS LAST, version, supp, value) AS rn FROM FN) WHERE rn = 1),
PW AS (
  SELECT adsh, """ + ", ".join(f"MAX(CASE WHEN tag = '{t}' THEN value END) AS {t}" for t in dv.DRIVER_TAGS) + ",\n    " \
    + ", ".join(f"MAX(CASE WHEN tag = '{t}' THEN qtrs END) AS {t}_qtrs" for t in dv.DRIVER_TAGS) + """
  FROM DL GROUP BY adsh),
RAW AS (SELECT H.adsh, H.cik, H.form, H.period, H.filed, H.fy, H.fp, H.price, """ + \
    ", ".join(dv.DRIVER_TAGS) + ", " + ", ".join(f"{t}_qtrs" for t in dv.DRIVER_TAGS) + """
  FROM PW JOIN H ON PW.adsh = H.adsh)"""


def fin_sql_ctes(roles: dict[str, str]) -> str:
    """The latest filing per (customer, fy, fp) with ``roles`` (role -> SQL expression)."""
    return RAW_SQL_CTES + """,
CL AS (
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY cik, fy, fp
                 ORDER BY filed DESC NULLS FIRST, adsh DESC) AS rn2 FROM RAW) WHERE rn2 = 1),
FIN AS (
  SELECT adsh, cik, form, period, filed, fy, fp, """ + SIC_EXPR[1] + """ AS sic,
    """ + ",\n    ".join(f"{e} AS {r}" for r, e in roles.items()) + """
  FROM CL)"""


FIN_SQL_CTES = fin_sql_ctes({r: e for r, (_, e) in ROLES.items()})
#: The dense roles, written alike in both dialects.
DENSE_SQL_CTES = fin_sql_ctes({r: e if r not in ROLES or e != ROLES[r][0] else ROLES[r][1] for r, e in DENSE_ROLES.items()})
