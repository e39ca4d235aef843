"""2.2 scalar functions, each exercised on a driver view next to its DuckDB twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from finpanel import functions as fx
from finpanel import schema as S
from finpanel.plans import sql as q
from finpanel.plans.registry import register, rounded
from finpanel.sources import driver as dv

# name -> (view, key columns, spark column builder, DuckDB expression)
_VIEWS = {
    "P": (dv.customer_quarter_panel, q.with_(q.H, q.R, q.P), ["cik", "fy", "fp"]),
    "H": (dv.header, q.with_(q.H), ["adsh"]),
    "N": (dv.facts, q.with_(q.N), ["adsh", "tag", "qtrs", "version", "supp"]),
}

SIC_SQL = "lpad(CAST((cik * 37) % 10000 AS VARCHAR), 4, '0')"


def _sic():
    return F.lpad(((F.col("cik") * 37) % 10000).cast("string"), 4, "0")


def _prefix_sql(x: str) -> str:
    return f"TRY_CAST(SUBSTRING(CAST(TRY_CAST(TRY_CAST({x} AS DOUBLE) AS BIGINT) AS VARCHAR), 1, 2) AS INTEGER)"


def _division_sql(x: str) -> str:
    return (f"CASE WHEN {x} <= 9 THEN 'A' WHEN {x} <= 14 THEN 'B' WHEN {x} <= 17 THEN 'C' "
            f"WHEN {x} <= 39 THEN 'D' WHEN {x} <= 49 THEN 'E' WHEN {x} <= 51 THEN 'F' "
            f"WHEN {x} <= 59 THEN 'G' WHEN {x} <= 67 THEN 'H' WHEN {x} <= 89 THEN 'I' "
            f"WHEN {x} <= 99 THEN 'J' ELSE 'UNKNOWN' END")


def _flag_sql(cond: str, ref: str) -> str:
    return f"CASE WHEN {ref} IS NULL THEN NULL WHEN {cond} THEN 1 ELSE 0 END"


SCALARS = {
    "coerce_numeric": ("H", lambda: [
        fx.coerce_numeric(F.substring("form", 1, 1)).alias("form_num"),
        fx.coerce_numeric("form").alias("form_bad"),
        fx.coerce_numeric(F.concat(F.col("period").cast("string"), F.lit(".0")), "int").alias("period_int")],
        "TRY_CAST(SUBSTRING(form, 1, 1) AS DOUBLE) AS form_num, TRY_CAST(form AS DOUBLE) AS form_bad, "
        "TRY_CAST(TRY_CAST(CAST(period AS VARCHAR) || '.0' AS DOUBLE) AS INTEGER) AS period_int"),
    "qtrs_default": ("N", lambda: [
        fx.qtrs_default(F.when(F.col("qtrs") <= 5, F.col("qtrs").cast("string"))).alias("qtrs_d")],
        "COALESCE(TRY_CAST(TRY_CAST(CASE WHEN qtrs <= 5 THEN CAST(qtrs AS VARCHAR) END AS DOUBLE) AS INTEGER), -1) AS qtrs_d"),
    "norm_text": ("H", lambda: [
        fx.norm_text(F.concat(F.lit("  "), F.lower("status"), F.lit(" "))).alias("status_norm")],
        "UPPER(TRIM('  ' || LOWER(status) || ' ')) AS status_norm"),
    "safe_div": ("P", lambda: [fx.safe_div("price_sum", F.col("n_orders") - 1).alias("price_per_extra")],
                 "ROUND(price_sum / NULLIF(n_orders - 1, 0), 6) AS price_per_extra"),
    "eps_div": ("P", lambda: [fx.eps_div("n_lines", "n_orders").alias("lines_per_order")],
                "ROUND(n_lines / (n_orders + 1e-9), 6) AS lines_per_order"),
    "coalesce_pair": ("P", lambda: [fx.coalesce_pair("revenue", "price_sum").alias("rev_or_price")],
                      "ROUND(COALESCE(revenue, price_sum), 6) AS rev_or_price"),
    "zero_fill": ("P", lambda: [fx.zero_fill("revenue").alias("revenue_z")],
                  "ROUND(COALESCE(revenue, 0.0), 6) AS revenue_z"),
    "map_codes": ("H", lambda: [fx.map_codes("status", {"F": 1, "O": 2}, default=99).alias("status_code"),
                                fx.map_codes("fp", {"Q1": 1, "Q2": 2, "Q3": 3}).alias("fp_code")],
                  "CASE status WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 99 END AS status_code, "
                  "CASE fp WHEN 'Q1' THEN 1 WHEN 'Q2' THEN 2 WHEN 'Q3' THEN 3 END AS fp_code"),
    "period_label": ("H", lambda: [fx.period_label("fy", "fp").alias("periodo")],
                     "CAST(fy AS VARCHAR) || '-' || fp AS periodo"),
    "day_lag": ("N", lambda: [fx.day_lag("ddate", F.col("ddate") + 100).alias("lag_days")],
                "CAST(datediff('day', CAST(TRY_STRPTIME(CAST(ddate AS VARCHAR), '%Y%m%d') AS DATE), "
                "CAST(TRY_STRPTIME(CAST(ddate + 100 AS VARCHAR), '%Y%m%d') AS DATE)) AS INTEGER) AS lag_days"),
    "contains_flag": ("H", lambda: [fx.contains_flag("form", "N").alias("has_n")],
                      "CAST(COALESCE(contains(form, 'N'), false) AS INTEGER) AS has_n"),
    "code_prefix": ("H", lambda: [fx.code_prefix(_sic()).alias("sic_2")],
                    _prefix_sql(SIC_SQL) + " AS sic_2"),
    "range_code": ("H", lambda: [fx.range_code(fx.code_prefix(_sic()), S.SIC_DIVISIONS).alias("division")],
        _division_sql(_prefix_sql(SIC_SQL)) + " AS division"),
    "clip": ("P", lambda: [fx.clip(F.col("disc_avg") * 100, 3.0, 7.0).alias("disc_clip")],
             "ROUND(CASE WHEN disc_avg IS NULL THEN NULL ELSE GREATEST(3.0, LEAST(7.0, disc_avg * 100)) END, 6) AS disc_clip"),
    "sigmoid_score": ("P", lambda: [fx.sigmoid_score(F.col("n_orders") * 0.5, 1.23).alias("score")],
                      "ROUND(1.0 / (1.0 + EXP(n_orders * 0.5 - 1.23)), 6) AS score"),
    "bin_right_open": ("P", lambda: [fx.bin_right_open(F.col("disc_avg") * 10, [0, .2, .45, .65, .85, 1.01],
                                                       ["b0", "b1", "b2", "b3", "b4"]).alias("band")],
                       "CASE WHEN disc_avg * 10 >= 0 AND disc_avg * 10 < 0.2 THEN 'b0' "
                       "WHEN disc_avg * 10 >= 0.2 AND disc_avg * 10 < 0.45 THEN 'b1' "
                       "WHEN disc_avg * 10 >= 0.45 AND disc_avg * 10 < 0.65 THEN 'b2' "
                       "WHEN disc_avg * 10 >= 0.65 AND disc_avg * 10 < 0.85 THEN 'b3' "
                       "WHEN disc_avg * 10 >= 0.85 AND disc_avg * 10 < 1.01 THEN 'b4' END AS band"),
    "bool_flag_null": ("P", lambda: [fx.bool_flag_null(F.col("revenue") < F.col("price_sum") * 0.9,
                                                       "revenue").alias("low_rev")],
                       _flag_sql("revenue < price_sum * 0.9", "revenue") + " AS low_rev"),
    "bool_flag_zero": ("P", lambda: [fx.bool_flag_zero(F.col("revenue") < F.col("price_sum") * 0.9).alias("low_rev0")],
                       "CASE WHEN revenue < price_sum * 0.9 THEN 1 ELSE 0 END AS low_rev0"),
    "cast_byte": ("P", lambda: [fx.cast_byte(F.col("n_orders") > 1).alias("multi")],
                  "CAST(CAST(n_orders > 1 AS INTEGER) AS TINYINT) AS multi"),
    "row_sum": ("P", lambda: [fx.row_sum([F.when(F.col("revenue").isNotNull(), (F.col("revenue") < 100000).cast("int")),
                                          (F.col("n_orders") > 1).cast("int"),
                                          (F.col("disc_avg") > 0.05).cast("int")]).alias("n_alerts")],
                "COALESCE(CAST(CASE WHEN revenue IS NULL THEN NULL ELSE CAST(revenue < 100000 AS INTEGER) END AS DOUBLE), 0) "
                "+ COALESCE(CAST(CAST(n_orders > 1 AS INTEGER) AS DOUBLE), 0) "
                "+ COALESCE(CAST(CAST(disc_avg > 0.05 AS INTEGER) AS DOUBLE), 0) AS n_alerts"),
    "row_all_present": ("P", lambda: [fx.row_all_present(["revenue", "disc_avg", "price_sum"]).alias("complete")],
                        "(revenue IS NOT NULL AND disc_avg IS NOT NULL AND price_sum IS NOT NULL) AS complete"),
    "row_count_present": ("P", lambda: [fx.row_count_present(["revenue", "disc_avg", "price_sum"]).alias("n_present")],
                          "CAST(revenue IS NOT NULL AS INTEGER) + CAST(disc_avg IS NOT NULL AS INTEGER) "
                          "+ CAST(price_sum IS NOT NULL AS INTEGER) AS n_present"),
    "const_null_if": ("P", lambda: [fx.const_null_if("price_sum", F.col("n_orders") > 2).alias("price_kept")],
                      "ROUND(CASE WHEN n_orders > 2 THEN NULL ELSE price_sum END, 6) AS price_kept"),
}


def _make(view, exprs):
    build, _, keys = _VIEWS[view]

    def fn(spark, d):
        return rounded(build(spark, d).select(*keys, *exprs()))
    return fn


def _sql(view, expr):
    _, ctes, keys = _VIEWS[view]
    src = {"P": "P", "H": "H", "N": "N"}[view]
    cols = ", ".join(keys)
    return ctes + f"SELECT {cols}, * EXCLUDE ({cols}) FROM (SELECT {cols}, {expr} FROM {src})"


for _name, (_view, _exprs, _expr) in SCALARS.items():
    register(_name, _sql(_view, _expr))(_make(_view, _exprs))
