"""2.10 cleaning, targets, imputation, pruning and checks on the driver feature panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from finpanel import schema as S
from finpanel.operators import prepare as pr
from finpanel.operators import profile as pf
from finpanel.operators.features import FEATURE_COLS, ZPARTS, build_features, panel_order
from finpanel.operators.targets import strict_universe, targets
from finpanel.plans import sql_features as sf
from finpanel.plans.catalog_features import _features
from finpanel.plans.driver_panel import DENSE_ROLES, DENSE_SQL_CTES, DRIVER_FORMS, FIN_SQL_CTES, financial_panel
from finpanel.plans.registry import register, rounded
from finpanel.session import cut_lineage

FE_SQL = "WITH " + sf.FEATURE_SQL_CTES
TS_SQL = FE_SQL + """,
TS AS (SELECT *, LEAD(fe_zscore_risk_score) OVER (PARTITION BY cik ORDER BY fy NULLS LAST, fe_ctx_fp_orden NULLS LAST)
                 AS target_score_next FROM FE)"""
KEYS = ["adsh", "cik", "fy", "fp"]


def _features_cp(spark, d, cols):
    """``cols`` of the feature panel, stored once: multi-pass operators (percentiles,
    medians) then scan the stored table, not the lineage."""
    return cut_lineage(_features(spark, d).select(*cols), "features")


def _ts(spark, d):
    return targets(_features(spark, d), "cik", panel_order(), "fe_zscore_risk_score")


@register("clean_impossible", FE_SQL + """
SELECT adsh, CASE WHEN StockholdersEquity < 0 THEN NULL ELSE StockholdersEquity END AS StockholdersEquity,
  CASE WHEN NetIncomeLoss < 0 THEN NULL ELSE NetIncomeLoss END AS NetIncomeLoss FROM FIN""")
def q_clean_impossible(spark, d):
    p = financial_panel(spark, d)
    return pr.clean_impossible(p, ["StockholdersEquity", "NetIncomeLoss"]).select(
        "adsh", "StockholdersEquity", "NetIncomeLoss")


DUR = ["Revenues", "NetIncomeLoss", "OperatingIncomeLoss"]


@register("clean_duration", FE_SQL + "\nSELECT adsh, " + ", ".join(
    f"CASE WHEN {t}_qtrs > 4 OR {t}_qtrs = 0 THEN NULL ELSE {t} END AS {t}, "
    f"CASE WHEN {t}_qtrs > 4 OR {t}_qtrs = 0 THEN NULL ELSE {t}_qtrs END AS {t}_qtrs" for t in DUR) + " FROM FIN")
def q_clean_duration(spark, d):
    p = financial_panel(spark, d)
    return pr.clean_duration(p, DUR).select("adsh", *[x for t in DUR for x in (t, f"{t}_qtrs")])


@register("drop_durations", FE_SQL + "\nSELECT * EXCLUDE (" + ", ".join(
    c for c in sf.ROLES if c.endswith("_qtrs")) + ") FROM FIN")
def q_drop_durations(spark, d):
    return pr.drop_durations(financial_panel(spark, d))


CF_COLS = ["fe_ratio_roa", "fe_ratio_liquidez", "fe_anual_revenue", "fe_anual_net_income", "fe_delta_assets_qoq",
           "fe_ctx_revenue_consolidado", "fe_shares_dilution"]


@register("coverage_filter", FE_SQL + "\n" + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", ROUND(COUNT({c}) * 100.0 / COUNT(*), 6) AS pct_coverage,
  (COUNT({c}) * 100.0 / COUNT(*) < 60 AND '{c}' <> 'fe_ctx_revenue_consolidado') AS dropped FROM FE""" for c in CF_COLS))
def q_coverage_filter(spark, d):
    from finpanel.operators.aggregates import coverage
    f = _features_cp(spark, d, [*KEYS, *CF_COLS])
    _, dropped = pr.coverage_filter(f, 60.0, "fe_", protected=["fe_ctx_revenue_consolidado"])
    cov = coverage(f, CF_COLS).select("column", "pct_coverage")
    return rounded(cov.withColumn("dropped", F.col("column").isin(dropped) if dropped else F.lit(False)))


W_COLS = [c for c in S.WINSOR_COLS if c in FEATURE_COLS]


@register("winsorize", FE_SQL + ", B AS (SELECT " + ", ".join(
    f"QUANTILE_CONT({c}, 0.01) AS {c}_lo, QUANTILE_CONT({c}, 0.99) AS {c}_hi" for c in W_COLS) + """ FROM FE)
SELECT adsh, """ + ", ".join(f"ROUND({sf.clip(c, c + '_lo', c + '_hi')}, 6) AS {c}" for c in W_COLS) +
          " FROM FE, B")
def q_winsorize(spark, d):
    f = _features_cp(spark, d, ["adsh", *W_COLS])
    return rounded(pr.winsorize(f, W_COLS, 1.0, 99.0))


SU_PARTS = ZPARTS


#: The same features over the dense roles: rows that have all five Altman parts.
DENSE_FE_SQL = FE_SQL.replace(FIN_SQL_CTES, DENSE_SQL_CTES)


@register("strict_universe", DENSE_FE_SQL + """
SELECT adsh, cik, fy, fp FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY cik, fy, fp ORDER BY filed DESC NULLS FIRST,
  adsh DESC) AS rn FROM FE WHERE form IN (""" + ", ".join(f"'{x}'" for x in DRIVER_FORMS) + ") AND " + " AND ".join(
    f"{p} IS NOT NULL" for p in SU_PARTS) + ") WHERE rn = 1")
def q_strict_universe(spark, d):
    f = build_features(financial_panel(spark, d, DENSE_ROLES), "cik", "sic").select(*KEYS, "form", "filed", *SU_PARTS)
    return strict_universe(f, SU_PARTS, DRIVER_FORMS).select(*KEYS)


@register("targets", TS_SQL + """
SELECT adsh, ROUND(target_score_next, 6) AS target_score_next,
  CASE WHEN target_score_next IS NULL THEN NULL WHEN target_score_next >= 0.5 THEN 1 ELSE 0 END AS target_distress_next,
  CASE WHEN target_score_next < 0.35 THEN 0 WHEN target_score_next < 0.65 THEN 1
       WHEN target_score_next IS NOT NULL THEN 2 END AS target_class_next,
  ROUND(target_score_next - fe_zscore_risk_score, 6) AS target_residual FROM TS""")
def q_targets(spark, d):
    return rounded(_ts(spark, d).select("adsh", "target_score_next", "target_distress_next",
                                        "target_class_next", "target_residual"))


C_FEATS = ["fe_ratio_roa", "fe_ratio_liquidez", "fe_ratio_apalancamiento", "fe_delta_assets_qoq",
           "fe_flag_perdida_neta", "fe_anual_revenue"]
CORR_TARGET = "target_score_next"


NEARLY_FLAT = "fe_ratio_margen_bruto"


def _corr(a, b):
    """Pearson r in SQL; NULL where a column is constant, or so but for rounding, in all rows or
    in those where both are known (its variance there against the squares about its mean; in
    the driver tables only the gross margin comes near that, and the long form is slow)."""
    narrow = NEARLY_FLAT in (a, b)
    a, b = f"CAST({a} AS DOUBLE)", f"CAST({b} AS DOUBLE)"

    def varies(x, y):
        both = f"FILTER ({y} IS NOT NULL)"
        whole = f"STDDEV_POP({x}) > {pf.CONSTANT} * ABS(AVG({x}))"
        if not narrow:
            return whole
        return (f"{whole} AND VAR_POP({x}) {both} > "
                f"{pf.FLAT} * (VAR_POP({x}) {both} + (AVG({x}) {both} - AVG({x})) * (AVG({x}) {both} - AVG({x})))")
    return f"CASE WHEN {varies(a, b)} AND {varies(b, a)} THEN NULLIF(CORR({a}, {b}), CAST('NaN' AS DOUBLE)) END"


def _corr_sql(pairs, src="TS"):
    return "\nUNION ALL\n".join(
        f"SELECT '{a}' AS a, '{b}' AS b, COUNT({a} + {b}) AS n, ROUND({_corr(a, b)}, 6) AS r FROM {src}"
        for a, b in pairs)


@register("corr_with_target", TS_SQL + "\nSELECT a AS feature, b AS target, n, r, ROUND(ABS(r), 6) AS abs_r FROM (" +
          _corr_sql([(c, CORR_TARGET) for c in C_FEATS]) + ")")
def q_corr_with_target(spark, d):
    return rounded(pf.corr_with_target(_ts(spark, d), C_FEATS, [CORR_TARGET]))


#: Every free feature (neither context, forbidden nor autoregressive).
M_COLS = [c for c in FEATURE_COLS if c not in S.CONTEXT_COLS and c not in S.FEATURES_A_FORBIDDEN
          and c not in S.FEATURES_B_AUTOREGRESSIVE]
M_PAIRS = [(M_COLS[i], M_COLS[j]) for j in range(len(M_COLS)) for i in range(j)]


@register("corr_matrix", TS_SQL + """
SELECT a, b, n, ROUND(r, 6) AS r, ROUND(ABS(r), 6) AS abs_r, ia, ib FROM (SELECT UNNEST([""" + ",\n".join(
    f"{{a: '{a}', b: '{b}', n: COUNT({a} + {b}), r: {_corr(a, b)}, "
    f"ia: {M_COLS.index(a)}, ib: {M_COLS.index(b)}}}" for a, b in M_PAIRS) + "], recursive := true) FROM TS)")
def q_corr_matrix(spark, d):
    return rounded(pf.corr_matrix(_ts(spark, d), M_COLS))


@register("persistence_corr", TS_SQL + """
SELECT COUNT(fe_zscore_risk_score + target_score_next) AS n, ROUND(NULLIF(CORR(fe_zscore_risk_score, target_score_next), CAST('NaN' AS DOUBLE)), 6) AS r FROM TS""")
def q_persistence_corr(spark, d):
    return rounded(pf.persistence_corr(_ts(spark, d), "fe_zscore_risk_score", "target_score_next"))


@register("topk_corr", TS_SQL + "\nSELECT feature, target, r, rank FROM (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY target "
          "ORDER BY ABS(r) DESC, feature) AS INTEGER) AS rank FROM (SELECT a AS feature, b AS target, ROUND(r, 6) AS r FROM (" +
          _corr_sql([(c, CORR_TARGET) for c in C_FEATS]) + ") WHERE r IS NOT NULL)) WHERE rank <= 3")
def q_topk_corr(spark, d):
    from finpanel.operators.topk import topk_corr
    c = rounded(pf.corr_with_target(_ts(spark, d), C_FEATS, [CORR_TARGET]))
    return topk_corr(c, 3).select("feature", "target", "r", "rank")


@register("topk_signed", TS_SQL + ", C AS (SELECT a AS feature, b AS target, ROUND(r, 6) AS r FROM (" +
          _corr_sql([(c, CORR_TARGET) for c in C_FEATS]) + """))
SELECT feature, target, r, rank, side FROM (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY target ORDER BY r, feature) AS INTEGER) AS rank,
  'neg' AS side FROM C WHERE r < 0) WHERE rank <= 2
UNION ALL SELECT feature, target, r, rank, side FROM (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY target ORDER BY r DESC, feature) AS INTEGER) AS rank,
  'pos' AS side FROM C WHERE r > 0) WHERE rank <= 2""")
def q_topk_signed(spark, d):
    from finpanel.operators.topk import topk_signed
    c = rounded(pf.corr_with_target(_ts(spark, d), C_FEATS, [CORR_TARGET]))
    return topk_signed(c, 2).select("feature", "target", "r", "rank", "side")


@register("leakage_check", TS_SQL + """
SELECT 'forbidden_name' AS "check", 'fe_zscore_altman' AS feature, CAST(NULL AS DOUBLE) AS value, false AS ok
UNION ALL
SELECT 'class_c_corr', a, ROUND(ABS(r), 6), COALESCE(ABS(r) <= 0.85, true) FROM (""" +
          _corr_sql([(c, CORR_TARGET) for c in C_FEATS]) + ")")
def q_leakage_check(spark, d):
    out = pf.leakage_check(_ts(spark, d), C_FEATS + ["fe_zscore_altman"], CORR_TARGET, class_c=C_FEATS)
    return rounded(out)


@register("family_summary", TS_SQL + ", C AS (SELECT a AS col, ABS(r) AS ar FROM (" +
          _corr_sql([(c, CORR_TARGET) for c in C_FEATS]) + ")), V AS (" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS col, '{S.family_of(c)}' AS family, COUNT({c}) * 100.0 / COUNT(*) AS cov FROM TS" for c in C_FEATS) +
          """)
SELECT family, COUNT(*) AS n_cols, ROUND(AVG(cov), 6) AS coverage_avg, ROUND(AVG(ar), 6) AS abs_r_avg,
  ROUND(MAX(ar), 6) AS abs_r_max FROM V LEFT JOIN C USING (col) GROUP BY family""")
def q_family_summary(spark, d):
    return rounded(pf.family_summary(_ts(spark, d), C_FEATS, CORR_TARGET))


def _with_present(classify, f):
    """A classification by name, beside how many rows hold a value (one pass for all columns)."""
    from finpanel.operators.aggregates import coverage
    counts = coverage(f, f.columns).select("column", F.col("n_non_null").alias("n_present"))
    return classify(f).join(counts, "column")


_COLS_SQL = "(UNPIVOT (SELECT COUNT(COLUMNS(*)) FROM FE) ON COLUMNS(*) INTO NAME column_name VALUE n_present)"
_FAMILY_SQL = ("CASE " + " ".join(f"WHEN starts_with(column_name, '{p}') THEN '{p[:-1]}'" for p in S.FAMILY_PREFIXES)
               + " WHEN column_name IN (" + ", ".join(f"'{m}'" for m in S.META_COLS) + ") THEN 'meta'"
               + " ELSE 'xbrl_raw' END")


def _in(cols):
    return "(" + ", ".join(f"'{c}'" for c in cols) + ")"


@register("family_class", FE_SQL + f' SELECT column_name AS "column", {_FAMILY_SQL} AS family, n_present FROM {_COLS_SQL}')
def q_family_class(spark, d):
    return _with_present(pf.family_class, _features(spark, d))


@register("keep_drop", FE_SQL + f""", C AS (SELECT column_name AS "column", {_FAMILY_SQL} AS family, n_present FROM {_COLS_SQL}),
K AS (SELECT *, CASE WHEN family = 'xbrl_raw' THEN 'DROP_XBRL_RAW'
                     WHEN "column" IN {_in(S.DROP_REDUNDANT)} THEN 'DROP_REDUNDANTE' ELSE 'KEEP' END AS decision FROM C)
SELECT *, CASE WHEN decision <> 'KEEP' THEN '-' WHEN family = 'meta' THEN 'META'
               WHEN "column" IN {_in(S.FEATURES_A_FORBIDDEN)} THEN 'A_PROHIBIDA'
               WHEN "column" IN {_in(S.FEATURES_B_AUTOREGRESSIVE)} THEN 'B_AUTOREGRESIVA' ELSE 'C_LIBRE' END AS category
FROM K""")
def q_keep_drop(spark, d):
    return _with_present(pf.keep_drop, _features(spark, d))


P_COLS = M_COLS


def _prune_sql():
    cols = P_COLS
    def corr(a, b):
        return f"ABS({_corr(a, b)})"

    pairs = "SELECT p.*, x.cov AS cov_a, x.t AS ta, y.cov AS cov_b, y.t AS tb FROM (SELECT UNNEST([" + ", ".join(
        f"{{a: '{cols[i]}', b: '{cols[j]}', ia: {i}, ib: {j}, r: {corr(cols[i], cols[j])}}}" for j in range(len(cols)) for i in range(j)
    ) + "], recursive := true) FROM TS) p JOIN ST x ON x.c = p.a JOIN ST y ON y.c = p.b"
    single = "SELECT UNNEST([" + ", ".join(
        f"{{c: '{c}', cov: COUNT({c}) * 1.0 / COUNT(*), t: {corr(c, CORR_TARGET)}}}" for c in cols) + "], recursive := true) FROM TS"
    names = " UNION ALL ".join(f"SELECT '{c}' AS col" for c in cols)
    return TS_SQL + f""",
ST AS ({single}),
PA AS (SELECT * FROM ({pairs}) WHERE r > 0.95),
PO AS (SELECT *, ROW_NUMBER() OVER (ORDER BY ib, ia) AS i FROM PA),
W AS (SELECT 0 AS i, CAST([] AS VARCHAR[]) AS dropped
      UNION ALL
      SELECT W.i + 1, CASE WHEN list_contains(W.dropped, PO.a) OR list_contains(W.dropped, PO.b) THEN W.dropped
                           ELSE list_append(W.dropped, CASE WHEN PO.cov_a < PO.cov_b THEN PO.a
                                                            WHEN PO.cov_b < PO.cov_a THEN PO.b
                                                            WHEN PO.ta < PO.tb THEN PO.a ELSE PO.b END) END
      FROM W JOIN PO ON PO.i = W.i + 1),
FINAL AS (SELECT dropped FROM W ORDER BY i DESC LIMIT 1)
SELECT col AS "column", list_contains((SELECT dropped FROM FINAL), col) AS pruned FROM ({names})"""


@register("prune_corr", _prune_sql().replace("WITH ", "WITH RECURSIVE ", 1))
def q_prune_corr(spark, d):
    ts = _ts(spark, d)
    _, dropped = pf.prune_corr(ts, P_COLS, CORR_TARGET, 0.95)
    return spark.createDataFrame([(c, c in dropped) for c in P_COLS], "column string, pruned boolean")


PC_COLS = ["fe_ratio_roa", "fe_ratio_liquidez", "fe_anual_revenue", "fe_delta_assets_qoq", "fe_shares_dilution"]


@register("prune_coverage", FE_SQL + "\n" + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", ROUND(COUNT({c}) * 100.0 / COUNT(*), 6) AS pct_coverage,
  CASE WHEN COUNT({c}) * 100.0 / COUNT(*) < 80 THEN '_PODADA_{c}' ELSE '{c}' END AS new_name FROM FE""" for c in PC_COLS))
def q_prune_coverage(spark, d):
    from finpanel.operators.aggregates import coverage
    f = _features_cp(spark, d, [*KEYS, *PC_COLS])
    pruned_df, low = pr.prune_coverage(f, PC_COLS, 80.0)
    cov = coverage(f, PC_COLS).select("column", "pct_coverage")
    names = [c for c in pruned_df.columns if c not in KEYS]
    m = spark.createDataFrame([(c, n) for c, n in zip(PC_COLS, names)], "column string, new_name string")
    return rounded(cov.join(m, "column"))


RC_COLS = ["fe_ratio_roa", "fe_ratio_liquidez", "fe_ratio_deuda_equity", "fe_anual_revenue"]


@register("range_check", FE_SQL + "\nSELECT *, COALESCE(ABS(\"max\") > 5 * ABS(p99) AND ABS(p99) > 0.001, false) AS alarm FROM (" +
          "\nUNION ALL\n".join(
              f"""SELECT '{c}' AS "column", ROUND(MIN({c}), 6) AS "min", ROUND(MAX({c}), 6) AS "max",
  ROUND(QUANTILE_CONT({c}, 0.01), 6) AS p1, ROUND(QUANTILE_CONT({c}, 0.99), 6) AS p99 FROM FE""" for c in RC_COLS) + ")")
def q_range_check(spark, d):
    f = _features_cp(spark, d, RC_COLS)
    out = rounded(pr.range_check(f, RC_COLS))
    return out.withColumn("alarm", F.coalesce((F.abs("max") > 5 * F.abs("p99")) & (F.abs("p99") > 0.001),
                                              F.lit(False)))


@register("clip_flag", FE_SQL + "\nSELECT adsh, " + ", ".join(
    f"CAST(CAST(COALESCE({c} < {lo} OR {c} > {hi}, false) AS INTEGER) AS TINYINT) AS fe_clipped_{c}, "
    f"ROUND({sf.clip(c, lo, hi)}, 6) AS {c}" for c, (lo, hi) in S.CLIP_BOUNDS.items()) + " FROM FE")
def q_clip_flag(spark, d):
    f = _features(spark, d).select("adsh", *S.CLIP_BOUNDS)
    return rounded(pr.clip_flag(f))


# -- imputation ---------------------------------------------------------------------------

SECTOR_SQL = "CASE WHEN fe_ctx_sic_sector >= 5 THEN fe_ctx_sic_sector % 10 END"


def _with_sector(spark, d, cols):
    f = _features_cp(spark, d, ["adsh", "fe_ctx_sic_sector", *cols])
    return f.withColumn("sector", F.when(F.col("fe_ctx_sic_sector") >= 5, F.col("fe_ctx_sic_sector") % 10))


IMP_FEATS = ["fe_ratio_roa", "fe_ratio_liquidez", "fe_delta_assets_qoq", "fe_anual_revenue", "fe_anual_net_income",
             "fe_delta_zscore_qoq", "fe_shares_dilution"]


@register("impute_plan", FE_SQL + f", X AS (SELECT *, {SECTOR_SQL} AS sector FROM FE), G AS (SELECT sector, " + ", ".join(
    f"AVG(CAST({c} IS NULL AS DOUBLE)) * 100 AS m_{c}" for c in IMP_FEATS) +
          " FROM X WHERE sector IS NOT NULL GROUP BY sector), M AS (" + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", (SELECT COUNT({c}) * 100.0 / COUNT(*) FROM X) AS pct_coverage,
  STDDEV_SAMP(m_{c}) AS std_missing FROM G""" for c in IMP_FEATS) + """),
S AS (SELECT *, COALESCE(std_missing > 15, false) AS structural FROM M)
SELECT "column", ROUND(pct_coverage, 6) AS pct_coverage, ROUND(std_missing, 6) AS std_missing, structural,
  CASE WHEN "column" IN ('fe_delta_zscore_qoq') THEN 'IMP_CERO_INICIAL'
       WHEN "column" IN ('fe_anual_net_income', 'fe_anual_cash_investing', 'fe_anual_cash_financing', 'fe_anual_cash_operating')
            THEN 'IMP_MEDIANA_SECTOR_FLAG'
       WHEN pct_coverage >= 90 AND NOT structural THEN 'IMP_MEDIANA_GLOBAL'
       WHEN pct_coverage >= 90 AND structural THEN 'IMP_MEDIANA_SECTOR'
       WHEN pct_coverage >= 60 AND NOT structural THEN 'IMP_MEDIANA_FLAG'
       WHEN pct_coverage >= 60 AND structural THEN 'IMP_CERO_FLAG'
       WHEN pct_coverage >= 30 THEN 'CONSERVAR_FLAG' ELSE 'PODA_PRELIMINAR' END AS strategy FROM S""")
def q_impute_plan(spark, d):
    plan = pr.impute_plan(_with_sector(spark, d, IMP_FEATS), IMP_FEATS, "sector", class_b=["fe_delta_zscore_qoq"])
    return rounded(plan)


@register("impute_audit_rule", FE_SQL + "\nSELECT \"column\", ROUND(pct_null, 6) AS pct_null, CASE WHEN pct_null < 5 THEN "
          "'NO_IMPUTAR' WHEN pct_null < 30 THEN 'IMP_SIMPLE' WHEN pct_null < 70 THEN 'IMP_CON_FLAG' ELSE "
          "'IMP_ESTRUCTURAL' END AS strategy FROM (" + "\nUNION ALL\n".join(
              f"SELECT '{c}' AS \"column\", 100.0 - COUNT({c}) * 100.0 / COUNT(*) AS pct_null FROM FE" for c in IMP_FEATS) + ")")
def q_impute_audit_rule(spark, d):
    from finpanel.operators.aggregates import coverage
    cov = coverage(_features(spark, d), IMP_FEATS)
    out = cov.select("column", (F.lit(100.0) - F.col("pct_coverage")).alias("pct_null"))
    return rounded(out.withColumn("strategy", pr.impute_audit_rule(F.col("pct_null"))))


@register("impute_zero", FE_SQL + "\nSELECT adsh, " + ", ".join(
    f"ROUND(COALESCE({c}, 0), 6) AS {c}" for c in S.FEATURES_B_AUTOREGRESSIVE if c != "fe_delta_risk_deterioro") +
          ", COALESCE(fe_delta_risk_deterioro, 0) AS fe_delta_risk_deterioro FROM FE")
def q_impute_zero(spark, d):
    f = _features(spark, d).select("adsh", *S.FEATURES_B_AUTOREGRESSIVE)
    return rounded(pr.impute_zero(f, S.FEATURES_B_AUTOREGRESSIVE))


@register("impute_median", FE_SQL + """
SELECT adsh, CAST(fe_ratio_liquidez IS NULL AS TINYINT) AS fe_imputed_fe_ratio_liquidez,
  ROUND(COALESCE(fe_ratio_liquidez, (SELECT MEDIAN(fe_ratio_liquidez) FROM FE)), 6) AS fe_ratio_liquidez,
  ROUND(COALESCE(fe_delta_assets_qoq, (SELECT MEDIAN(fe_delta_assets_qoq) FROM FE)), 6) AS fe_delta_assets_qoq FROM FE""")
def q_impute_median(spark, d):
    f = _features_cp(spark, d, ["adsh", "fe_ratio_liquidez", "fe_delta_assets_qoq"])
    a = pr.impute_median(f, ["fe_ratio_liquidez"], flag=True)
    return rounded(pr.impute_median(a, ["fe_delta_assets_qoq"], flag=False))


@register("impute_group_median", FE_SQL + f""", X AS (SELECT adsh, {SECTOR_SQL} AS sector, fe_ratio_roa AS x FROM FE),
G AS (SELECT sector, MEDIAN(x) AS gm FROM X WHERE sector IS NOT NULL GROUP BY sector),
F1 AS (SELECT X.adsh, X.sector, CASE WHEN X.sector IS NULL THEN NULL ELSE COALESCE(x, gm) END AS x1
       FROM X LEFT JOIN G ON X.sector = G.sector)
SELECT adsh, sector, ROUND(COALESCE(x1, (SELECT MEDIAN(x1) FROM F1)), 6) AS fe_ratio_roa FROM F1""")
def q_impute_group_median(spark, d):
    f = _with_sector(spark, d, ["fe_ratio_roa"]).select("adsh", "sector", "fe_ratio_roa")
    return rounded(pr.impute_group_median(f, ["fe_ratio_roa"], "sector", flag=False, global_after=True))


@register("impute_group_median_flag", FE_SQL + f""", X AS (SELECT adsh, {SECTOR_SQL} AS sector, fe_anual_net_income AS x FROM FE),
G AS (SELECT sector, MEDIAN(x) AS gm FROM X WHERE sector IS NOT NULL GROUP BY sector),
F1 AS (SELECT X.adsh, X.sector, X.x, CASE WHEN X.sector IS NULL THEN NULL ELSE COALESCE(x, gm) END AS x1
       FROM X LEFT JOIN G ON X.sector = G.sector)
SELECT adsh, sector, CAST(x IS NULL AS TINYINT) AS fe_imputed_fe_anual_net_income,
  ROUND(COALESCE(x1, (SELECT MEDIAN(x) FROM X)), 6) AS fe_anual_net_income FROM F1""")
def q_impute_group_median_flag(spark, d):
    f = _with_sector(spark, d, ["fe_anual_net_income"]).select("adsh", "sector", "fe_anual_net_income")
    return rounded(pr.impute_group_median(f, ["fe_anual_net_income"], "sector", flag=True, global_after=False))


@register("impute_zero_flag", FE_SQL + """
SELECT adsh, CAST(fe_ratio_cobertura_intereses IS NULL AS TINYINT) AS fe_isnull_fe_ratio_cobertura_intereses,
  ROUND(COALESCE(fe_ratio_cobertura_intereses, 0), 6) AS fe_ratio_cobertura_intereses FROM FE""")
def q_impute_zero_flag(spark, d):
    f = _features(spark, d).select("adsh", "fe_ratio_cobertura_intereses")
    return rounded(pr.impute_zero_flag(f, ["fe_ratio_cobertura_intereses"]))


@register("impute_backstop", FE_SQL + """
SELECT adsh, ROUND(COALESCE(fe_shares_dilution, (SELECT MEDIAN(fe_shares_dilution) FROM FE), 0), 6) AS fe_shares_dilution,
  ROUND(COALESCE(fe_ratio_rnd_revenue, (SELECT MEDIAN(fe_ratio_rnd_revenue) FROM FE), 0), 6) AS fe_ratio_rnd_revenue FROM FE""")
def q_impute_backstop(spark, d):
    f = _features_cp(spark, d, ["adsh", "fe_shares_dilution", "fe_ratio_rnd_revenue"])
    return rounded(pr.impute_backstop(f, ["fe_shares_dilution", "fe_ratio_rnd_revenue"]))


# -- checks -------------------------------------------------------------------------------

@register("accept_checks", TS_SQL + """, A AS (SELECT COUNT(*) AS n_rows, AVG(target_score_next - fe_zscore_risk_score) AS res_mean,
  STDDEV_SAMP(target_score_next - fe_zscore_risk_score) AS res_std,
  COUNT(*) - COUNT(target_score_next) AS n_no_target FROM TS)
SELECT 'rows' AS "check", CAST(n_rows AS DOUBLE) AS value, COALESCE(n_rows > 0, false) AS ok FROM A UNION ALL
SELECT 'residual_mean', ROUND(res_mean, 6), COALESCE(ABS(res_mean) < 0.05, false) FROM A UNION ALL
SELECT 'residual_std', ROUND(res_std, 6), COALESCE(res_std BETWEEN 0.05 AND 0.20, false) FROM A UNION ALL
SELECT 'rows_without_target', CAST(n_no_target AS DOUBLE), COALESCE(n_no_target >= 0, false) FROM A""")
def q_accept_checks(spark, d):
    ts = _ts(spark, d)
    res = F.col("target_score_next") - F.col("fe_zscore_risk_score")
    checks = {
        "rows": (F.count(F.lit(1)), F.col("value") > 0),
        "residual_mean": (F.avg(res), F.abs(F.col("value")) < 0.05),
        "residual_std": (F.stddev_samp(res), F.col("value").between(0.05, 0.20)),
        "rows_without_target": (F.count(F.lit(1)) - F.count("target_score_next"), F.col("value") >= 0),
    }
    return rounded(pr.accept_checks(ts, checks))


NEEDS = {"liquidez": ["fe_ratio_liquidez", "fe_ratio_quick", "fe_ratio_cash"],
         "rentabilidad": ["fe_ratio_roa", "fe_ratio_roe"],
         "tamano": ["Assets", "fe_missing_col"]}


@register("needs_coverage", FE_SQL + "\n" + "\nUNION ALL\n".join(
    (f"SELECT '{n}' AS need, '{c}' AS \"column\", true AS present, ROUND(100.0 - COUNT({c}) * 100.0 / COUNT(*), 6) AS pct_null, "
     f"(100.0 - COUNT({c}) * 100.0 / COUNT(*)) <= 80 AS usable FROM FE") if c != "fe_missing_col" else
    (f"SELECT '{n}', '{c}', false, CAST(NULL AS DOUBLE), false")
    for n, cs in NEEDS.items() for c in cs))
def q_needs_coverage(spark, d):
    return rounded(pr.needs_coverage(_features(spark, d), NEEDS, 80.0))
