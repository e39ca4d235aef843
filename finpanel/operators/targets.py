"""Next-period targets with leakage control, and the strict modelling universe."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finpanel import schema as S
from finpanel.functions.scalar import row_all_present
from finpanel.operators.panel import dedup_latest, lead_expr


def score_class(c, cuts: Sequence[float] = S.TARGET_CLASS_CUTS):
    """0 below cuts[0], 1 below cuts[1], else 2; NULL stays NULL."""
    x = F.col(c) if isinstance(c, str) else c
    return F.when(x < cuts[0], 0).when(x < cuts[1], 1).when(x.isNotNull(), 2)


def targets(df: DataFrame, entity: str, order: Sequence, score: str,
            distress_cut: float = S.TARGET_DISTRESS_CUT,
            class_cuts: Sequence[float] = S.TARGET_CLASS_CUTS,
            prefix: str = "target_") -> DataFrame:
    """Targets from the next surviving row of the entity (NULL on its last row):
    next score, binary distress (>= cut), 3-class band, residual next - now."""
    nxt = lead_expr(entity, order, score)
    out = df.withColumn(f"{prefix}score_next", nxt)
    n = F.col(f"{prefix}score_next")
    return out.withColumns({
        f"{prefix}distress_next": F.when(n.isNotNull(), (n >= distress_cut).cast("int")),
        f"{prefix}class_next": score_class(n, class_cuts),
        f"{prefix}residual": n - F.col(score),
    })


def strict_universe(df: DataFrame, parts: Sequence[str], forms: Sequence[str] = S.FORMS,
                    form_col: str = "form", keys: Sequence[str] = ("cik", "fy", "fp"),
                    by: str = "filed", tie: Sequence[str] = ("adsh",)) -> DataFrame:
    """Valid forms, every Altman part present, then one filing per (entity, fy, fp)."""
    kept = df.where(F.col(form_col).isin(list(forms)) & row_all_present(parts))
    return dedup_latest(kept, keys, by=by, tie=tie)


def filter_has_target(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows without a next value (the entity's last surviving row)."""
    return df.dropna(subset=list(cols))
