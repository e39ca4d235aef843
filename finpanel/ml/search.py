"""Model comparison, ablation, hyper-parameter search and dataset checks.

Each fit is a Spark ML job over the full training frame; the driver only loops over
the (small) list of model specs / trials and collects one metric row per fit.
"""

from __future__ import annotations

import itertools
import json
import math
import random
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finpanel.ml.folds import fold_frames
from finpanel.ml import history as hi
from finpanel.ml.metrics import eval_binary, eval_multiclass, eval_regression, pr_auc
from finpanel.ml.models import class_scores, fit_by_name, predict, shared_bins
from finpanel.operators.prepare import accept_checks


#: What a task is ranked by, and the range its predictions are clipped to.
SCORE = {"regression": "r2", "binary": "f1", "multiclass": "f1_macro"}


def _metrics(model, df: DataFrame, y: str, task: str, clip_range: tuple[float, float] | None = None) -> dict:
    """One row of metrics; ``clip_range`` holds for regressions ((0, 1) for a score, (-1, 1) for a residual)."""
    if task == "multiclass":
        p, names = class_scores(model, df)
        return eval_multiclass(p, y, "prediction", probs=names or None).first().asDict()
    p = predict(model, df)
    if task == "regression":
        return eval_regression(p, y, "prediction", clip_range=clip_range).first().asDict()
    if "prob" not in p.columns:
        return eval_binary(p, y, "prediction", None).first().asDict()
    return eval_binary(p, y, "prediction", "prob").first().asDict() | {"average_precision": pr_auc(p, y, "prob").first()["average_precision"]}


def compare_models(train: DataFrame, valid: DataFrame, y: str, features: Sequence[str],
                   models: Mapping[str, Mapping], task: str = "regression",
                   clip_range: tuple[float, float] | None = None) -> DataFrame:
    """Fit each model spec on train, score train and validation; one row per model."""
    rows = []
    for name, spec in models.items():
        m = fit_by_name(train, y, features, spec, task)
        mv, mt = _metrics(m, valid, y, task, clip_range), _metrics(m, train, y, task, clip_range)
        key = SCORE[task]
        rows.append((name, task, mv.get("rmse"), mv.get(key), mt.get(key), mt.get(key) - mv.get(key)
                     if mt.get(key) is not None and mv.get(key) is not None else None, mv.get("roc_auc_ovr")))
    return train.sparkSession.createDataFrame(
        rows, "model string, task string, rmse double, score_valid double, score_train double, gap double, roc_auc_ovr double")


def _gap_rows(spark, t: Mapping, v: Mapping) -> DataFrame:
    rows = [(k, t[k], v.get(k), (t[k] - v[k]) if t[k] is not None and v.get(k) is not None else None)
            for k in t if isinstance(t[k], float)]
    return spark.createDataFrame(rows, "metric string, train double, valid double, gap double")


def train_val_gap(model, train: DataFrame, valid: DataFrame, y: str, task: str = "regression",
                  clip_range: tuple[float, float] | None = None) -> DataFrame:
    """Every metric on both sides and their difference (binary: F1 and average precision among them)."""
    return _gap_rows(train.sparkSession, _metrics(model, train, y, task, clip_range), _metrics(model, valid, y, task, clip_range))


def prediction_gap(train: DataFrame, valid: DataFrame, y: str, label: str, score: str) -> DataFrame:
    """The same of stored binary predictions (``label`` 0/1, ``score`` for the ranking)."""
    def of(d: DataFrame) -> dict:
        return eval_binary(d, y, label, None).first().asDict() | {"average_precision": pr_auc(d, y, score).first()["average_precision"]}
    return _gap_rows(train.sparkSession, of(train), of(valid))


def cross_validate(folded: DataFrame, y: str, features: Sequence[str], spec: Mapping, task: str = "regression", fold: str = "fold",
                   clip_range: tuple[float, float] | None = None) -> DataFrame:
    """(fold, n_train, n_test, metric columns): for every value of ``fold`` a model fitted on the
    other folds and scored on this one."""
    sizes = {r[fold]: r["n"] for r in folded.groupBy(fold).agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = []
    for k in sorted(sizes):
        m = _metrics(fit_by_name(folded.where(F.col(fold) != k), y, features, spec, task), folded.where(F.col(fold) == k), y, task, clip_range)
        m = {n: v for n, v in m.items() if v is None or isinstance(v, float)}
        rows.append({"fold": int(k), "n_train": sum(sizes.values()) - sizes[k], "n_test": sizes[k], **m})
    names = [n for n in rows[0] if n not in ("fold", "n_train", "n_test")] if rows else []
    schema = "fold int, n_train long, n_test long" + "".join(f", {n} double" for n in names)
    return folded.sparkSession.createDataFrame([tuple(r.values()) for r in rows], schema)


def ablation(train: DataFrame, valid: DataFrame, y: str, features: Sequence[str], spec: Mapping,
             groups: Mapping[str, Sequence[str]], task: str = "regression", delta: float = 0.005,
             mode: str = "keep", history: str | None = None, run: str | None = None) -> DataFrame:
    """Refit with each feature group alone (``keep``) or without it (``remove``); verdict by the
    change of the validation score. With ``history`` (a folder all executors share) the rows are
    appended there under ``run``, and those of earlier runs are read by ``history.read``."""
    base = _metrics(fit_by_name(train, y, features, spec, task), valid, y, task)
    key = SCORE[task]
    rows = [("baseline", mode, base[key], 0.0, "base")]
    for g, cols in groups.items():
        keep = [c for c in features if (c in set(cols)) == (mode == "keep")]
        s = _metrics(fit_by_name(train, y, keep, spec, task), valid, y, task)[key]
        d = s - base[key]
        verdict = ("helps" if d < -delta else "hurts" if d > delta else "neutral") if mode == "remove" else "enough" if d >= -delta else "partial"
        rows.append((g, mode, s, d, verdict))
    out = train.sparkSession.createDataFrame(rows, "feature_group string, mode string, score double, delta double, verdict string")
    if history:
        hi.append(out, history, run)
    return out


def draw_settings(space: Mapping[str, tuple], trials: int) -> list[dict]:
    """``trials`` different settings from ranges ``name -> (kind, low, high)``, kind int, float or log.

    An additive recurrence spreads them evenly: trial t takes the place frac((t + 1) a_j) in the
    j-th range, a_j being the fractional part of the square root of the j-th prime."""
    primes = [p for p in range(2, 200) if all(p % q for q in range(2, math.isqrt(p) + 1))][:len(space)]
    out = []
    t = 0
    while len(out) < trials and t < 100 * trials:
        setting = {}
        for (name, (kind, lo, hi_)), p in zip(space.items(), primes):
            u = (t + 1) * math.sqrt(p) % 1.0
            setting[name] = (lo + math.floor(u * (hi_ - lo + 1)) if kind == "int" else
                             lo * (hi_ / lo) ** u if kind == "log" else lo + (hi_ - lo) * u)
        if setting not in out:
            out.append(setting)
        t += 1
    return out


def halving_search(folded: DataFrame, y: str, features: Sequence[str], space: Mapping[str, tuple], base: Mapping, trials: int = 30,
                   n_folds: int = 3, keep: float = 1 / 3, task: str = "regression", parallel: int = 4) -> DataFrame:
    """Successive halving over temporal folds: every setting is scored on the first fold, the best
    ``keep`` share of those that are left on the next one, and so on. One row per trial: its
    setting, the folds it saw and its mean score; those that saw more folds rank first."""
    from concurrent.futures import ThreadPoolExecutor

    drawn = draw_settings(space, trials)
    key, sign = ("rmse", 1) if task == "regression" else (SCORE[task], -1)
    scores: dict[int, list[float]] = {t: [] for t in range(len(drawn))}
    left = list(scores)
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        for k in range(1, n_folds + 1):
            tr, te = fold_frames(folded, k)

            with shared_bins(tr, y, features, base, task) as shared:
                def run(t: int, tr=tr, te=te, shared=shared) -> float | None:
                    return _metrics(fit_by_name(tr, y, features, {**base, **drawn[t], **shared}, task), te, y, task)[key]
                for t, s in zip(left, pool.map(run, left)):
                    scores[t].append(math.inf * sign if s is None else s)
            left = sorted(left, key=lambda t: (sign * sum(scores[t]) / len(scores[t]), t))[:max(1, math.ceil(len(left) * keep))]
    rows = [(t, json.dumps(drawn[t]), len(s), sum(s) / len(s)) for t, s in scores.items()]
    rows.sort(key=lambda r: (-r[2], sign * r[3], r[0]))
    return folded.sparkSession.createDataFrame([(*r, n + 1) for n, r in enumerate(rows)],
                                               "trial int, params string, folds_scored int, mean_score double, rank int")


def param_search(folded: DataFrame, y: str, features: Sequence[str], space: Mapping[str, Sequence],
                 base: Mapping, trials: int = 30, n_folds: int = 3, seed: int = 42,
                 task: str = "regression", parallel: int = 4) -> DataFrame:
    """Seeded random search over ``space`` without repeats (at most all its settings); each
    trial is scored on the expanding temporal folds; trials ranked by mean score.

    All trial parameters are drawn up front (repeatable), then trials run as
    concurrent Spark jobs from a small thread pool (the scheduler interleaves them)."""
    from concurrent.futures import ThreadPoolExecutor

    every = [dict(zip(space, x)) for x in itertools.product(*space.values())]
    key = "rmse" if task == "regression" else SCORE[task]
    folds = [fold_frames(folded, k) for k in range(1, n_folds + 1)]
    drawn = random.Random(seed).sample(every, min(trials, len(every)))

    def run(t: int):
        spec = {**base, **drawn[t]}
        scores = [_metrics(fit_by_name(tr, y, features, spec, task), te, y, task)[key] for tr, te in folds]
        vals = [s for s in scores if s is not None]
        return (t, str(drawn[t]), sum(vals) / len(vals) if vals else None)

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        rows = list(pool.map(run, range(len(drawn))))
    out = folded.sparkSession.createDataFrame(rows, "trial int, params string, mean_score double")
    asc = task == "regression"
    return out.orderBy(F.col("mean_score").asc_nulls_last() if asc else F.col("mean_score").desc_nulls_last())


def dataset_checks(df: DataFrame, expected_cols: int | None = None, fy: str = "fy", entity: str = "cik",
                   fy_range: tuple[int, int] | None = None, dummies: Sequence[str] = (),
                   no_null: Sequence[str] = ()) -> DataFrame:
    """Rows, columns, years, entities, dummy rows summing to 1, NULL-free columns: one aggregate."""
    checks = {"rows": (F.count(F.lit(1)), F.col("value") > 0),
              "entities": (F.count_distinct(entity), F.col("value") > 0)}
    if expected_cols is not None:
        checks["columns"] = (F.lit(len(df.columns)), F.col("value") == expected_cols)
    if fy_range:
        checks["fy_min"] = (F.min(fy), F.col("value") >= fy_range[0])
        checks["fy_max"] = (F.max(fy), F.col("value") <= fy_range[1])
    if dummies:
        s = sum((F.coalesce(F.col(c).cast("int"), F.lit(0)) for c in dummies), F.lit(0))
        checks["dummies_sum_1"] = (F.count_if(s != 1), F.col("value") == 0)
    for c in no_null:
        checks[f"nulls_{c}"] = (F.count_if(F.col(c).isNull()), F.col("value") == 0)
    return accept_checks(df, checks)
