"""Aggregations and profiles.

Rules kept throughout:
* many columns -> ONE ``agg`` pass (never one scan per column);
* global totals attach through a one-row aggregate (exactly one row: a proven bound);
* exact quantiles never funnel a whole group into one task: ``quantiles`` brackets each
  rank by a sketch, then counts only the values inside the bracket — the same linear
  interpolation as pandas / DuckDB ``quantile_cont``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finpanel import schema as S
from finpanel.session import cut_lineage


def attach_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the values of a one-row aggregate to every row as literals.

    Only the single aggregate row reaches the driver."""
    row = one_row.first()
    return df.withColumns({k: F.lit(v) for k, v in row.asDict().items()})


# -- pivot / counts -------------------------------------------------------------

#: Pivoted columns up to which a table of ids, with two fields a column, is smaller than Spark's two of (id, tag).
NARROW_PIVOT = 32


def pivot_wide(df: DataFrame, id_col: str | Sequence[str], tag: str, tags: Sequence[str],
               value: str = "value", dur: str | None = "qtrs", dur_suffix: str = "_qtrs") -> DataFrame:
    """Long -> wide: one column per tag (first non-null value) and ``<tag>_qtrs``.

    The tag list is fixed, so no extra job computes distinct tags, and every listed
    column exists even when a tag never occurs. Spark's ``pivot`` groups by id and tag first,
    so a task holds two tables of these beside the one of ids; few columns are grouped by id alone."""
    ids = [id_col] if isinstance(id_col, str) else list(id_col)
    if len(tags) * (2 if dur else 1) <= NARROW_PIVOT:
        firsts = [F.first(F.when(F.col(tag) == t, F.col(c)), ignorenulls=True).alias(f"{t}{suffix}")
                  for c, suffix in ((value, ""), (dur, dur_suffix)) if c for t in tags]
        return df.groupBy(*ids).agg(*firsts)
    aggs = [F.first(F.col(value), ignorenulls=True).alias("v")]
    if dur:
        aggs.append(F.first(F.col(dur), ignorenulls=True).alias("d"))
    w = df.groupBy(*ids).pivot(tag, list(tags)).agg(*aggs)
    if not dur:
        return w.select(*ids, *[F.col(f"`{t}_v`").alias(t) if f"{t}_v" in w.columns else F.col(f"`{t}`")
                                for t in tags])
    return w.select(*ids, *[F.col(f"`{t}_v`").alias(t) for t in tags],
                    *[F.col(f"`{t}_d`").alias(f"{t}{dur_suffix}") for t in tags])


def value_counts(df: DataFrame, c: str, name: str = "n", share: str = "share") -> DataFrame:
    """Frequency and share (0..1) of each value, NULL included as its own value."""
    counts = df.groupBy(c).agg(F.count(F.lit(1)).alias(name)).persist()
    try:  # the total is the sum of the counts: the input is read once
        total = counts.agg(F.sum(name)).first()[0]
        kept = cut_lineage(counts, "counts")
    finally:
        counts.unpersist()
    return kept.withColumn(share, F.col(name) / F.lit(total))


def dominant_share(df: DataFrame, cols: Sequence[str], max_levels: int | None = None) -> DataFrame:
    """Per column: share of its most frequent value among non-null rows, number of levels.

    Long form (column, value) -> counts -> max/sum, one shuffle for all columns."""
    long = (df.select(*[F.col(c).cast("string").alias(c) for c in cols])
              .unpivot([], list(cols), "column", "value").where(F.col("value").isNotNull()))
    cnt = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    out = cnt.groupBy("column").agg(
        (F.max("n") / F.sum("n")).alias("top_share"),
        F.count(F.lit(1)).alias("n_levels"))
    if max_levels is not None:
        out = out.where(F.col("n_levels") <= max_levels)
    return out


def count_distinct(df: DataFrame, cols: Sequence[str], approx: bool = False, rsd: float = 0.01) -> DataFrame:
    f = (lambda c: F.approx_count_distinct(c, rsd)) if approx else (lambda c: F.count_distinct(c))
    return df.agg(*[f(c).alias(f"n_distinct_{c}") for c in cols])


def min_max(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    return df.agg(*aggs)


def coverage(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """% non-null per column from ONE aggregate row, unpivoted to (column, n, pct)."""
    one = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count(F.col(c)).alias(c) for c in cols])
    long = one.unpivot(["_rows"], list(cols), "column", "n_non_null")
    return long.select(
        "column", "n_non_null",
        (F.try_divide(F.col("n_non_null") * 100.0, F.col("_rows"))).alias("pct_coverage"),
        (F.col("_rows") - F.col("n_non_null")).alias("n_null"))


def column_inventory(df: DataFrame, cols: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """Per column: Spark type, family, % null, distinct count.

    Exact distinct counts go through the long form (column, value) so k columns need
    one shuffle rather than k distinct aggregates; ``exact=False`` uses HLL sketches."""
    cols = list(cols or df.columns)
    spark = df.sparkSession
    meta = spark.createDataFrame(
        [(c, t, S.family_of(c)) for c, t in df.select(*cols).dtypes], "column string, dtype string, family string")
    cov = coverage(df, cols)
    if exact:
        long = (df.select(*[F.col(c).cast("string").alias(c) for c in cols])
                  .unpivot([], cols, "column", "value").where(F.col("value").isNotNull()))
        nd = long.distinct().groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"))
    else:
        one = df.agg(*[F.approx_count_distinct(c).alias(c) for c in cols])
        nd = one.unpivot([], cols, "column", "n_distinct")
    out = (meta.join(cov, "column", "left").join(nd, "column", "left")
               .withColumn("n_distinct", F.coalesce(F.col("n_distinct"), F.lit(0)).cast("bigint")))
    return out.select("column", "dtype", "family",
                      (F.lit(100.0) - F.col("pct_coverage")).alias("pct_null"), "n_distinct")


def null_by_block(df: DataFrame, blocks: Mapping[str, Sequence[str]],
                  cuts: Sequence[float] = (20.0, 50.0)) -> DataFrame:
    """Per semantic block: columns, mean % null, and columns by level
    (% null < cuts[0]; cuts[0] <= % < cuts[1]; >= cuts[1])."""
    all_cols = [c for cs in blocks.values() for c in cs if c in df.columns]
    cov = coverage(df, list(dict.fromkeys(all_cols)))
    bmap = df.sparkSession.createDataFrame(
        [(b, c) for b, cs in blocks.items() for c in cs if c in df.columns], "block string, column string")
    j = bmap.join(cov, "column").withColumn("pct_null", F.lit(100.0) - F.col("pct_coverage"))
    return j.groupBy("block").agg(
        F.count(F.lit(1)).alias("n_cols"),
        F.avg("pct_null").alias("pct_null_avg"),
        F.count_if(F.col("pct_null") < cuts[0]).alias("n_low"),
        F.count_if((F.col("pct_null") >= cuts[0]) & (F.col("pct_null") < cuts[1])).alias("n_mid"),
        F.count_if(F.col("pct_null") >= cuts[1]).alias("n_high"))


# -- exact quantiles at scale ---------------------------------------------------------

#: Rank error of the sketch that brackets a quantile: 1 / ACCURACY of a group's rows.
ACCURACY = 10_000
#: Rows a bracket may hold when its values are counted one by one (what one task sorts).
BRACKET_ROWS = 100_000
#: Steps of the grid that narrows a bracket.
GRID = 1_000


def _sketched(long: DataFrame, G: list[str], probs: Sequence[float]) -> DataFrame:
    """A first bracket per (group, column, p): two sketch errors to either side of the rank."""
    ends = [min(1.0, max(0.0, p + d)) for p in probs for d in (-2.0 / ACCURACY, 2.0 / ACCURACY)]
    sketch = long.groupBy(*G).agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("least"), F.max("x").alias("most"),
                                  F.percentile_approx("x", ends, ACCURACY).alias("q"))
    each = [F.struct(F.lit(p).alias("p"),
                     F.when(F.lit(ends[2 * i] <= 0), F.col("least")).otherwise(F.get("q", F.lit(2 * i))).alias("lo"),
                     F.when(F.lit(ends[2 * i + 1] >= 1), F.col("most")).otherwise(F.get("q", F.lit(2 * i + 1))).alias("hi"))
            for i, p in enumerate(probs)]
    return sketch.select(*G, "n", "least", "most", F.explode(F.array(*each)).alias("b")).select(
        *G, "n", "least", "most", "b.*", F.lit(False).alias("strict"), F.ceil(F.col("n") * (4.0 / ACCURACY)).alias("held"))


def _placed(long: DataFrame, brackets: DataFrame, G: list[str]) -> DataFrame:
    """Every row with each bracket of its group, and on which side of it the row lies (-1, 0, 1)."""
    cond = F.lit(True)
    for g in G:
        cond = cond & F.col(g).eqNullSafe(F.col(f"_on_{g}"))
    on = brackets.groupBy(*G).agg(F.collect_list(F.struct("n", "least", "most", "p", "lo", "hi", "strict")).alias("b"))
    rows = long.join(on.withColumnsRenamed({g: f"_on_{g}" for g in G}), cond).select(*G, "x", F.explode("b").alias("b")).select(*G, "x", "b.*")
    return rows.withColumn("side", F.when((F.col("x") < F.col("lo")) | (F.col("strict") & (F.col("x") == F.col("lo"))), -1)
                           .when((F.col("x") > F.col("hi")) | (F.col("strict") & (F.col("x") == F.col("hi"))), 1).otherwise(0))


def _narrowed(placed: DataFrame, G: list[str]) -> DataFrame:
    """Brackets cut down to some steps of a grid around the rank; one that misses the rank is
    turned to the side where it lies. A bracket that its heavy ends keep from shrinking loses them."""
    own = F.when(F.col("side") == 0, F.col("x"))
    t = placed.groupBy(*G, "n", "least", "most", "p", "lo", "hi", "strict").agg(
        F.count_if(F.col("side") < 0).alias("below"), F.count(own).alias("inside"), F.percentile_approx(own, [k / GRID for k in range(GRID + 1)], ACCURACY).alias("grid"),
        F.max(F.when(F.col("side") < 0, F.col("x"))).alias("before"), F.min(F.when(F.col("side") > 0, F.col("x"))).alias("behind"))
    rank = F.floor((F.col("n") - 1) * F.col("p"))
    at = (rank - F.col("below")) / F.col("inside") * GRID
    lo, hi = (F.get("grid", F.least(F.greatest(x.cast("int"), F.lit(0)), F.lit(GRID))) for x in (F.floor(at) - 2, F.ceil(at) + 2))
    under, over = rank < F.col("below"), rank >= F.col("below") + F.col("inside")
    t = t.withColumns({"new_lo": F.when(under, F.col("least")).when(over, F.col("behind")).otherwise(lo),
                       "new_hi": F.when(under, F.col("before")).when(over, F.col("most")).otherwise(hi),
                       "missed": under | over})
    same = ~F.col("missed") & (F.col("new_lo") <= F.col("lo")) & (F.col("new_hi") >= F.col("hi"))
    held = F.when(F.col("missed"), F.col("n")).when(F.col("new_lo") == F.col("new_hi"), 0).when(same & F.col("strict"), 0).when(
        same, F.greatest(F.col("inside"), F.lit(BRACKET_ROWS + 1))).otherwise(F.ceil(F.col("inside") * (6.0 / GRID)))
    return t.select(*G, "n", "least", "most", "p", F.when(same, F.col("lo")).otherwise(F.col("new_lo")).alias("lo"),
                    F.when(same, F.col("hi")).otherwise(F.col("new_hi")).alias("hi"), (same & (F.col("lo") < F.col("hi"))).alias("strict"), held.cast("long").alias("held"))


def _selected(placed: DataFrame, G: list[str]) -> DataFrame:
    """(G, bracket, value, hit): running counts over the values inside a bracket, with the nearest
    ones outside it, select the ranks. ``hit`` tells whether both ranks lie among these."""
    B = ["n", "least", "most", "p", "lo", "hi", "strict"]
    cnt = (placed.withColumn("own", F.when(F.col("side") == 0, F.col("x"))).groupBy(*G, *B, "side", "own")
                 .agg(F.count(F.lit(1)).alias("c"), F.max("x").alias("last"), F.min("x").alias("first"))
                 .withColumn("x", F.when(F.col("side") < 0, F.col("last")).otherwise(F.col("first"))))
    w = Window.partitionBy(*G, "p").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    h = (F.col("n") - 1) * F.col("p")
    upto = cnt.withColumn("upto", F.sum("c").over(w))
    low, high = F.floor(h), F.ceil(h)

    def known(k: Column) -> Column:
        """Of the rows below only the last is known, of those above only the first."""
        since = F.col("upto") - F.col("c")
        return (F.col("upto") > k) & (since <= k) & F.when(F.col("side") < 0, k == F.col("upto") - 1).when(F.col("side") > 0, k == since).otherwise(True)
    out = upto.groupBy(*G, *B).agg(F.min(F.when(known(low), F.col("x"))).alias("a"), F.min(F.when(known(high), F.col("x"))).alias("z"),
                                   F.sum(F.when(F.col("side") == 0, 1)).alias("inside"))
    frac = h - low
    return out.select(*G, *B, (F.col("a") + (F.col("z") - F.col("a")) * frac).alias("value"), (F.col("a").isNotNull() & F.col("z").isNotNull()).alias("hit"))


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
              by: Sequence[str] = ()) -> DataFrame:
    """Exact linear-interpolated quantiles of each column (optionally per group).

    Returns (by..., column, p, value); NULL groups are groups. One way at every size:
    1. the columns are landed once; a sketch (``approx_percentile``, merged across tasks,
       bounded) gives each (group, column, p) a bracket about the two ranks wanted;
    2. a bracket that holds more than BRACKET_ROWS is narrowed, as often as it takes: one pass
       counts the rows below it and lays a grid over those inside, and the bracket shrinks to
       some steps around the rank, or turns to the side where the rank lies if it missed it;
    3. one pass counts the values inside each bracket, map-side (a hot value is one row), and
       running counts select the ranks. The nearest values outside matter where a rank lies
       between rows. A bracket that misses its ranks goes back to 2 with all it can hold.
    What one task sorts is a bracket of BRACKET_ROWS, whatever the rows."""
    by = list(by)
    G = by + ["column"]
    probs = list(dict.fromkeys(float(p) for p in probs))
    held = cut_lineage(df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols]), "quantiles")
    long = held.unpivot(by, list(cols), "column", "x").where(F.col("x").isNotNull() & ~F.isnan("x"))
    todo, done = cut_lineage(_sketched(long, G, probs), "brackets"), []
    while True:
        while (todo.agg(F.max("held")).first()[0] or 0) > BRACKET_ROWS:
            big = todo.where(F.col("held") > BRACKET_ROWS)
            todo = cut_lineage(todo.where(F.col("held") <= BRACKET_ROWS).unionByName(_narrowed(_placed(long, big, G), G)), "brackets")
        found = cut_lineage(_selected(_placed(long, todo, G), G), "ranks")
        done.append(found.where("hit").select(*G, "p", "value"))
        if not found.where("NOT hit").head(1):
            break
        todo = found.where("NOT hit").select(*G, "n", "least", "most", "p", "lo", "hi", "strict", F.greatest(F.col("n"), F.lit(BRACKET_ROWS + 1)).alias("held"))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def quantile_row(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                 name=lambda c, p: f"{c}_p{round(p * 100, 4):g}") -> DataFrame:
    """One row with a column per (column, prob)."""
    q = quantiles(df, cols, probs)
    keyed = q.withColumn("k", F.concat_ws("|", "column", F.col("p").cast("string")))
    keys = [f"{c}|{float(p)}" for c in cols for p in probs]
    wide = keyed.groupBy().pivot("k", keys).agg(F.first("value"))
    return wide.select(*[F.col(f"`{c}|{float(p)}`").alias(name(c, p)) for c in cols for p in probs])


def describe(df: DataFrame, cols: Sequence[str], pcts: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Per column: n, mean, std (ddof 1), min, percentiles, max — one row per column.

    A report: the projected input is persisted for its two passes (moments, then the
    distributed quantiles), the few result rows are collected, the cache released."""
    src = df.select(*cols).persist()
    try:
        one = src.agg(*[x for c in cols for x in (
            F.count(c).alias(f"{c}__n"), F.avg(c).alias(f"{c}__mean"),
            F.stddev_samp(c).alias(f"{c}__std"), F.min(c).cast("double").alias(f"{c}__min"),
            F.max(c).cast("double").alias(f"{c}__max"))]).first()
        qv = {(r["column"], r["p"]): r["value"] for r in quantiles(src, cols, pcts).collect()}
    finally:
        src.unpersist()
    names = [f"p{round(p * 100, 4):g}" for p in pcts]
    rows = [(c, one[f"{c}__n"], one[f"{c}__mean"], one[f"{c}__std"], one[f"{c}__min"], one[f"{c}__max"],
             *[qv.get((c, float(p))) for p in pcts]) for c in cols]
    schema = ("column string, n bigint, mean double, std double, min double, max double, "
              + ", ".join(f"{n} double" for n in names))
    return df.sparkSession.createDataFrame(rows, schema)


def group_stats(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column],
                min_n: int | None = None, n_name: str = "n") -> DataFrame:
    """Per key: row count plus named aggregate expressions; keep groups with >= min_n rows."""
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(n_name),
                                *[e.alias(k) for k, e in aggs.items()])
    return out.where(F.col(n_name) >= min_n) if min_n else out


def grouped_medians(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Exact median per group and column, wide: (keys..., <col>_median)."""
    q = quantiles(df, cols, [0.5], by=keys)
    w = q.groupBy(*keys).pivot("column", list(cols)).agg(F.first("value"))
    return w.select(*keys, *[F.col(c).alias(f"{c}_median") for c in cols])


def class_share_by_key(df: DataFrame, key: str, cls: str, classes: Sequence = (0, 1, 2),
                       min_n: int = 50) -> DataFrame:
    """Contingency key x class, row-normalised to %; keep keys with >= min_n rows."""
    t = df.where(F.col(cls).isNotNull()).groupBy(key).pivot(cls, list(classes)).agg(F.count(F.lit(1)))
    names = [str(c) for c in classes]
    tot = sum((F.coalesce(F.col(n), F.lit(0)) for n in names), F.lit(0))
    t = t.withColumn("n", tot)
    return t.where(F.col("n") >= min_n).select(
        key, "n", *[(F.coalesce(F.col(n), F.lit(0)) * 100.0 / F.col("n")).alias(f"pct_{n}") for n in names])


def conditional_share(cond: Column) -> Column:
    """Mean of a predicate with NULL counted as false (pandas ``(x == v).mean()``)."""
    return F.avg(F.coalesce(cond, F.lit(False)).cast("double"))


def band_distribution(df: DataFrame, c: str, edges: Sequence[float], labels: Sequence[str]) -> DataFrame:
    """Rows per right-open band [a, b) and % of all rows (outside/NULL -> band NULL)."""
    from finpanel.functions.scalar import bin_right_open
    d = df.select(bin_right_open(c, edges, labels).alias("band"))
    return value_counts(d, "band").withColumn("pct", F.col("share") * 100.0).drop("share")


def missing_by_group(df: DataFrame, key: str, cols: Sequence[str], limit: float = 15.0) -> DataFrame:
    """Per column: coverage %, std (ddof 1) across groups of the group's % missing,
    structural = std > limit. NULL group keys are dropped (pandas groupby)."""
    per = df.where(F.col(key).isNotNull()).groupBy(key).agg(
        *[(F.avg(F.col(c).isNull().cast("double")) * 100.0).alias(c) for c in cols])
    long = per.unpivot([key], list(cols), "column", "pct_missing")
    sd = long.groupBy("column").agg(F.stddev_samp("pct_missing").alias("std_missing"))
    cov = coverage(df, cols).select("column", "pct_coverage")
    return cov.join(sd, "column", "left").withColumn(
        "structural", F.coalesce(F.col("std_missing") > limit, F.lit(False)))


def dup_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs more than once, with the group size.

    Group sizes are a partial/final count (a huge group is pre-counted map-side) joined
    back to the rows — no group is gathered into one task."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("dup_n")).where(F.col("dup_n") > 1)
    a, b = df.alias("a"), sizes.alias("b")
    cond = [F.col(f"a.`{k}`").eqNullSafe(F.col(f"b.`{k}`")) for k in keys]  # NULL keys group together
    return a.join(b, cond, "inner").select("a.*", "b.dup_n")


def year_counts(df: DataFrame, fy: str = "fy", cut: int = S.TRAIN_LAST_FY) -> DataFrame:
    return (df.groupBy(fy).agg(F.count(F.lit(1)).alias("n"))
              .withColumn("split", F.when(F.col(fy) <= cut, "train").otherwise("validation")))
