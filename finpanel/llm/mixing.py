"""Mixing sources to target weights by hierarchical budgeting.

A token budget runs down a tree (domain, language, source): each node shares its budget
among its children by weight; a child that cannot use its share (its capacity is its
tokens times ``max_epochs``) is filled, and what is left over goes to its siblings in
proportion to their weights before anything reaches the siblings of an ancestor. That is
water-filling per sibling group, a window over the tree's nodes. A leaf with budget b and
t tokens takes b // t whole epochs and, of the next epoch's seeded order, the prefix of
documents whose tokens fit the rest.

The order is cut into buckets of about ``BUCKET_ROWS`` documents by hash range: bucket
totals are pre-aggregated and only documents of one bucket are ever sorted together, so a
leaf with a third of all rows is spread like any other.

Defined cases: a null or missing level value is the node ``(none)``; a null text has no
tokens; documents without tokens are never taken; a weight of 0 takes nothing; weights
not listed are ``default_weight``; rows that repeat an id are ordered side by side, by
their text's hash, and counted each; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finpanel.llm.common import WORD, land, row_key, run_dir

BUCKET_ROWS = 1024
#: Columns of the result besides the levels.
RESULT = ("id", "n_tokens", "copies", "d", "r")
#: Leaves up to this many are broadcast (about 100 bytes each); beyond it the join shuffles.
BROADCAST_LEAVES = 100_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _weight(col: Column, weights: dict[str, int], default: int) -> Column:
    if not weights:
        return F.lit(default)
    table = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])
    return F.coalesce(F.element_at(table, col), F.lit(default))


def share_out(nodes: DataFrame, parents: list[str]) -> DataFrame:
    """Water-filling: nodes (parents, cap, w, budget of the parent) -> the same with ``alloc``."""
    group = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    order = group.orderBy(F.col("cap") / F.col("w"), "node")
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    weights = F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
    return (nodes.withColumn("level", (F.col("budget") - before).cast("double") / weights.cast("double"))
            .withColumn("level", F.max("level").over(group))
            .withColumn("alloc", F.floor(F.least(F.col("cap").cast("double"), F.col("w") * F.col("level")))))


def leaf_budgets(leaves: DataFrame, levels: list[str], weights: list[dict[str, int]], budget_share: float,
                 max_epochs: int, default_weight: int) -> DataFrame:
    """Leaves (levels, tokens, rows) -> with ``alloc``, the tokens each is to give."""
    caps = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    for k, name in enumerate(levels):
        caps = caps.withColumn(f"w{k}", _weight(F.col(name), weights[k], default_weight))
    # A node under a weight of 0 has no capacity, so its siblings see none of it.
    usable = caps.where(" and ".join(f"w{k} > 0" for k in range(len(levels))))
    total = leaves.agg(F.floor(F.sum("tokens") * F.lit(budget_share)).alias("budget"))
    above: DataFrame | None = None
    for k, name in enumerate(levels):
        nodes = usable.groupBy(*levels[:k + 1]).agg(F.sum("cap").alias("cap"), F.first(f"w{k}").alias("w"))
        nodes = nodes.withColumn("node", F.col(name))
        nodes = nodes.join(above, levels[:k]) if k else nodes.crossJoin(F.broadcast(total))  # total is one row
        above = share_out(nodes, levels[:k]).select(*levels[:k + 1], F.col("alloc").alias("budget"))
    return leaves.join(above.withColumnRenamed("budget", "alloc"), levels)


def mix(docs: DataFrame, levels: dict[str, Column], weights: list[dict[str, int]], budget_share: float = 0.5,
        max_epochs: int = 4, seed: int = 42, id_col: str = "doc_id", text_col: str = "text",
        default_weight: int = 1) -> DataFrame:
    """One row per document taken: id, the levels, n_tokens, copies (times it is to be used), d, r (its key).

    ``levels`` maps the level names, root first, to columns of ``docs``; ``weights`` has
    one {value: integer weight} per level; the budget is ``budget_share`` of all tokens.
    A level named like another column of the result gets an underscore.
    """
    spark = docs.sparkSession
    base = run_dir(spark, "mix")
    names = [f"level_{k}" for k in range(len(levels))]  # whatever they are called, no clash in here
    d, r = row_key(id_col, text_col)
    rows = land(docs.select(F.col(id_col).alias("id"), d.alias("d"), r.alias("r"), *[F.coalesce(c.cast("string"), F.lit("(none)")).alias(n)
                                                         for n, c in zip(names, levels.values())],
                            word_count(F.col(text_col)).alias("n_tokens")).where("n_tokens > 0"), f"{base}/rows")
    leaves = land(rows.groupBy(*names).agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")),
                  f"{base}/leaves")
    plan = land(leaf_budgets(leaves, names, weights, budget_share, max_epochs, default_weight)
                .withColumn("epochs", F.floor(F.col("alloc") / F.col("tokens")))
                .withColumn("rest", F.col("alloc") - F.col("epochs") * F.col("tokens")), f"{base}/plan")
    if plan.count() <= BROADCAST_LEAVES:
        plan = F.broadcast(plan)
    order = F.md5(F.concat_ws(":", F.lit(seed), F.col("epochs"), F.coalesce(F.col("id").cast("string"), F.lit("null"))))
    spread = F.conv(F.substring("order", 1, 10), 16, 10).cast("long")
    dealt = (rows.join(plan, names).withColumn("order", order)
             .withColumn("bucket", F.floor(spread * F.ceil(F.col("rows") / BUCKET_ROWS) / F.lit(1 << 40))))
    key = [*names, "bucket"]
    sums = dealt.groupBy(*key).agg(F.sum("n_tokens").alias("in_bucket"))
    ahead = Window.partitionBy(*names).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("ahead", F.coalesce(F.sum("in_bucket").over(ahead), F.lit(0))).select(*key, "ahead")
    so_far = Window.partitionBy(*key).orderBy("order", "id", "r").rowsBetween(Window.unboundedPreceding, 0)
    taken = (dealt.join(sums, key)
             .withColumn("upto", F.col("ahead") + F.sum("n_tokens").over(so_far))
             .withColumn("copies", F.col("epochs") + (F.col("upto") <= F.col("rest")).cast("long")))
    shown = [F.col(n).alias(f"{name}_" if name.lower() in RESULT else name) for n, name in zip(names, levels)]
    return taken.where("copies > 0").select("id", *shown, "n_tokens", "copies", "d", "r")
