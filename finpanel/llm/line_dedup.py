"""Line dedup on overlapping three-line windows.

Consecutive lines are hashed (two 64-bit hashes), windows that occur more than once are
found by one combinable aggregate, every occurrence but the first (smallest id, then
smallest position) is marked, and the marked windows of a document are merged into the
lines they cover. A window that a third of all documents hold is one row per map task in
the aggregate; the join back to its occurrences is left to AQE's skew splitting.

Defined cases: a null text has no lines; lines are split at "\\n" only; a text of fewer
lines than the window, and windows of blank lines only, are left alone; a null id orders
last; rows that repeat id and text count as one document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finpanel.llm.common import keyed, land, public_id, run_dir


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 3) -> DataFrame:
    """One row per input row: id, n_lines, n_removed, kept_text (null for a null text)."""
    rows = keyed(docs, id_col, text_col)
    lines = rows.select("d", "r", F.split("text", "\n").alias("l")).where(F.size("l") >= window)

    def at(i):
        return [F.get("l", i + k) for k in range(window)]

    grams = lines.select("d", "r", F.explode(F.transform(
        F.sequence(F.lit(0), F.size("l") - window),
        lambda i: F.struct(i.alias("p"), F.xxhash64(F.lit(1), *at(i)).alias("h1"), F.xxhash64(F.lit(2), *at(i)).alias("h2"),
                           (F.trim(F.concat(*at(i))) != "").alias("said")))).alias("g")).select("d", "r", "g.*").where("said")
    # Landed before it is joined back: AQE can then split a window that very many documents hold.
    first = land(grams.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("d", "r", "p")).alias("f"))
                 .where("n > 1").select("h1", "h2", "f"), f"{run_dir(docs.sparkSession, 'line-dedup')}/first")
    later = (grams.join(first, ["h1", "h2"]).where(F.struct("d", "r", "p") != F.col("f"))
             .groupBy("d", "r").agg(F.collect_set("p").alias("hit")))
    covered = F.flatten(F.transform("hit", lambda p: F.sequence(p, p + (window - 1))))
    every = F.sequence(F.lit(0), F.size("l") - 1)
    return (rows.join(later, ["d", "r"], "left").withColumn("l", F.split("text", "\n"))
            .withColumn("kept", F.when(F.col("hit").isNull(), every).otherwise(F.array_except(every, covered)))
            .select(public_id(F.col("d")).alias("id"),
                    F.coalesce(F.size("l"), F.lit(0)).cast("long").alias("n_lines"),
                    F.coalesce(F.size("l") - F.size("kept"), F.lit(0)).cast("long").alias("n_removed"),
                    F.when(F.col("hit").isNull(), F.col("text"))
                    .otherwise(F.array_join(F.transform("kept", lambda i: F.get("l", i)), "\n")).alias("kept_text")))
