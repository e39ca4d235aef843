"""The corpus pipeline: language ID, exact dedup, near duplicates, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as
Parquet in the shared folder and reads it back as the next stage's ``docs``, so a lost
executor costs tasks of the current stage only. All stages but the last return the columns
of ``documents``; the last adds how often each document is to be used.

Rows with a null id pass through all stages like any other, and rows that repeat an id are
told apart by their text; an empty table stays empty; a column that a stage would add under a name
``documents`` already has gets an underscore. Each operator's docstring says what else it does with nulls, ties and repeats.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from finpanel.llm import catalog, decontaminate, exact_dedup, mixing, partenum, zstd_langid
from finpanel.llm.common import docs_table, fresh, land, row_key, run_dir


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a clear margin; learned from their labels."""
    language = fresh(docs, "language")
    found = zstd_langid.identify(docs, docs)
    return found.where(~found[language]["rejected"]).drop(language)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest id."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (0.75 of five-word shingles) one row, with the smallest id."""
    return partenum.one_per_group(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    return decontaminate.clean_rows(docs, docs_table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the target weights take, with their number of copies."""
    levels = catalog.mix_levels(docs)
    taken = mixing.mix(docs, levels, catalog.MIX_WEIGHTS, catalog.MIX_SHARE, catalog.MIX_EPOCHS, catalog.MIX_SEED)
    # A row is found by its key, its node and, of rows alike in both, its place among them.
    key = {c: fresh(docs, f"taken_{c}") for c in ("d", "r", *levels)}
    place = fresh(docs, "taken_place")
    alike = Window.partitionBy(*key.values())
    taken = taken.select(*[F.col(c).alias(n) for c, n in key.items()], *[F.col(c).alias(fresh(docs, c)) for c in ("n_tokens", "copies")])
    taken = taken.withColumn(place, F.row_number().over(alike.orderBy(F.desc(fresh(docs, "copies")))))
    d, r = row_key("doc_id", "text")
    marked = docs.withColumns({key["d"]: d, key["r"]: r} | {key[n]: F.coalesce(c.cast("string"), F.lit("(none)")) for n, c in levels.items()})
    again = land(marked.where("text IS NOT NULL").groupBy(*key.values()).count().where("count > 1").drop("count"), f"{run_dir(spark, 'mixture')}/again")
    if again.isEmpty():
        marked = marked.withColumn(place, F.lit(1))
    else:
        many = marked.join(again, [*key.values()], "left_semi").withColumn(place, F.row_number().over(alike.orderBy(F.xxhash64(*docs.columns))))
        marked = marked.join(again, [*key.values()], "left_anti").withColumn(place, F.lit(1)).unionByName(many)
    return marked.join(taken, [*key.values(), place]).drop(*key.values(), place)


STAGES = [("language_id", language_id), ("exact_dedup", exact_copies), ("ngram_jaccard", near_copies),
          ("decontaminate", benchmark_leaks), ("mixing", mixture)]

#: zstandard sizes decide the first stage: no SQL. tests/llm compares with a brute-force run.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = run_dir(spark, "pipeline")
    docs = docs_table(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = land(stage(spark, docs, sf_dir), f"{base}/{k}-{name}")
    return docs
