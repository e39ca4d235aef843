"""Registered queries against their oracles, and the pipeline against a brute-force run."""
import re

import duckdb
import pytest
from test_partenum import brute

import corpus_pipeline
from finpanel.llm import catalog, decontaminate, zstd_langid
from finpanel.llm.common import docs_table
from tools.check_oracle import TABLES, rows_of

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = catalog.QUERIES[name](spark, SF)
    res = con.execute(catalog.ORACLES[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(cols, res.fetchall())


def test_every_operator_has_a_query():
    assert {int(n[2:].split("_")[0]) for n in catalog.QUERIES} == set(range(1, 14))


def test_pipeline_as_brute_force(spark):
    docs = docs_table(spark, SF)
    rows = [(r.doc_id, r.text) for r in zstd_langid.identify(docs, docs).where("NOT language.rejected").select("doc_id", "text").orderBy("doc_id").collect()]
    seen, once = set(), []
    for i, t in rows:
        k = re.sub("[\x20\x09-\x0d]+", " ", t or "")
        if k not in seen:
            once.append((i, t))
        seen.add(k)
    groups = {d: c for d, _, c in brute(once)}
    left = [(i, t) for i, t in once if groups[i] == i]
    items = [r.text for r in docs_table(spark, SF, "benchmark").collect()]

    def grams(text):
        w = decontaminate.tokens([text.encode()]).value.tolist()
        return {tuple(w[k:k + 5]) for k in range(len(w) - 4)}

    items = [grams(t) for t in items]
    left = [i for i, t in left if not any(2 * len(g & grams(t)) >= len(g) for g in items)]
    base = f"{corpus_pipeline.run_dir(spark, 'test')}"
    now = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        now = corpus_pipeline.land(stage(spark, now, SF), f"{base}/{k}")
        if k < 4:
            assert now.columns == docs.columns
        if k == 3:
            assert sorted(r.doc_id for r in now.collect()) == left
    tokens = {i: len((t or "").split()) for i, t in rows}
    used = sum(r.n_tokens * r.copies for r in now.collect())
    # A leaf stops before the document that would overrun its budget, so small tables fall short.
    assert 0.25 * sum(tokens[i] for i in left) <= used <= 0.5 * sum(tokens[i] for i in left)
