"""Rows with null or repeated ids: the pipeline's decisions take effect on them, too."""
from collections import Counter

import corpus_pipeline
from finpanel.llm import partenum


def test_one_row_of_a_group_without_distinct_ids_stays(docs_of):
    def text(name, n=120):
        return " ".join(f"{name}{k}" for k in range(n))

    rows = [(None, text("a") + f" tail{k}") for k in range(3)] + [(None, text("a"))] * 2
    rows += [(5, text("b")), (5, text("b") + " tail"), (5, text("b")), (8, text("b") + " end"), (5, text("c")), (None, text("d"))]
    rows += [(None, None), (None, None), (7, "")]
    kept = partenum.one_per_group(docs_of(rows))
    assert kept.columns == docs_of(rows).columns
    got = Counter((r.doc_id, (r.text or "")[:2]) for r in kept.collect())
    assert got == {(None, "a0"): 1, (5, "b0"): 1, (5, "c0"): 1, (None, "d0"): 1, (None, ""): 2, (7, ""): 1}


def test_mixture_takes_the_rows_that_were_chosen(spark, docs_of):
    rows = [(None if k % 3 else k // 2, "w " * (1 + k % 9) + f"x{k}", "en", f"src{k % 3}") for k in range(240)]
    rows += [(None, "same words here", "en", "src1")] * 20 + [(None, "same words here", "de", "src1")] * 3
    rows += [(None, None), (None, "")] * 5 + [(3, "")]
    docs = docs_of(rows)
    got = corpus_pipeline.mixture(spark, docs, "").collect()
    copies = "copies_" if "copies_" in got[0].asDict() else "copies"
    assert all(r.text and r.n_tokens == len(r.text.split()) for r in got)
    used = sum(r.n_tokens * r[copies] for r in got)
    total = sum(len((r[1] or "").split()) for r in rows)
    assert 0.4 * total <= used <= 0.5 * total
    have = Counter((r[0], r[1]) for r in rows)
    assert all(n <= have[k] for k, n in Counter((r.doc_id, r.text) for r in got).items())
