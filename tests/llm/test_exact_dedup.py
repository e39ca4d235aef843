import hashlib
import re

from pyspark.sql import functions as F

from finpanel.llm import exact_dedup

ROWS = [(5, "a  b"), (3, "a\tb"), (9, "a b"), (4, None), (8, ""), (None, "a b"), (2, "z"), (2, "z"), (7, "a b"), (6, "x" * 200_000)]


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub("[\x20\x09-\x0d]+", " ", t or ""), []).append(i)
    return sorted(((i, min(x for x in g if x is not None), len(g), hashlib.sha256(t.encode()).hexdigest())
                   for t, g in groups.items() for i in g), key=repr)


def result(df):
    return sorted(((r.id, r.keep_id, r.group_size, r.digest.hex()) for r in df.collect()), key=repr)


def test_groups_as_brute_force(docs_of):
    out = exact_dedup.exact_dedup(docs_of(ROWS))
    assert result(out) == brute(ROWS)
    assert out.where("kept").count() == len({x[3] for x in brute(ROWS)})


def test_equal_digests_of_different_texts_are_told_apart(docs_of):
    weak = exact_dedup.exact_dedup(docs_of(ROWS), digest=lambda t: F.length(t).cast("string").cast("binary"))
    want = sorted(((i, k, n) for i, k, n, _ in brute(ROWS)), key=repr)
    assert sorted(((r.id, r.keep_id, r.group_size) for r in weak.collect()), key=repr) == want


def test_one_row_of_each_text_stays_with_its_columns(docs_of):
    docs = docs_of(ROWS)
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([3, 4, 2, 7, 6], key=repr)


def test_empty(docs_of):
    assert exact_dedup.exact_dedup(docs_of([])).count() == 0
    assert exact_dedup.drop_copies(docs_of([])).count() == 0


def test_state_lasts_over_batches(spark, tmp_path):
    path, seen = str(tmp_path / "rows"), []
    for part in (["a", "b"], ["b", "c"]):
        rows = spark.createDataFrame([(i, False, t.encode(), ("f", i)) for i, t in enumerate(part)],
                                     "id long, no_id boolean, digest binary, locator struct<file:string,row:long>")
        rows.write.mode("append").parquet(path)
        state = exact_dedup.stream_state(rows, path, str(tmp_path / "state"), files_per_batch=1)
        seen.append({bytes(r.digest).decode(): r.n for r in state.collect()})
    assert seen == [{"a": 1, "b": 1}, {"a": 1, "b": 2, "c": 1}]
