"""Looking keys up: a bucket's table is moved once, and the row filter keeps all that is asked for."""
import re
from collections import Counter

import numpy as np

from finpanel.llm import common, keycount


def test_look_up_moves_each_table_once(spark, rng):
    def hash_of(word):
        return int.from_bytes(word.ljust(8, b"\0")[:8], "big") * 0x9E3779B97F4A7C15 % (1 << 64)

    def words(texts):
        found = [(i, hash_of(w)) for i, t in enumerate(texts) for w in (t or b"").split()]
        return np.array([i for i, _ in found], np.int64), np.array([h for _, h in found], np.uint64)

    rows = [(k, 10 * k, " ".join(rng.choices([f"w{j}" for j in range(40)], k=rng.randrange(0, 9)))) for k in range(90)]
    docs = spark.createDataFrame(rows, "d long, r long, text string").repartition(9)
    table = keycount.count_keys(docs, words, 12)
    out = keycount.look_up(docs, words, table, 12, lambda d, r, key, times, n: (d, r, key.view(np.int64), times), "d long, r long, key long, times long")
    sets = {d: Counter(t.split()) for d, _, t in rows}
    held = Counter(w for s in {t for _, _, t in rows} for w in set(s.split()))
    expected = Counter((d, 10 * d, np.uint64(hash_of(w.encode())).view(np.int64).item(), c) for d, s in sets.items() for w, c in s.items() if held[w] > 1)
    assert Counter(tuple(r) for r in out.collect()) == expected
    # A join would put a copy of the bucket's table beside every slice.
    assert "Join" not in re.sub(r"#\d+", "", out._jdf.queryExecution().executedPlan().toString())


def test_row_filter_keeps_all_that_is_asked_for(spark, monkeypatch):
    rows = spark.range(4000).selectExpr("id AS d", "id * 7 AS r", "'x' AS text")
    need = rows.where("d % 50 = 0").select("d", "r")
    found = {r.d for r in common.likely(rows, need).collect()}
    assert set(range(0, 4000, 50)) <= found and len(found) < 400
    assert common.likely(rows, need).columns == rows.columns
    monkeypatch.setattr(common, "FILTER_WORDS", 2)  # all bits set: a filter that is full passes rows, it drops none
    assert set(range(0, 4000, 50)) <= {r.d for r in common.likely(rows, need).collect()}
