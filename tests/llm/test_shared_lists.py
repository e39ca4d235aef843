"""Shared keys of each row: every text is cut once, rows alike stay rows of their own."""
import numpy as np

from finpanel.llm import keycount
from finpanel.llm.common import mix64


def test_texts_are_cut_once(spark, rng, tmp_path):
    log = str(tmp_path / "cut")

    def words(texts):
        with open(log, "a") as f:
            f.write("x" * len(texts))
        found = [(i, int(w[1:]) + 1) for i, t in enumerate(texts) for w in (t or b"").split()]
        return np.array([i for i, _ in found], np.int64), mix64(np.array([h for _, h in found], np.uint64))

    rows = [(k, 10 * k, " ".join(f"w{rng.randrange(200)}" for _ in range(rng.randrange(0, 9)))) for k in range(60)]
    rows.append(rows[7])
    docs = spark.createDataFrame(rows, "d long, r long, text string").repartition(5).localCheckpoint()
    out = keycount.shared_keys(docs, words, 100, str(tmp_path / "out"))
    held = {}
    for d, r, text in rows:
        for w in text.split():
            held.setdefault(w, set()).add(r)
    key = {w: mix64(np.array([int(w[1:]) + 1], np.uint64)).view(np.int64)[0].item() for w in held}
    expected = [(d, r, sorted(key[w] for w in set(text.split()) if len(held[w]) > 1)) for d, r, text in rows]
    assert sorted((x.d, x.r, sorted(x["keys"])) for x in out.collect()) == sorted(x for x in expected if x[2])
    assert len(open(log).read()) == len(rows)  # two jobs over the texts (count, then ask) would cut each twice
