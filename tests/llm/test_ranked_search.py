"""Reversed search against a brute-force scorer, with awkward rows, small shards and small segments."""
import math
import re
from collections import Counter

import pytest

from finpanel.llm import ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    n, length = sum(1 for _, b in bags if b), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for i, b in bags:
            m = 75 + 25 * sum(b.values()) * n // length if length else 0
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * b[t]) // (1000 * b[t] + 12 * m)) for t in terms(text) if b[t])
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def awkward(rng):
    vocab = [f"w{k}" for k in range(60)] + ["Été", "straße", "ÉTÉ", "x1", "日本", "don't"]
    docs = [(i, " ".join(rng.choices(vocab, k=rng.randrange(0, 40))), "en") for i in range(150)]
    docs += [(3, "w1 w2 w3"), (3, "w1 w2 w3"), (None, "w1 w2 w3"), (None, "w1 w2 w3"), (900, None), (901, ""), (902, "... -- "),
             (-5, "w1 w2 w3"), ((1 << 63) - 1, "w1 w2 w3"), (903, "W4,w4;w4\x00w5é" * 4000)]
    items = [(k, " ".join(rng.choices(vocab, k=rng.randrange(1, 12)))) for k in range(20)]
    items += [(5, "w1 w1 w2"), (None, "w3 x1"), (None, None), (77, "--"), (78, "nowhere"), (79, "W4 w5É w5é 日本")]
    return [d[:2] for d in docs], items


@pytest.mark.parametrize("bound,segment", [(ranked_search.SHARD_POSTINGS, ranked_search.SEGMENT), (17, 50)])
def test_as_brute_force(spark, docs_of, rng, monkeypatch, bound, segment):
    monkeypatch.setattr(ranked_search, "SEGMENT", segment)
    docs, items = awkward(rng)
    table = spark.createDataFrame([(*i, "clash", 1) for i in items], "item_id long, text string, id string, shard int").repartition(3)
    got = ranked_search.search(docs_of(docs), table, 7, bound=bound)
    assert got.columns == ["item_id", "rank", "id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(docs, items, 7)


def test_segments_keep_terms(monkeypatch):
    monkeypatch.setattr(ranked_search, "SEGMENT", 64)
    text = ("ab cd " * 50 + "z" * 10_000 + " ü" * 90).encode()
    cut = list(ranked_search.segments(text))
    assert b"".join(cut) == text and len(cut) > 3
    assert [t for s in cut for t in terms(s.decode())] == terms(text.decode())


def test_empty_tables(spark, docs_of):
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    docs = docs_of([(1, "a b")])
    assert ranked_search.search(docs, items.where("item_id < 0")).count() == 0
    assert ranked_search.search(docs.where("doc_id < 0"), items).count() == 0
    assert [tuple(r)[:3] for r in ranked_search.search(docs, items).collect()] == [(1, 1, 1)]


def test_long_documents_use_whole_numbers():
    import numpy as np
    n = np.asarray([1 << 40, 3])
    assert ranked_search.length_share(n, 1 << 35, 1 << 50).tolist() == [75 + 25 * x * (1 << 35) // (1 << 50) for x in n.tolist()]
