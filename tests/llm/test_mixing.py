from pyspark.sql import functions as F

from finpanel.llm import mixing

def levels():
    return {"domain": F.col("source"), "language": F.col("lang")}


def fill(budget, nodes):
    """Water-filling by rounds: {name: (cap, weight)} -> {name: share}."""
    out, left = {}, dict(nodes)
    while left:
        level = budget / sum(w for _, w in left.values())
        full = {k: c for k, (c, w) in left.items() if c <= level * w}
        if not full:
            return out | {k: level * w for k, (_, w) in left.items()}
        out |= full
        budget -= sum(full.values())
        left = {k: v for k, v in left.items() if k not in full}
    return out


def test_shortage_goes_to_siblings_first(docs_of):
    rows = []
    for source, lang, n in (("a", "x", 10), ("a", "y", 400), ("b", "x", 300), ("b", "y", 300), ("c", "z", 30), (None, None, 5), ("d", "x", 50)):
        rows += [(len(rows) + k, "w " * 10, lang, source) for k in range(n // 5)]
    docs = docs_of(rows + [(9000, None, "x", "a"), (9001, "", "x", "a")])
    weights = [{"a": 4, "b": 2, "c": 1, "d": 0}, {}]
    got = mixing.mix(docs, levels(), weights, 0.5, max_epochs=2).groupBy("domain", "language").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("t")).collect()
    got = {(r.domain, r.language): r.t for r in got}
    tokens = {}
    for _, _, lang, source in rows:
        k = (source or "(none)", lang or "(none)")
        tokens[k] = tokens.get(k, 0) + 10
    caps = {k: 2 * v for k, v in tokens.items() if k[0] != "d"}
    w = {"a": 4, "b": 2, "c": 1, "(none)": 1}
    top = fill(sum(tokens.values()) * 0.5, {d: (sum(c for k, c in caps.items() if k[0] == d), w[d]) for d in w})
    want = {}
    for d, share in top.items():
        want |= {(d, k): v for k, v in fill(share, {k[1]: (c, 1) for k, c in caps.items() if k[0] == d}).items()}
    assert set(got) == set(want)
    assert all(v - 11 <= got[k] <= v for k, v in want.items())


def test_prefix_is_seeded_and_whole_epochs_repeat(docs_of, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 7)  # many buckets
    docs = docs_of([(k, "w " * (1 + k % 5), "x", "a") for k in range(200)])
    one = {(r.id, r.copies) for r in mixing.mix(docs, levels(), [{}, {}], 1.5).collect()}
    assert one == {(r.id, r.copies) for r in mixing.mix(docs.repartition(5), levels(), [{}, {}], 1.5).collect()}
    assert len(one) == 200 and {c for _, c in one} == {1, 2}
    assert 895 <= sum((1 + i % 5) * c for i, c in one) <= 900
    assert one != {(r.id, r.copies) for r in mixing.mix(docs, levels(), [{}, {}], 1.5, seed=1).collect()}


def test_level_names_do_not_clash(docs_of):
    docs = docs_of([(k, "w " * (1 + k % 4), "xyz"[k % 3], "ab"[k % 2]) for k in range(60)])
    want = {(r.id, r.copies, r.domain) for r in mixing.mix(docs, levels(), [{"a": 3}, {}], 0.5).collect()}
    for name in ("order", "bucket", "rows", "id", "tokens", "cap", "n_tokens", "node", "budget"):
        got = mixing.mix(docs, {name: F.col("source"), "language": F.col("lang")}, [{"a": 3}, {}], 0.5)
        shown = f"{name}_" if name in mixing.RESULT else name
        assert {(r.id, r.copies, r[shown]) for r in got.collect()} == want, name


def test_empty(docs_of):
    assert mixing.mix(docs_of([]), levels(), [{}, {}]).count() == 0
