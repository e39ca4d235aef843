"""Near-duplicate groups against brute force over all pairs."""
import re

from finpanel.llm import partenum


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), 1 << 62), 1 << 62 if d is None else d)
    return sorted(((d, len(sets[i]), least[find(i)] if least[find(i)] < 1 << 62 else None) for i, (d, _) in enumerate(rows)), key=repr)


def edited(rng, words, share):
    return [rng.choice("pqrs") + w if rng.random() < share else w for w in words]


def test_groups_as_brute_force(docs_of, rng):
    vocabulary = [f"w{k}" for k in range(300)]
    common = [rng.choice(vocabulary) for _ in range(60)]
    rows = []
    for base in range(12):
        words = [rng.choice(vocabulary) for _ in range(rng.choice((3, 6, 8, 12, 40, 150, 400)))]
        if base % 3 == 0:
            words = words[:len(words) // 2] + common + words[len(words) // 2:]
        for _ in range(6):
            rows.append(" ".join(edited(rng, words, rng.choice((0, 0.01, 0.02, 0.03, 0.05, 0.3)))))
    rows = list(zip(rng.sample(range(1000), len(rows)), rows))
    rows += [(2000, None), (2001, ""), (2002, " \n"), (2003, rows[0][1].upper()), (None, rows[7][1]), rows[8], (2004, "a b"), (2005, "A  B"), (2006, "a b c d e " * 900)]
    got = sorted(((r.id, r.n_shingles, r.component) for r in partenum.near_groups(docs_of(rows)).collect()), key=repr)
    assert got == brute(rows)
    assert len({x[2] for x in got}) < len(got) - 20


def test_one_of_each_group_stays(docs_of):
    text = " ".join(f"w{k}" for k in range(200))
    docs = docs_of([(4, text), (2, text + " tail"), (9, "other words stand here alone"), (1, None)])
    kept = partenum.one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 9]


def test_near_copies_of_a_large_group_are_compared_once(docs_of, rng, monkeypatch):
    """Blocks smaller than the group, a memory of found pairs that is cleared, members apart from the first one."""
    monkeypatch.setattr(partenum, "BLOCK", 8)
    monkeypatch.setattr(partenum, "SEEN", 16)
    words = [f"w{k}" for k in range(160)]
    rows = [(k, " ".join(edited(rng, words, rng.choice((0.01, 0.02, 0.03))))) for k in range(40)]
    docs = docs_of(rows + [(900, rows[3][1]), (901, " ".join(words))])
    got = sorted(((r.id, r.n_shingles, r.component) for r in partenum.near_groups(docs).collect()), key=repr)
    assert got == brute(rows + [(900, rows[3][1]), (901, " ".join(words))])


def test_only_texts_that_pass_the_row_filter_are_dealt_out(spark, tmp_path, monkeypatch):
    land, plans = partenum.land, {}

    def told(df, path):
        plans[path.rsplit("/", 1)[1]] = df._jdf.queryExecution().executedPlan().toString()
        return land(df, path)

    monkeypatch.setattr(partenum, "land", told)
    words = [f"w{k}" for k in range(60)]
    texts = [" ".join(words), " ".join(words[:58]), " ".join(words[:30]), *[f"nobody asks for text {k}" for k in range(200)]]
    rows = spark.createDataFrame([(k, 7 * k, t) for k, t in enumerate(texts)] + [(1, 7, texts[1])], "d long, r long, text string")
    pairs = spark.createDataFrame([((0, 0), (1, 7)), ((0, 0), (2, 14)), ((0, 0), (1, 7))], partenum.PAIR)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with more rows than a broadcast may have
    try:
        found = partenum.links(pairs, rows, 5, 75, str(tmp_path / "links")).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [(r.a.d, r.b.d) for r in found] == [(0, 1)]
    # A node comes before its inputs: rows reach the exchange of the exact join by way of the filter's.
    assert 0 <= plans["sets"].index("SortMergeJoin") < plans["sets"].index("BroadcastHashJoin")


def test_components(spark, tmp_path):
    path = [(k, k + 1) for k in range(60)] + [(100, 200), (300, 200), (7, 7)]
    out = partenum.components(spark.createDataFrame(path, "a long, b long"), str(tmp_path / "c"))
    got = {r.node: r.root for r in out.collect()}
    assert got == {**{k: 0 for k in range(61)}, 100: 100, 200: 100, 300: 100}


def test_empty(docs_of):
    assert partenum.near_groups(docs_of([])).count() == 0
