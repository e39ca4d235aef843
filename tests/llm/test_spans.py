"""Substring and suffix dedup against brute force on small alphabets with planted repeats."""
import numpy as np

from finpanel.llm import recompression, suffix_dedup

LAST = 1 << 63


def covered(units, window):
    """Removed positions of each row: (id, units) in; windows judged on the input."""
    least = {}
    for i, u in units:
        for p in range(len(u) - window + 1):
            k = tuple(u[p:p + window])
            least[k] = min(least.get(k, LAST), LAST - 1 if i is None else i)
    out = []
    for i, u in units:
        gone = np.zeros(len(u), bool)
        for p in range(len(u) - window + 1):
            if least[tuple(u[p:p + window])] < (LAST - 1 if i is None else i):
                gone[p:p + window] = True
        out.append((i, u, gone))
    return out


def texts(rng, letters, join, n=40):
    cores = [[rng.choice(letters) for _ in range(rng.randrange(50, 130))] for _ in range(6)]
    rows = []
    for k in range(n):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            few = letters[:rng.choice((1, 2, len(letters)))]
            parts += [rng.choice(few) for _ in range(rng.randrange(0, 60))]
            if rng.random() < 0.6:
                parts += rng.choice(cores)[rng.randrange(0, 20):]
        rows.append((rng.randrange(1000), join.join(parts)))
    return rows + [(rows[0][0], rows[1][1]), (None, rows[2][1]), (1001, None), (1002, ""), (1003, "short"), rows[3], (1004, rows[4][1] + join + rows[4][1])]


def test_substring_dedup(docs_of, rng):
    rows = texts(rng, ["a", "bb", "c", "Dé", "e."], " ")
    got = {(r.id, r.n_words, r.n_removed, bytes(r.kept)) for r in recompression.substring_dedup(docs_of(rows)).collect()}
    want = {(i, len(u), int(g.sum()), " ".join(w for w, x in zip(u, g) if not x).encode())
            for i, u, g in covered([(i, (t or "").split()) for i, t in rows], 50)}
    assert got == want
    assert any(x[2] for x in want)


def test_suffix_dedup(docs_of, rng):
    rows = texts(rng, ["a", "b", "é"], "")
    got = set()
    for r in suffix_dedup.suffix_dedup(docs_of(rows)).collect():
        got.add((r.id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)))
        assert sum(s.end - s.first for s in r.spans) == r.n_removed
    want = set()
    for i, u, g in covered([(i, (t or "").encode()) for i, t in rows], 50):
        runs = int(np.count_nonzero(np.diff(np.concatenate(([0], g.astype(int)))) == 1))
        want.add((i, len(u), int(g.sum()), runs, bytes(b for b, x in zip(u, g) if not x)))
    assert got == want
    assert any(x[2] for x in want)


def test_long_text_and_run(docs_of):
    rows = [(1, "ab" * 40_000), (2, "x " * 60_000), (3, "y" + "ab" * 100), (4, "x " * 70)]
    got = {r.id: (r.n_bytes, r.n_removed) for r in suffix_dedup.suffix_dedup(docs_of(rows)).collect()}
    assert got == {1: (80_000, 0), 2: (120_000, 0), 3: (201, 200), 4: (140, 140)}


def test_empty(docs_of):
    assert suffix_dedup.suffix_dedup(docs_of([])).count() == 0
    assert recompression.substring_dedup(docs_of([])).count() == 0
