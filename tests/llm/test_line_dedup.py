from finpanel.llm.line_dedup import line_dedup


def brute(rows):
    rows = sorted(set(rows), key=lambda x: (x[0] is None, x[0] or 0))
    seen, out = set(), {}
    for i, t in rows:
        lines = t.split("\n") if t is not None else []
        gone = set()
        for p in range(len(lines) - 2):
            g = tuple(lines[p:p + 3])
            if "".join(g).strip(" ") == "":
                continue
            if g in seen:
                gone |= {p, p + 1, p + 2}
            seen.add(g)
        out[i, t] = (len(lines), len(gone), None if t is None else "\n".join(x for p, x in enumerate(lines) if p not in gone))
    return out


def test_as_brute_force(docs_of, rng):
    rows = [(k, "\n".join(rng.choice(["a", "b", "", " ", "long line"]) for _ in range(rng.randrange(0, 25)))) for k in rng.sample(range(500), 60)]
    rows += [(900, None), (901, ""), (None, rows[0][1]), (902, "a\n" * 20_000), rows[1]]
    want = brute(rows)
    out = line_dedup(docs_of(rows)).collect()
    assert sorted(((r.id, r.n_lines, r.n_removed, r.kept_text) for r in out), key=repr) == sorted(((i, *want[i, t]) for i, t in rows), key=repr)
    assert line_dedup(docs_of([])).count() == 0
