"""Merkle manifests against a plain tree, with awkward rows; changed rows are told from others."""
import hashlib
import random

import pytest

from finpanel.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row.doc_id, row.source, row.lang, row.n_chars, row.text)])


def tree(leaves, arity):
    """(top, siblings of every leaf)."""
    paths, now, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(now) > 1:
        for k in range(len(leaves)):
            lo = at[k] - at[k] % arity
            paths[k] += [now[j] for j in range(lo, min(lo + arity, len(now))) if j != at[k]]
        now = [h(*now[lo:lo + arity]) for lo in range(0, len(now), arity)]
        at = [a // arity for a in at]
    return now[0], paths


def plain(rows, arity):
    langs = sorted({r.lang for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    groups = {x: sorted((r for r in rows if r.lang == x), key=lambda r: (r.doc_id is None, r.doc_id or 0, leaf_of(r))) for x in langs}
    low = {x: tree([leaf_of(r) for r in g], arity) for x, g in groups.items()}
    root, high = tree([low[x][0] for x in langs], arity)
    return root, sorted(((r.doc_id is None, r.doc_id or 0, leaf_of(r), low[x][0], h(*low[x][1][k], *high[n])))
                        for n, x in enumerate(langs) for k, r in enumerate(groups[x]))


def awkward(seed):
    rng = random.Random(seed)
    rows = [(i, "x" * rng.randrange(9), rng.choice(["en", "de", None, "", "é", "zz"]), rng.choice(["s", None])) for i in range(130)]
    rows += [(7, "again", "en", "s")] * 3 + [(7, "other", "en", "s"), (None, "no id", "en", "s"), (None, None, None, None), (500, "", "only", "s"),
             (501, "Very long Text. " * 20_000, "en", "s")]
    return rows


@pytest.mark.parametrize("arity", [2, 3, 8])
def test_as_plain_tree(docs_of, arity):
    docs = docs_of(awkward(arity))
    root, want = plain(docs.collect(), arity)
    m = merkle.manifest(docs, arity=arity)
    got = m.proofs.withColumns({"l": merkle.hex_text(merkle.F.col("leaf")), "s": merkle.hex_text(merkle.F.col("subroot")),
                                "p": merkle.siblings_digest(merkle.F.col("path"))}).collect()
    assert m.root == root
    assert sorted((r.doc_id is None, r.doc_id or 0, r.l, r.s, r.p) for r in got) == want


def test_tampered_rows_fail(docs_of):
    docs = docs_of(awkward(1))
    m = merkle.manifest(docs, carry={"altered": merkle.tampered(docs)})
    assert {r.verified for r in merkle.check_proofs(m, "leaf").collect()} == {True}
    bad = merkle.check_proofs(m, "altered").where("NOT verified").collect()
    assert [r.doc_id for r in bad] == [501]  # the only text with capitals; CRC-32 of "501" is divisible by 3


def test_single_row_and_none(docs_of):
    one = docs_of([(1, "a", "en", "s")])
    m = merkle.manifest(one)
    row = merkle.check_proofs(m, "leaf").first()
    assert m.root == row.leaf.hex() == row.subroot.hex() and row.path == [] and row.verified
    none = merkle.manifest(one.where("doc_id < 0"))
    assert none.root is None and none.proofs.count() == 0 and merkle.check_proofs(none, "leaf").count() == 0
