"""Merkle manifest: against a tree built in memory, over bands of every height."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from folio.llm import merkle

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, leaf string, g string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def path(tree, i):
    out = []
    for nodes in tree[:-1]:
        pair = nodes[i - i % 2 : i - i % 2 + 2]
        out.append((pair[: i % 2], pair[i % 2 + 1 :]))
        i //= 2
    return out


def fold(h, proof):
    for left, right in proof:
        h = H(*left, h, *right)
    return h


def brute(rows):
    rows = [(d, s, g, n, t) for d, t, g, s, n, *_ in rows]
    of = defaultdict(list)
    for r in rows:
        of[r[2]].append(r)
    langs = sorted(of, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for g in langs:
        of[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = levels([leaf(r) for r in of[g]])
    upper = levels([trees[g][-1][0] for g in langs])
    out = Counter()
    for k, g in enumerate(langs):
        for i, r in enumerate(of[g]):
            p = path(trees[g], i) + path(upper, k)
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            got = fold(leaf((*r[:3], r[3] + 1 if bad and r[3] is not None else r[3], r[4])), p)
            assert fold(leaf(r), p) == upper[-1][0]
            out[(r[0], leaf(r), trees[g][-1][0], upper[-1][0], H(*(x for a, b in p for x in a + b)), got, got == upper[-1][0])] += 1
    return out


def rows(n, langs, seed=0):
    r = random.Random(seed)
    out = [(k, r.choice(["", "é\n x", "word " * 30, None]), langs[k % len(langs)], r.choice(["s", None, "="]), r.choice([k, None, 2**63 - 1, -1]), "own", "own") for k in range(n)]
    return out + [out[n // 2]] * 5 + [(None, "t", langs[0], None, 3, "own", None)] * 2 + [(n, "lone", "zz", "s", 4, None, None)]


@pytest.mark.parametrize("band,n,langs", [(1, 9, ["en"]), (2, 70, ["en", "en", "de", None, "", "ñ"]), (3, 130, ["en", "en", "en", "fr"]), (10, 60, ["en", "de"])])
def test_audited(spark, monkeypatch, band, n, langs):
    monkeypatch.setattr(merkle, "BAND", band)
    data = rows(n, langs, band)
    got = merkle.audited(spark.createDataFrame(data, SCHEMA)).collect()
    assert Counter(tuple(r) for r in got) == brute(data)
    assert any(not r.verified for r in got) and any(r.verified for r in got)


def test_empty(spark):
    got = merkle.audited(spark.createDataFrame([], SCHEMA))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"] and got.collect() == []


def test_store(spark, monkeypatch):
    """Every node of every level is in the store once."""
    monkeypatch.setattr(merkle, "BAND", 2)
    leaves = spark.createDataFrame([("a", k, H(str(k))) for k in range(37)] + [("b", 0, H("x"))], "g string, k int, leaf string")
    tree = merkle.build(leaves, "k")
    want = {("a", lev, i): h for lev, nodes in enumerate(levels([H(str(k)) for k in range(37)])) for i, h in enumerate(nodes)} | {("b", 0, 0): H("x")}
    got = [((r.g, r.level, r.first + i), h) for s in tree.store for r in s.collect() for i, h in enumerate(r.nodes)]
    assert len(got) == len(want) and dict(got) == want
    assert {r.g: r.top for r in tree.tops.collect()} == {"a": levels([H(str(k)) for k in range(37)])[-1][0], "b": H("x")}
