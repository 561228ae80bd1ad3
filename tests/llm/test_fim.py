"""Fill-in-the-middle: against a regular expression, at every size, and what a text with sentinels becomes."""

import hashlib
import random
import re

import numpy as np
import pytest

from folio.llm import fim

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(i, t):
    t = t or ""
    d = hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()
    h = [int(d[8 * k : 8 * k + 8], 16) for k in range(4)]
    w = TOKEN.findall(t)
    a, b = sorted((h[0] % (len(w) + 1), h[1] % (len(w) + 1)))
    p, m, s = "".join(w[:a]), "".join(w[a:b]), "".join(w[b:])
    if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return i, len(w), "plain", None, None, t
    if h[3] % 100 < 80:
        return i, len(w), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return i, len(w), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def random_text(r, size, marks=False):
    parts = ["a", "Bc", "é", "日本", " ", "  ", "\n", "\t", "\x0b", "<", "<P", "<<S", "M>", ">", "\x85", "　", "😀"]
    return "".join(r.choice(parts + ["<P>", "<S>", "<M>"] * marks) for _ in range(size)).replace("<S>" if not marks else "\0", "<S ")


@pytest.mark.parametrize("size", [0, 1, 3, 200, 256, 257, 3000])
def test_scan(size):
    r = random.Random(size)
    for _ in range(20):
        texts = [random_text(r, r.randrange(size + 1), r.random() < 0.3).encode() for _ in range(5)]
        off = np.concatenate([[0], np.cumsum([len(x) for x in texts])]).astype(np.int64)
        s = fim.Scan(np.frombuffer(b"".join(texts), np.uint8), off)
        state, count = s.enter(np.full(5, fim.START))
        n = fim.tokens(state, count)
        for k, t in enumerate(texts):
            w = [x.encode() for x in TOKEN.findall(t.decode())]
            assert n[k] == len(w)
            assert (state[k] >= fim.GAP_FOUND) == any(x in t for x in (b"<P>", b"<S>", b"<M>"))
            if len(w) > 1:
                ranks = np.arange(1, len(w))
                assert s.select(np.full(len(ranks), k), ranks).tolist() == np.cumsum([len(x) for x in w])[:-1].tolist()


def test_functions_compose():
    """However a text is cut into pieces, the composition of their functions is the function of the whole."""
    r = random.Random(1)
    one = lambda d: fim.Scan(np.frombuffer(d, np.uint8), np.array([0, len(d)])).function()
    for _ in range(50):
        t = random_text(r, 400, True).encode()
        at = sorted(r.randrange(len(t) + 1) for _ in range(4))
        whole, got = one(t), (np.arange(fim.STATES, dtype=np.uint8), np.zeros(fim.STATES, np.int64))
        for a, b in zip([0, *at], [*at, len(t)]):
            got = fim.compose(got, one(t[a:b]))
        assert got[0].tolist() == whole[0].tolist() and got[1].tolist() == whole[1].tolist()


def test_transform(spark):
    r = random.Random(5)
    long = [random_text(r, n) for n in (60_000, 40_000, 150_000)] + ["x" * 200_000, " " * 70_000, "w " * 50_000, random_text(r, 50_000, True), "a" * 65_535 + " b c", "a" * 65_534 + "<S" + "> e f"]
    rows = [(k, random_text(r, r.randrange(60), r.random() < 0.2)) for k in range(300)] + [(1000 + 10 * k + j, t) for k, t in enumerate(long) for j in range(8)]
    rows += [(7, None), (8, ""), (None, "some words here and there"), (3, "twice the same"), (3, "twice the same"), (9, " \n")]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id bigint, text string, output string, N int")
    out = fim.transform(df)
    assert out.columns == ["doc_id", "text", "output", "N", "n_", "form", "prefix_chars", "middle_chars", "output_"]
    out = out.withColumn("back", fim.restored(out["output_"], out["form"])).collect()
    got = sorted(((x.doc_id, x.n_, x.form, x.prefix_chars, x.middle_chars, x.output_) for x in out), key=repr)
    assert got == sorted((brute(i, t) for i, t in rows), key=repr)
    assert all(x.back == (x.text or "") and x.output == "x" and x.N == 1 for x in out)
    assert {x.form for x in out if len(x.text or "") > 65_536} == {"plain", "psm", "spm"}
    assert fim.transform(df.limit(0)).collect() == []
