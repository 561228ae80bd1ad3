"""Toxicity: segments against their definition, the fitted law, held-out accuracy, and edges."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from folio.llm import toxicity


def by_definition(x, at=0):
    """The best segment, and the same to its left and to its right."""
    best, where = 0.0, None
    for i in range(len(x)):
        for j in range(i + 1, len(x) + 1):
            if x[i:j].sum() > best:
                best, where = x[i:j].sum(), (i, j)
    if where is None:
        return []
    i, j = where
    return by_definition(x[:i], at) + [(at + i, at + j, best)] + by_definition(x[j:], at + j)


@pytest.mark.parametrize("bias", [-0.6, -0.2, 0.0, 0.3])
def test_segments(bias):
    r = np.random.default_rng(int(10 * bias) + 7)
    for n in (0, 1, 2, 9, 30, 60):
        for _ in range(6):
            x = r.normal(bias, 1, n)
            want = by_definition(x)
            got = toxicity.segments(x)
            assert [g[:2] for g in got] == [w[:2] for w in want]
            assert np.allclose([g[2] for g in got], [w[2] for w in want])


def test_segments_are_linear():
    x = np.tile([2.0, -1.0, 1.0, -1.999], 50_000)
    assert len(toxicity.segments(x)) >= 1
    down = np.ravel(np.column_stack([np.linspace(1, 0.5, 200_000), np.full(200_000, -2.0)]))
    assert len(toxicity.segments(down)) == 200_000


def test_evidence():
    e = lambda s, m=100: toxicity.evidence(m, s, 1.0, 0.1)
    assert e([]) == 0 == e([1.0])  # ten times as good is expected by chance
    assert e([9.0]) == pytest.approx(9 - math.log(10) - math.log(2))
    assert e([9.0, 9.0]) > e([9.0]) > e([9.0], 1000) and e([9.0, 1.0]) == e([9.0])


def test_law(spark):
    """The parameters of scores drawn from the law are found again."""
    r = np.random.default_rng(2)
    m = r.integers(50, 3000, 20_000)
    s = np.maximum((np.log(0.02 * m) + r.gumbel(size=len(m))) / 0.8, 0)
    lam, k = toxicity._law(spark.createDataFrame(list(zip(m.tolist(), s.tolist())), "m long, s double"))
    assert abs(lam / 0.8 - 1) < 0.07 and abs(k / 0.02 - 1) < 0.15


def made(n, seed=1):
    """(doc_id, text, toxic): a few insults, apart, make a text toxic."""
    r = random.Random(seed)
    words, bad = [f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(3000)], ["fool", "Dummkopf", "ÂNE"]
    rows = []
    for k in range(n):
        t = [r.choice(words) for _ in range(r.choice([5, 40, 300]))]
        toxic = k % 8 == 0
        for _ in range(r.randint(2, 4) if toxic else 0):
            t.insert(r.randrange(len(t) + 1), r.choice([str.upper, str.lower])(r.choice(bad)) + r.choice(["", "!", "."]))
        rows.append((k, " ".join(t), int(toxic)))
    return rows


def test_fit_and_score(spark):
    rows = made(1600)
    train, held = rows[:1200], rows[1200:]
    docs = spark.createDataFrame([r[:2] for r in train], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in train], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    out = toxicity.score(spark.createDataFrame([(i, t, "own") for i, t, _ in held], "doc_id long, text string, score string"), model)
    assert out.columns == ["doc_id", "text", "score", "score_", "passages"]
    got = {r.doc_id: r for r in out.collect()}
    right = sum((got[i].score_ >= toxicity.TOXIC) == bool(y) for i, _, y in held)
    assert right >= 0.98 * len(held) and all(r.score == "own" for r in got.values())
    found = [(i, p) for i, r in got.items() for p in r.passages]
    named = sum(any(w in toxicity.lowered(got[i].text[p.start : p.end]) for w in ("fool", "dummkopf", "âne")) for i, p in found)
    assert named > 40 and named >= 0.8 * len(found)

    # copies of a text, and labels of no document, change nothing; neither do repeated, null or contradictory rows' orders
    more = docs.unionByName(spark.createDataFrame([train[0][:2]] * 3000 + [(None, "null id"), (5000, None), (5001, "")], docs.schema))
    extra = labels.unionByName(spark.createDataFrame([(train[0][0], train[0][2])] * 50 + [(None, 1), (9999, 1), (train[3][0], None)], labels.schema))
    again = toxicity.fit(more, extra)
    assert again.scores.keys() == model.scores.keys() and all(abs(again.scores[w] - s) < 1e-9 for w, s in model.scores.items())

    edges = spark.createDataFrame([(1, None), (2, ""), (3, "123 !"), (None, "FOOL you fool, dummkopf! âne"), (4, "fool " * 200_000), (5, "İİ fool dummkopf"), (5, "İİ fool dummkopf")], "doc_id long, text string")
    e = toxicity.score(edges, model).orderBy("doc_id", "text").collect()
    assert [bool(r.passages) for r in e] == [True, False, False, False, True, True, True] and e[5] == e[6]
    assert e[1].score == e[2].score == e[3].score < 0.5 < 0.9 < min(e[0].score, e[4].score)
    assert toxicity.score(edges.limit(0), model).collect() == []


def test_without_classes(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c d")], "doc_id long, text string")
    for y, want in ((0, 0.0), (1, 1.0), (None, 0.0)):
        labels = spark.createDataFrame([(1, y), (2, y)], "doc_id long, toxic int")
        assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()} == {want}
    assert toxicity.fit(docs.limit(0), labels).probability(3.0) == 0.0


def test_query(spark):
    """Held-out documents of the given tables: most toxic ones are caught, clean ones are left alone."""
    sf = "/root/testdata/sf0.01"
    got = toxicity.op13_toxicity(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    held = got.join(labels, "doc_id").where("held_out").groupBy("toxic", "predicted").count().collect()
    c = {(r.toxic, r.predicted): r["count"] for r in held}
    assert c.get((1, 1), 0) >= 0.7 * (c.get((1, 1), 0) + c.get((1, 0), 0)) and c.get((0, 1), 0) <= 0.02 * c[(0, 0)]
    assert got.count() == n and got.where((F.col("score") < 0) | (F.col("score") > 1) | (F.col("predicted") != (F.col("score") >= 0.7).cast("int"))).count() == 0
