"""Operator 13: toxicity by maximum-scoring segments.

Each word has a log-odds of toxic against clean labelled texts (a text counts its words once) under an informative Dirichlet prior,
drawn in by DEVIATIONS standard deviations; words without evidence have none. A text is a walk of those scores less a drift. All its maximal-scoring segments are
found in one linear scan (Ruzzo and Tompa). The best score of a clean text of m words follows an extreme-value law with the
parameters lambda and K of Karlin and Altschul, fitted to clean texts; with it a segment has an expected number of equals in clean
text, and a text's segments have a sum statistic. A logistic curve over that statistic is the probability."""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import crc_mod, fresh, removed, sampled, slices, table, tidied, written

#: Most labelled texts (about) that the classifier is fitted on, chosen by a hash of the text, and most words it keeps.
SAMPLE = 40_000
LEXICON = 100_000
#: Weight of the prior as a share of the counts; standard deviations that a log-odds is drawn in by; cost of a word.
PRIOR, DEVIATIONS, DRIFT = 0.05, 1.5, 0.3
#: A passage is reported if so many as good are expected in a clean text of this length.
EXPECTED = 0.05
TOXIC = 0.7
_WORD = re.compile(r"[^\W\d_]+")
_LAMBDAS = [round(0.05 * 1.12**i, 6) for i in range(48)]
_BIN = 0.25


def lowered(text: str) -> str:
    """In lower case, character by character where the length would change."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def segments(x: np.ndarray) -> list[tuple[int, int, float]]:
    """(start, end, score) of all maximal-scoring segments of x, in order, in linear time: positive runs are joined leftwards with
    the nearest one that begins lower, as long as what is between doesn't make it end lower."""
    up = x > 0
    if not up.any():
        return []
    edge = np.flatnonzero(np.diff(np.concatenate([[False], up, [False]]).astype(np.int8)))
    total = np.concatenate([[0.0], np.cumsum(x)])
    kept: list[tuple[int, int, float, float, int]] = []  # start, end, sum before, sum at the end, nearest that begins lower
    for s, e in zip(edge[0::2].tolist(), edge[1::2].tolist()):
        low, high = float(total[s]), float(total[e])
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= low:
                j = kept[j][4]
            if j < 0 or kept[j][3] >= high:
                kept.append((s, e, low, high, j))
                break
            s, low = kept[j][0], kept[j][2]
            del kept[j:]
    return [(s, e, high - low) for s, e, low, high, _ in kept]


def evidence(m: int, scores: list[float], lam: float, k: float) -> float:
    """How surprising a text's segments are in a clean text of m words: the largest -ln of the probability of its r best ones
    together, over all r, with a factor of 2 for each more that is tried. 0 at least."""
    best, total, gain = 0.0, 0.0, 0.0
    for r, s in enumerate(sorted(scores, reverse=True), 1):
        x = lam * s - math.log(k * m)
        if x <= 0:
            break
        total += x
        gain += math.log(r) + (math.log(r - 1) if r > 1 else 0.0)
        best = max(best, total - (r - 1) * math.log(max(total, 1.0)) + gain - r * math.log(2))
    return best


@dataclass
class Model:
    """scores: of words; lam, k: of the extreme-value law; at, slope: of the logistic curve."""

    scores: dict[str, float] = field(default_factory=dict)
    lam: float = 1.0
    k: float = 1.0
    at: float = -math.inf
    slope: float = 0.0

    def probability(self, x: float) -> float:
        z = self.at + self.slope * x
        return 1 / (1 + math.exp(-z)) if z > -700 else 0.0


def scored(words: list[str], of: dict[str, float]) -> list[tuple[int, int, float]]:
    return segments(np.array(list(map(of.get, words, repeat(0.0)))) - DRIFT) if words else []


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, weights by class and half of the texts that have it) of (text, y, half, w), added up within a step."""
    for whole in batches:
        for b in slices(whole):
            got = [defaultdict(float) for _ in range(4)]
            for t, y, half, w in zip(*(b.column(c).to_pylist() for c in ("text", "y", "half", "w"))):
                into = got[2 * y + half]
                for word in set(_WORD.findall(lowered(t))):
                    into[word] += w
            words = list(set().union(*got))
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), *(pa.array([g.get(x, 0.0) for x in words], pa.float64()) for g in got)], names=["word", "c0", "c1", "t0", "t1"])


def _log_odds(t: Column, c: Column, toxic: float, clean: float) -> Column:
    """Drawn in towards 0. t, c: weights of a word; toxic, clean: of all words."""
    if not toxic or not clean:
        return F.lit(0.0)
    a, all_ = PRIOR * (t + c), (1 + PRIOR) * (toxic + clean)
    rest = lambda own, n: F.lit(n + PRIOR * (toxic + clean)) - own - a
    d = F.log((t + a) / rest(t, toxic)) - F.log((c + a) / rest(c, clean))
    return F.when((t + c > 0) & (t + c < all_), F.signum(d) * F.greatest(F.abs(d) - DEVIATIONS * F.sqrt(1 / (t + a) + 1 / (c + a)), F.lit(0.0))).otherwise(0.0)


def _lexicon(counts: DataFrame) -> dict[str, tuple[float, float, float]]:
    """Words with a log-odds: by all texts, by the first half, by the second. If they were more than LEXICON, those nearest to 0 go,
    by a threshold that a histogram gives."""
    n = counts.agg(*[F.sum(c).alias(c) for c in ("c0", "c1", "t0", "t1")]).first()
    c0, c1, t0, t1 = (n[c] or 0.0 for c in ("c0", "c1", "t0", "t1"))
    s = counts.select("word", _log_odds(F.col("t0") + F.col("t1"), F.col("c0") + F.col("c1"), t0 + t1, c0 + c1).alias("s"), _log_odds(F.col("t0"), F.col("c0"), t0, c0).alias("s0"), _log_odds(F.col("t1"), F.col("c1"), t1, c1).alias("s1"))
    s = s.withColumn("most", F.greatest(*[F.abs(x) for x in ("s", "s0", "s1")])).where("most > 0")
    bins = s.groupBy(F.floor(F.col("most") * 200).alias("b")).count().orderBy(F.desc("b")).collect()
    least, total = 0, 0
    for r in bins:
        total += r["count"]
        if total > LEXICON:
            least = (r.b + 1) / 200
            break
    return {r.word: (r.s, r.s0, r.s1) for r in s.where(F.col("most") >= least).toLocalIterator()}


def _law(best: DataFrame) -> tuple[float, float]:
    """lambda and K of greatest likelihood, of (m, s): the words and best segment (0: none) of clean texts. A text has no better
    one than s with probability exp(-K m exp(-lambda s))."""
    sums = [F.sum(F.col("m") * F.exp(-lam * F.col("s"))).alias(f"l{i}") for i, lam in enumerate(_LAMBDAS)]
    r = best.agg(F.count_if(F.col("s") > 0).alias("n"), F.sum("s").alias("s"), F.sum("m").alias("m"), *sums).first()
    if not r["m"]:
        return 1.0, 1.0
    if not r["n"]:
        return 1.0, 0.5 / r["m"]
    lam = max(range(len(_LAMBDAS)), key=lambda i: r["n"] * math.log(_LAMBDAS[i] / r[f"l{i}"]) - _LAMBDAS[i] * r["s"])
    return _LAMBDAS[lam], r["n"] / r[f"l{lam}"]


def _curve(x: np.ndarray, n: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Logistic curve through counts: n texts of evidence x, of them `toxic`; targets are smoothed as Platt does."""
    all_toxic, all_clean = toxic.sum(), n.sum() - toxic.sum()
    y = (toxic * (all_toxic + 1) / (all_toxic + 2) + (n - toxic) / (all_clean + 2)) / n
    at, slope = math.log((all_toxic + 1) / (all_clean + 1)), 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(at + slope * x, -30, 30)))
        g = np.array([(n * (y - p)).sum(), (n * (y - p) * x).sum() - 1e-3 * slope])
        w = n * p * (1 - p)
        h = np.array([[w.sum() + 1e-6, (w * x).sum()], [(w * x).sum(), (w * x * x).sum() + 1e-3]])
        move = np.clip(np.linalg.solve(h, g), -2, 2)
        at, slope = at + move[0], slope + move[1]
        if abs(move).max() < 1e-9:
            break
    return float(at), float(max(slope, 0.0))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """From docs (doc_id, text) and labels (doc_id, toxic 0 or 1).

    Only labels of docs at hand count; a doc_id labelled more than once is toxic if one says so; null labels, ids and texts are left
    out. Equal texts are one, toxic if half of them are: copies have no more weight than their text. About `sample` of the texts,
    chosen by hash, fit the model; a text's own evidence is measured with words learned from the half that it isn't in. Without
    both classes the score is 0, or 1 if all are toxic. The driver gets the chosen words and a histogram."""
    spark = docs.sparkSession
    d = docs.where("doc_id is not null and text is not null").select("doc_id", "text", F.xxhash64("text").alias("h"))
    y = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("y"))
    each = d.groupBy("doc_id", "h").agg(F.count("*").alias("rows")).join(y, "doc_id")
    texts = written(each.groupBy("h").agg(F.min(F.struct("doc_id", "rows")).alias("one"), (F.avg("y") >= 0.5).cast("int").alias("y")))
    chosen = written(sampled(texts, sample, "h").select(F.col("one.doc_id").alias("doc_id"), "h", "y", F.pmod(F.xxhash64("h", F.lit("half")), F.lit(2)).cast("int").alias("half"), (1 / F.col("one.rows")).alias("w")))
    removed(texts)
    # broadcast: SAMPLE rows of five numbers at most, about
    train = d.join(F.broadcast(chosen), ["doc_id", "h"]).select("text", "y", "half", "w")
    sizes = chosen.groupBy("y").count().collect()
    n = {r.y: r["count"] for r in sizes}
    if len(n) < 2:
        return Model(at=math.inf if n.get(1) else -math.inf)
    counts = written(train.mapInArrow(tidied(_counted), "word string, c0 double, c1 double, t0 double, t1 double").groupBy("word").agg(*[F.sum(c).alias(c) for c in ("c0", "c1", "t0", "t1")]))
    words = _lexicon(counts)
    removed(counts)
    halves = spark.sparkContext.broadcast([{w: s[i] for w, s in words.items() if s[i]} for i in (2, 1)])

    def crossed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole):
                rows = []
                for t, y, half, w in zip(*(b.column(c).to_pylist() for c in ("text", "y", "half", "w"))):
                    ws = _WORD.findall(lowered(t))
                    rows.append((y, len(ws), [s for _, _, s in scored(ws, halves.value[half])], w))
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.float64()))], names=["y", "m", "scores", "w"])

    tried = written(train.mapInArrow(tidied(crossed), "y int, m bigint, scores array<double>, w double"))
    lam, k = _law(tried.where("y = 0").select("m", F.coalesce(F.array_max("scores"), F.lit(0.0)).alias("s")))

    @F.arrow_udf(T.DoubleType())
    def surprise(m: pa.Array, scores: pa.Array) -> pa.Array:
        return pa.array([evidence(a, s, lam, k) for a, s in zip(m.to_pylist(), scores.to_pylist())], pa.float64())

    x = F.least(F.floor(surprise("m", "scores") / _BIN), F.lit(1000)).alias("x")
    bins = tried.select(x, "y", "w").groupBy("x").agg(F.sum("w").alias("n"), F.sum(F.col("y") * F.col("w")).alias("t")).collect()
    at, slope = _curve(np.array([r.x * _BIN for r in bins]), np.array([r.n for r in bins]), np.array([r.t for r in bins]))
    removed(tried)
    return Model({w: s[0] for w, s in words.items() if s[0]}, lam, k, at, slope)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs and score (0 to 1) and passages: every significant one, (start, end) in characters, its score, and how many as good are
    expected in a clean text of this length. Null and empty texts, and those without a letter, have no passages and the score of
    no evidence; other columns stay as they are, names that docs has get underscores; repeated rows give equal rows."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    name, out, passages = fresh(docs, "toxicity_struct", "score", "passages")
    passage = T.StructType().add("start", "integer").add("end", "integer").add("score", "double").add("expected", "double")

    @F.arrow_udf(T.StructType().add("score", "double").add("passages", T.ArrayType(passage)))
    def judged(texts: pa.Array) -> pa.Array:
        m, scores, found = shared.value, [], []
        for t in texts:
            t = lowered(t.as_py() or "")
            ws = _WORD.findall(t)
            got = scored(ws, m.scores)
            scores.append(m.probability(evidence(len(ws), [s for _, _, s in got], m.lam, m.k)))
            good = [(a, e, s, x) for a, e, s in got if (x := m.k * len(ws) * math.exp(-m.lam * s)) <= EXPECTED]
            at = [w.span() for w in _WORD.finditer(t)] if good else []
            found.append([{"start": at[a][0], "end": at[e - 1][1], "score": s, "expected": x} for a, e, s, x in good])
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("expected", pa.float64())]))
        return pa.StructArray.from_arrays([pa.array(scores, pa.float64()), pa.array(found, kind)], names=["score", "passages"])

    return docs.withColumn(name, judged(F.col(text))).select(*docs.columns, F.col(f"{name}.score").alias(out), F.col(f"{name}.passages").alias(passages))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    held = crc_mod("doc_id", 3) == 1
    model = fit(docs.where(~held), labels)
    got = score(docs, model).withColumn("held_out", held)
    return got.select("doc_id", "held_out", "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"), F.size("passages").alias("n_passages"))
