"""Hidden Markov language model: distributed Baum-Welch, exact scaled forward scores."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_mod, fresh, sampled, slices, table, tidied, written

#: States, words with an emission of their own, most words whose counts every worker holds, and rounds over the whole corpus.
STATES, SYMBOLS, HEAD, ROUNDS = 8, 16_384, 131_072, 2
#: The start is fitted on about so many documents (least hashes of doc_id and text) of at most so many bytes. Longer texts
#: are learned from in the rounds over the whole corpus, as all others are.
START_DOCS, START_BYTES, START_ROUNDS = 1_500, 32_768, 10
#: No word has it: the end of a text.
END = b"\n"
#: Cells of a padded group of texts, symbols of a block of counts, entries of a worker's counter, smoothing by the unigrams.
CELLS, BLOCK, COUNTER, PRIOR = 300_000, 4_096, 400_000, 200.0


def tokens(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased, without the end token."""
    return text.encode("utf-8").lower().split() if text else []


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n) over all tokens of all texts, with END once for each text; pre-aggregated by task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c: Counter = Counter()
        for b in batches:
            for s in b.column(0).to_pylist():
                c.update(tokens(s))
                if len(c) > COUNTER:
                    yield out(c)
                    c.clear()
            c[END] += b.num_rows
        if c:
            yield out(c)

    def out(c: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c.keys()), pa.binary()), pa.array(list(c.values()), pa.int64())], names=["word", "n"])

    return docs.select(text).mapInArrow(tidied(run), "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    """start (K), move (K, K), emit (symbols + 2, K): each column of emit is a distribution over the SYMBOLS most frequent
    words, END (last but one) and RARE (last). A rare word's share of RARE is (c + 1) / rare_total."""

    words: list[bytes]
    counts: np.ndarray
    symbols: int
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray
    total: int
    types: int
    rare_total: float

    def __post_init__(self):
        self.index = None

    def ids(self, toks: list[bytes]) -> np.ndarray:
        """Ranks of words in the head, -1 beyond it."""
        if self.index is None:
            self.index = {w: i for i, w in enumerate(self.words)}
        get = self.index.get
        return np.fromiter([get(t, -1) for t in toks], np.int64, len(toks))

    def sequence(self, ids: np.ndarray) -> np.ndarray:
        """Symbols of a text, END included."""
        out = np.full(len(ids) + 1, self.symbols, np.int64)
        out[:-1] = np.where((ids < 0) | (ids >= self.symbols), self.symbols + 1, ids)
        return out


#: Steps of a group whose alphas are held at once.
BLOCK = 8192
#: Steps whose emissions are looked up at once in scoring.
STEPS = 512


def groups(seqs: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, lengths, padded symbols by step) of texts of like length, longest first in each group."""
    size = np.array([len(s) for s in seqs])
    order = np.argsort(-size, kind="stable")
    at = 0
    while at < len(order):
        n = max(1, CELLS // int(size[order[at]]))
        rows = order[at : at + n]
        sym = np.zeros((int(size[rows[0]]), len(rows)), np.int64)
        for j, r in enumerate(rows.tolist()):
            sym[: size[r], j] = seqs[r]
        yield rows, size[rows], sym
        at += n


def forward(sym: np.ndarray, size: np.ndarray, start: np.ndarray, move: np.ndarray, emit: np.ndarray, before: np.ndarray | None = None):
    """Scaled forward recursion of a group, or of a block of its steps that the alphas `before` come before: (alpha by step, scales by
    step, emissions by step, texts alive by step)."""
    steps, n = sym.shape
    alive = n - np.searchsorted(size[::-1], np.arange(steps), "right")
    e = emit[sym]
    alpha, scale = np.zeros_like(e), np.ones((steps, n))
    a = before
    for t in range(steps):
        k = alive[t]
        x = alpha[t, :k]
        if a is None:
            np.multiply(start, e[0], out=x)
        else:
            np.matmul(a[:k], move, out=x)
            x *= e[t, :k]
        c = x.sum(1)
        x /= c[:, None]
        scale[t, :k] = c
        a = x
    return alpha, scale, e, alive


def log_likelihood(seqs: list[np.ndarray], start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> np.ndarray:
    """Natural log of each sequence's exact probability. Of a group the alphas of one step are held, the emissions of STEPS, and a
    scale for each symbol."""
    out = np.zeros(len(seqs))
    for rows, size, sym in groups(seqs):
        steps, n = sym.shape
        alive = (n - np.searchsorted(size[::-1], np.arange(steps), "right")).tolist()
        scale, a = np.ones((steps, n)), None
        for b in range(0, steps, STEPS):
            e = emit[sym[b : b + STEPS]]
            for t in range(b, min(b + STEPS, steps)):
                k = alive[t]
                a = start * e[0] if a is None else (a[:k] @ move) * e[t - b, :k]
                c = a.sum(1)
                a /= c[:, None]
                scale[t, :k] = c
        out[rows] = np.log(scale).sum(0)
    return out


def expected(seqs: list[np.ndarray], start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Baum-Welch counts: of first states, of moves, of emissions (symbols, K). Of a group of more than BLOCK steps the alphas
    between blocks are kept, and each block's are made again on the way back: memory grows with the symbols, not with them
    times the states."""
    k, symbols = len(start), len(emit)
    c_start, c_move, c_emit = np.zeros(k), np.zeros((k, k)), np.zeros((symbols, k))
    for _, size, sym in groups(seqs):
        steps, n = sym.shape
        firsts, kept = range(0, steps, BLOCK), [None]
        for b in firsts[1:]:
            alpha, _, _, alive = forward(sym[b - BLOCK : b], size - b + BLOCK, start, move, emit, kept[-1])
            kept.append(alpha[-1, : alive[-1]].copy())
        back, after = np.ascontiguousarray(move.T), None
        for b, before in zip(reversed(firsts), reversed(kept)):
            part = sym[b : b + BLOCK]
            alpha, scale, e, alive = forward(part, size - b, start, move, emit, before)
            e /= scale[:, :, None]
            beta, follow = np.ones_like(alpha), np.zeros_like(alpha)
            for t in range(len(part) - 1, -1, -1):
                if t + 1 < len(part):
                    m, ahead, weight = alive[t + 1], beta[t + 1], e[t + 1]
                elif after is not None:
                    m, ahead, weight = after
                else:
                    continue
                np.multiply(weight[:m], ahead[:m], out=follow[t, :m])
                np.matmul(follow[t, :m], back, out=beta[t, :m])
            c_move += alpha.reshape(-1, k).T @ follow.reshape(-1, k)
            gamma = np.multiply(alpha, beta, out=alpha)
            after = alive[0], beta[0].copy(), e[0].copy()
            flat, weights = part.reshape(-1), gamma.reshape(-1, k)
            for s in range(k):
                c_emit[:, s] += np.bincount(flat, weights[:, s], symbols)
        c_start += gamma[0].sum(0)
    return c_start, c_move * move, c_emit


def maximise(c_start: np.ndarray, c_move: np.ndarray, c_emit: np.ndarray, unigram: np.ndarray):
    start = (c_start + 1) / (c_start + 1).sum()
    move = c_move + 1
    emit = c_emit + PRIOR * unigram[:, None]
    return start, move / move.sum(1, keepdims=True), emit / emit.sum(0)


def first_fit(seqs: list[np.ndarray], unigram: np.ndarray, states: int, rounds: int):
    """A start for Baum-Welch: texts clustered as bags of words, then sticky states, then rounds on the sample itself."""
    rng = np.random.default_rng(5)
    symbols = len(unigram)
    emit = np.repeat(unigram[:, None], states, 1) * rng.uniform(0.9, 1.1, (symbols, states))
    emit /= emit.sum(0)
    share = np.full(states, 1 / states)
    flat = np.concatenate(seqs) if seqs else np.zeros(0, np.int64)
    cut = np.cumsum([0, *map(len, seqs)])[:-1]
    for _ in range(15 if seqs else 0):
        score = np.add.reduceat(np.log(emit)[flat], cut, axis=0) + np.log(share)
        resp = np.exp(score - score.max(1, keepdims=True))
        resp /= resp.sum(1, keepdims=True)
        per = np.repeat(resp, [len(s) for s in seqs], axis=0)
        counts = np.stack([np.bincount(flat, per[:, s], symbols) for s in range(states)], 1)
        emit = counts + PRIOR * unigram[:, None]
        emit /= emit.sum(0)
        share = (resp.sum(0) + 1) / (resp.sum(0) + 1).sum()
    move = np.full((states, states), 0.1 / max(states - 1, 1))
    np.fill_diagonal(move, 0.9 if states > 1 else 1.0)
    start = share
    for _ in range(rounds if seqs else 0):
        start, move, emit = maximise(*expected(seqs, start, move, emit), unigram)
    return start, move, emit


def frequent(counts: DataFrame, most: int) -> DataFrame:
    """The rows (word, n) of the words more frequent than a bound, the least that `most` words at the utmost pass: a filter by a
    histogram of n, exact up to 64 and in steps of an eighth of a doubling above, so that no task sorts all words."""
    step = "if(n <= 64, n, cast(floor(log2(n) * 8) as bigint) + 16)"  # 65 is in step 64, after the single ones
    hist = sorted(((r.s, r.least, r.words) for r in counts.groupBy(F.expr(step).alias("s")).agg(F.min("n").alias("least"), F.count("*").alias("words")).collect()), key=lambda x: -x[1])
    left, bound = most, None
    for _, least, words in hist:
        if words > left:
            break
        left, bound = left - words, least
    return counts.where(F.col("n") >= F.lit(bound)) if bound is not None else counts.limit(0)


def fit(train: DataFrame, counts: DataFrame, states: int = STATES, symbols: int = SYMBOLS, head: int = HEAD, rounds: int = ROUNDS) -> Model:
    """Trains on (doc_id, text) whose word counts are `counts` (a written table).

    The driver holds `head` words and states * symbols numbers, whatever the corpus. Every round goes over all texts;
    a task sends its summed counts in blocks, which are added up by block."""
    sums = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = frequent(counts.where(F.col("word") != F.lit(bytearray(END))), head).toArrow()
    words, n = top["word"].to_pylist(), top["n"].to_numpy()
    order = sorted(range(len(words)), key=lambda i: (-n[i], words[i]))
    words, n = [words[i] for i in order], n[order]
    symbols = min(symbols, len(words))
    ends = counts.where(F.col("word") == F.lit(bytearray(END))).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    own = int(n[:symbols].sum())
    rare = sums[0] - own - ends
    rare_types = sums[1] - symbols - (1 if ends else 0)
    unigram = np.concatenate([n[:symbols].astype(float), [max(ends, 1), max(rare, 1)]])
    unigram /= unigram.sum()
    model = Model(words, n, symbols, np.ones(states) / states, np.ones((states, states)) / states, np.repeat(unigram[:, None], states, 1), int(sums[0]), int(sums[1]), float(rare + rare_types + 1))
    some = sampled(train.where(F.octet_length("text") <= START_BYTES), START_DOCS, "doc_id", "text")
    seqs = [model.sequence(model.ids(tokens(r.text))) for r in some.select("text").toLocalIterator()]
    model.start, model.move, model.emit = first_fit(seqs, unigram, states, START_ROUNDS)
    for _ in range(rounds):
        model.start, model.move, model.emit = maximise(*_round(train, model), unigram)
    return model


def _round(train: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    # words beyond the symbols are all RARE here: the small index stays in the processor's cache
    held = train.sparkSession.sparkContext.broadcast(replace(model, words=model.words[: model.symbols], counts=model.counts[: model.symbols]))
    k, rows = len(model.start), model.symbols + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        c_start, c_move, c_emit = np.zeros(k), np.zeros((k, k)), np.zeros((rows, k))
        for whole in batches:
            for b in slices(whole, most=8 << 20):
                s, v, e = expected([m.sequence(m.ids(tokens(x))) for x in b.column("text").to_pylist()], m.start, m.move, m.emit)
                c_start += s
                c_move += v
                c_emit += e
        if c_start.any():
            parts = [c_start, c_move, *(c_emit[i : i + BLOCK] for i in range(0, rows, BLOCK))]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], names=["part", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for part, x in zip(b.column("part").to_pylist(), b.column("sums").to_pylist()):
                x = np.frombuffer(x)
                sums[part] = sums[part] + x if part in sums else x
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["part", "sums"])

    schema = "part int, sums binary"
    spread = int(train.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sent = train.select("text").mapInArrow(tidied(run), schema)
    got = {r.part: np.frombuffer(bytes(r.sums)) for r in sent.repartition(spread, "part").mapInArrow(tidied(add), schema).toLocalIterator()}
    held.unpersist()
    if not got:
        return np.zeros(k), np.zeros((k, k)), np.zeros((rows, k))
    return got[0], got[1].reshape(k, k), np.concatenate([got[p] for p in sorted(got) if p > 1]).reshape(rows, k)


def score(docs: DataFrame, model: Model, counts: DataFrame, text: str = "text") -> DataFrame:
    """docs' other columns plus n_tokens, n_known, train_tokens, base_score and score (log10 probabilities).

    Null text counts as empty: the end token alone. Words of the head are counted in place; other words' counts are joined, a row
    for each document and distinct word. Repeated rows are scored alike. Result names that docs has already get
    underscores at their end."""
    model.index = None
    held = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c != text]
    names = fresh(docs.select(*kept), "n_tokens", "n_known", "train_tokens", "base_score", "score", "row_", "tail_", "n_rare_", "head_", "rare_", "path_", "r_", "seen_", "logs_")
    tokens_, known, train_n, base, total, row, tail, n_rare, head_sum, rare_sum, path, r_, seen_, logs_ = names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        logs = np.log10(m.counts + 1.0)
        for whole in batches:
            for b in slices(whole, text, 8 << 20):
                seqs, cols, tails = [], [], []
                for s in b.column(text).to_pylist():
                    toks = tokens(s)
                    ids = m.ids(toks)
                    seqs.append(m.sequence(ids))
                    inside = ids[ids >= 0]
                    low = inside[inside >= m.symbols]
                    far = Counter(toks[i] for i in np.flatnonzero(ids < 0).tolist())
                    tails.append([{"word": w, "n": n} for w, n in far.items()])
                    cols.append((len(toks) + 1, len(inside), len(low) + len(toks) - len(inside), logs[inside].sum(), logs[low].sum()))
                path_logs = log_likelihood(seqs, m.start, m.move, m.emit) / np.log(10)
                nt, nk, nr, hs, rs = zip(*cols)
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c) for c in kept), pa.array(nt, pa.int64()), pa.array(nk, pa.int64()), pa.array(nr, pa.int64()), pa.array(hs, pa.float64()), pa.array(rs, pa.float64()), pa.array(path_logs), pa.array(tails, pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())])))],
                    names=[*kept, tokens_, known, n_rare, head_sum, rare_sum, path, tail],
                )

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != text), f"`{tokens_}` bigint, `{known}` bigint, `{n_rare}` bigint, `{head_sum}` double, `{rare_sum}` double, `{path}` double, `{tail}` array<struct<word: binary, n: bigint>>"])
    part = written(docs.mapInArrow(tidied(run), schema).withColumn(row, F.monotonically_increasing_id()))
    far = part.select(F.col(row).alias(r_), F.inline(tail)).withColumnRenamed("n", "times")
    far = far.join(counts, "word").groupBy(r_).agg(F.sum("times").alias(seen_), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias(logs_))
    ends = counts.where(F.col("word") == F.lit(bytearray(END))).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    out = part.drop(tail).join(far, part[row] == far[r_], "left")
    seen, logs = F.coalesce(seen_, F.lit(0)), F.coalesce(logs_, F.lit(0.0))
    return out.select(
        *[F.col(f"`{c}`") for c in kept],
        F.col(tokens_),
        (F.col(known) + seen + F.lit(1 if ends else 0)).alias(known),
        F.lit(model.total).cast("long").alias(train_n),
        (F.col(head_sum) + logs + F.lit(float(np.log10(ends + 1.0))) - F.col(tokens_) * F.lit(float(np.log10(model.total + model.types + 1.0)))).alias(base),
        (F.col(path) + F.col(rare_sum) + logs - F.col(n_rare) * F.lit(float(np.log10(model.rare_total)))).alias(total),
    )


def op1_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    train = docs.where(crc_mod("doc_id", 7) != 2)
    counts = written(word_counts(train))
    got = score(docs, fit(train, counts), counts)
    return got.withColumn("held_out", crc_mod("doc_id", 7) == 2).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
