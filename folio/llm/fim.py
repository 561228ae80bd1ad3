"""Operator 11: fill-in-the-middle transformation by a parallel automaton scan.

A finite automaton over bytes counts tokens and looks for sentinels. A chunk of a text doesn't know the state it is entered in, so
it gives a function: for each state it may be entered in, the state it is left in and the tokens that end in it. Functions compose
associatively; composition from the text's start gives each chunk its entry state and the tokens before it, and the byte where the
k-th token ends is found by going down the tree of compositions of one chunk.

A text of up to PIECE bytes is scanned where it is read. Longer ones are dealt out in pieces of that size, which are scanned by as
many tasks; what returns to the text is a few numbers a piece. Both go through the same functions, at every size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import _offsets, fresh, ramp, slices, table, tidied

#: The marks around prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Bytes of the smallest chunk (4 times a power of 2), and of a piece of a long text.
CHUNK = 256
PIECE = 1 << 16

_SPACE, _OPEN, _LETTER, _CLOSE, _OTHER, _PAD = range(6)
START, GAP, WORD, OPENED, LETTERED, GAP_FOUND, WORD_FOUND = range(7)
STATES = 7


def _automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class of each byte, next state and number of tokens that end (0 or 1), both by (state, class)."""
    classes = np.full(256, _OTHER, np.uint8)
    classes[[0x20, *range(0x09, 0x0E)]] = _SPACE
    classes[ord("<")], classes[ord(">")] = _OPEN, _CLOSE
    classes[[ord(s[1]) for s in (PREFIX, SUFFIX, MIDDLE)]] = _LETTER
    step = np.full((STATES, 6), WORD, np.uint8)
    step[:, _SPACE], step[:, _OPEN] = GAP, OPENED
    step[OPENED, _LETTER], step[LETTERED, _CLOSE] = LETTERED, WORD_FOUND
    step[[GAP_FOUND, WORD_FOUND]], step[[GAP_FOUND, WORD_FOUND], _SPACE] = WORD_FOUND, GAP_FOUND
    step[:, _PAD] = np.arange(STATES)
    ends = np.zeros((STATES, 6), np.uint8)
    ends[[WORD, OPENED, LETTERED, WORD_FOUND], _SPACE] = 1
    return classes, step, ends


CLASS, STEP, ENDS = _automaton()


def _four() -> tuple[np.ndarray, np.ndarray]:
    """The functions of all runs of four classes."""
    codes = np.arange(6**4)
    state, count = np.broadcast_to(np.arange(STATES, dtype=np.uint8), (6**4, STATES)), np.zeros((6**4, STATES), np.uint8)
    for place in (216, 36, 6, 1):
        c = (codes // place % 6)[:, None]
        count = count + ENDS[state, c]
        state = STEP[state, c]
    return state, count


FOUR, FOUR_ENDS = _four()


def compose(f: tuple[np.ndarray, np.ndarray], g: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """First f, then g; arrays of (..., STATES)."""
    at = f[0].astype(np.intp)
    return np.take_along_axis(g[0], at, -1), f[1] + np.take_along_axis(g[1], at, -1)


def levels(chunks: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Functions of rows of classes (n, CHUNK): of every 4, 8, ... bytes up to whole rows."""
    c = chunks.astype(np.int16)
    codes = ((c[:, 0::4] * 6 + c[:, 1::4]) * 6 + c[:, 2::4]) * 6 + c[:, 3::4]
    out = [(FOUR[codes], FOUR_ENDS[codes].astype(np.uint16))]
    while out[-1][0].shape[1] > 1:
        e, n = out[-1]
        out.append(compose((e[:, 0::2], n[:, 0::2]), (e[:, 1::2], n[:, 1::2])))
    return out


class Scan:
    """A scan of some byte runs: chunks' functions, and after enter() their entry states and the tokens that end before them."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        size = np.diff(off)
        self.off, self.per = off, -(-size // CHUNK)
        self.first = np.concatenate([[0], np.cumsum(self.per)])
        n = int(self.first[-1])
        self.chunks = np.full((n, CHUNK), _PAD, np.uint8)
        at = np.repeat(self.first[:-1] * CHUNK, size) + ramp(size)  # rows begin chunks
        self.chunks.reshape(-1)[at] = CLASS[data]
        self.levels = levels(self.chunks)
        self.whole = tuple(x[:, 0] for x in self.levels[-1])

    def function(self) -> tuple[np.ndarray, np.ndarray]:
        """The function of all chunks of a lone run, by a tree of compositions."""
        e, n = self.whole[0], self.whole[1].astype(np.int64)
        if not len(e):
            return np.arange(STATES, dtype=np.uint8), np.zeros(STATES, np.int64)
        while len(e) > 1:
            if len(e) % 2:
                e, n = np.vstack([e, np.arange(STATES, dtype=np.uint8)]), np.vstack([n, np.zeros(STATES, np.int64)])
            e, n = compose((e[0::2], n[0::2]), (e[1::2], n[1::2]))
        return e[0], n[0]

    def enter(self, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The state at the end of each run that is entered in `state`, and the tokens that end in it."""
        rows = np.arange(len(self.per))
        state, count = state.astype(np.uint8), np.zeros(len(rows), np.int64)
        self.entry, self.before = np.zeros(len(self.chunks), np.uint8), np.zeros(len(self.chunks), np.int64)
        for k in range(int(self.per.max(initial=0))):
            rows = rows[self.per[rows] > k]
            at = self.first[rows] + k
            self.entry[at], self.before[at] = state[rows], count[rows]
            count[rows] += self.whole[1][at, state[rows]]
            state[rows] = self.whole[0][at, state[rows]]
        return state, count

    def select(self, row: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Where, in its run, the token of that rank (from 1) ends."""
        # ranks ascend along a run's chunks: one sorted search over all of them
        base = np.zeros(len(self.per), np.int64)
        total = np.bincount(np.repeat(np.arange(len(self.per)), self.per), self.whole[1][np.arange(len(self.chunks)), self.entry], len(self.per)).astype(np.int64)
        base[1:] = np.cumsum(total)[:-1]
        t = np.searchsorted(self.before + np.repeat(base, self.per), base[row] + rank, "left") - 1
        state, rank = self.entry[t], rank - self.before[t]
        node = np.zeros(len(t), np.int64)
        for e, n in reversed(self.levels[:-1]):
            node *= 2
            left = n[t, node, state]
            right = rank > left
            rank = np.where(right, rank - left, rank)
            state = np.where(right, e[t, node, state], state)
            node += right
        place, done = np.zeros(len(t), np.int64), np.zeros(len(t), bool)
        for k in range(4):
            c = self.chunks[t, node * 4 + k]
            rank = rank - ENDS[state, c]
            hit = ~done & (rank == 0)
            place[hit], done = node[hit] * 4 + k, done | hit
            state = STEP[state, c]
        return (t - self.first[row]) * CHUNK + place


def tokens(state: np.ndarray, count: np.ndarray) -> np.ndarray:
    """All tokens of texts that end in `state`: the last word, or white space at the end, is one more."""
    return count + (state != START)


_CUTS = T.StructType().add("n", "long").add("found", "boolean").add("a", "integer").add("b", "integer")
_LISTS = T.ArrayType(T.ByteType()), T.ArrayType(T.LongType())


def _answer(n, found, a, b) -> pa.StructArray:
    return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(found, pa.bool_()), pa.array(a, pa.int32()), pa.array(b, pa.int32())], names=["n", "found", "a", "b"])


def _ranks(h1: np.ndarray, h2: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x, y = h1 % (n + 1), h2 % (n + 1)
    return np.minimum(x, y), np.maximum(x, y)


@F.arrow_udf(_CUTS)
def cuts(text: pa.Array, h1: pa.Array, h2: pa.Array) -> pa.Array:
    """Tokens, whether a sentinel occurs, and the bytes where prefix and middle end."""
    out = [_answer([], [], [], [])]
    for b in slices(pa.RecordBatch.from_arrays([text, h1, h2], names=["text", "h1", "h2"])):
        off, data = _offsets(b.column("text"))
        s = Scan(data, off)
        state, count = s.enter(np.full(b.num_rows, START))
        n = tokens(state, count)
        ends = []
        for k in _ranks(*(b.column(c).to_numpy() for c in ("h1", "h2")), n):
            at, inner = np.where(k == n, np.diff(off), 0), (k > 0) & (k < n)
            at[inner] = s.select(np.flatnonzero(inner), k[inner])
            ends.append(at)
        out.append(_answer(n, state >= GAP_FOUND, *ends))
    return pa.concat_arrays(out)


@F.arrow_udf(T.StructType().add("e", _LISTS[0]).add("n", _LISTS[1]))
def function(piece: pa.Array) -> pa.Array:
    """The function of each piece."""
    got = [Scan(d, np.array([0, len(d)])).function() for d in (np.frombuffer(p.as_buffer(), np.uint8) for p in piece)]
    return pa.StructArray.from_arrays([pa.array([e.tolist() for e, _ in got], pa.list_(pa.int8())), pa.array([n.tolist() for _, n in got], pa.list_(pa.int64()))], names=["e", "n"])


@F.arrow_udf(T.StructType().add("state", _LISTS[0]).add("before", _LISTS[1]).add("n", "long").add("found", "boolean"))
def entries(functions: pa.Array) -> pa.Array:
    """From a text's functions, in order: the entry state of each piece, the tokens that end before it, all tokens."""
    rows = []
    for fs in functions.to_pylist():
        state, count, states, before = START, 0, [], []
        for f in fs:
            states.append(state)
            before.append(count)
            count += f["n"][state]
            state = f["e"][state]
        rows.append((states, before, int(tokens(np.int64(state), count)), state >= GAP_FOUND))
    kinds = [pa.list_(pa.int8()), pa.list_(pa.int64()), pa.int64(), pa.bool_()]
    return pa.StructArray.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["state", "before", "n", "found"])


@F.arrow_udf(_CUTS)
def piece_cuts(text: pa.Array, h1: pa.Array, h2: pa.Array, entry: pa.Array) -> pa.Array:
    """As cuts, but only the pieces where a cut falls are scanned."""
    rows, off = [], None
    for i, e in enumerate(entry.to_pylist()):
        off, data = _offsets(text.slice(i, 1))
        before, ends = np.array(e["before"]), []
        for k in _ranks(np.int64(h1[i].as_py()), np.int64(h2[i].as_py()), np.int64(e["n"])):
            if k == 0 or k == e["n"]:
                ends.append(0 if k == 0 else len(data))
                continue
            p = int(np.searchsorted(before, k, "left")) - 1
            part = data[p * PIECE : (p + 1) * PIECE]
            s = Scan(part, np.array([0, len(part)]))
            s.enter(np.array([e["state"][p]]))
            ends.append(p * PIECE + int(s.select(np.zeros(1, np.int64), np.array([k - before[p]]))[0]))
        rows.append((e["n"], e["found"], *ends))
    return _answer(*([r[i] for r in rows] for i in range(4)))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(k, no, piece) of every (k, text)."""
    for b in batches:
        for i in range(b.num_rows):
            key, (_, data) = b.column("k")[i].as_py(), _offsets(b.column("text").slice(i, 1))
            for no, at in enumerate(range(0, len(data), PIECE)):
                yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([no], pa.int32()), pa.array([data[at : at + PIECE].tobytes()], pa.binary())], names=["k", "no", "piece"])


def scanned(docs: DataFrame, h1: Column, h2: Column, text: str = "text") -> tuple[DataFrame, str]:
    """docs with a struct (n, found, a, b), and its column's name: tokens, whether a sentinel occurs, the bytes where the tokens
    h1 % (n + 1) and h2 % (n + 1), in order, end."""
    name, x, y, key = fresh(docs, "cut", "h1", "h2", "k")
    d = docs.withColumn(x, h1).withColumn(y, h2)
    # null texts are short
    long = F.coalesce(F.octet_length(text), F.lit(0)) > PIECE
    short = d.where(~long).withColumn(name, cuts(F.coalesce(F.col(text), F.lit("")), x, y)).select(*docs.columns, name)
    g = d.where(long).withColumn(key, F.sha2(text, 256))
    # equal texts are scanned once; pieces, not texts, are dealt out
    pieces = g.select(F.col(key).alias("k"), F.col(text).alias("text")).mapInArrow(tidied(_pieces), "k string, no int, piece binary").dropDuplicates(["k", "no"])
    each = pieces.select("k", "no", function("piece").alias("f")).groupBy("k").agg(F.sort_array(F.collect_list(F.struct("no", "f.e", "f.n"))).alias("fs"))
    entry = each.select(F.col("k").alias(key), entries("fs").alias("entry_"))
    e = fresh(g, "entry")[0]
    found = g.join(entry.withColumnRenamed("entry_", e), key).withColumn(name, piece_cuts(text, x, y, e))
    return short.unionByName(found.select(*docs.columns, name)), name


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 42, percent: int = 50, spm: int = 80) -> DataFrame:
    """docs and: n (tokens), form, prefix_chars, middle_chars, output; a name that docs has gets underscores.

    A token is white space (0x20, 0x09-0x0D) and the word after it, or white space at the end. `percent` of the texts are cut, by a
    hash of seed and key; of those `spm` percent have the suffix first. Empty and null texts, and those with one of the sentinels,
    stay plain; a null key hashes as ''. Repeated rows give equal rows; other columns stay as they are."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    h = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]
    got, cut = scanned(docs, h[0], h[1], text)
    n, form, pre, mid, out = fresh(got, "n", "form", "prefix_chars", "middle_chars", "output")
    body = F.coalesce(F.col(text), F.lit(""))
    raw = body.cast("binary")
    part = lambda at, size: F.substr(raw, at + 1, size).cast("string")
    a, b = F.col(f"{cut}.a"), F.col(f"{cut}.b")
    prefix, middle, suffix = part(F.lit(0), a), part(a, b - a), part(b, F.length(raw) - b)
    plain = (body == "") | F.col(f"{cut}.found") | (h[2] % 100 >= percent)
    got = got.withColumn(form, F.when(plain, "plain").when(h[3] % 100 < spm, "spm").otherwise("psm"))
    shaped = F.when(F.col(form) == "plain", body).when(F.col(form) == "spm", F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle)).otherwise(F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
    chars = lambda c: F.when(F.col(form) != "plain", F.length(c).cast("bigint"))
    return got.select(*docs.columns, F.col(f"{cut}.n").alias(n), form, chars(prefix).alias(pre), chars(middle).alias(mid), shaped.alias(out))


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of. Sentinels occur once each: texts that hold one are plain."""
    between = lambda left, right: F.substring_index(F.substring_index(output, right, 1), left, -1)
    middle = F.substring_index(output, MIDDLE, -1)
    psm = F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX))
    return F.when(form == "plain", output).when(form == "spm", spm).otherwise(psm)


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


OP11_SQL = r"""with d as (select doc_id, coalesce(text, '') as t, sha256('42:' || coalesce(cast(doc_id as varchar), '')) as h,
 regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as w from documents),
x as (select *, len(w) as n, ('0x' || h[1:8])::bigint as h1, ('0x' || h[9:16])::bigint as h2, ('0x' || h[17:24])::bigint as h3, ('0x' || h[25:32])::bigint as h4 from d),
c as (select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
 case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 50 then 'plain' when h4 % 100 < 80 then 'spm' else 'psm' end as form from x),
p as (select *, coalesce(array_to_string(w[1:a], ''), '') as p, coalesce(array_to_string(w[a + 1:b], ''), '') as m, coalesce(array_to_string(w[b + 1:n], ''), '') as s from c)
select doc_id, n, form, case when form <> 'plain' then length(p) end as prefix_chars, case when form <> 'plain' then length(m) end as middle_chars,
 sha256(case form when 'plain' then t when 'spm' then '<S>' || s || '<P>' || p || '<M>' || m else '<P>' || p || '<S>' || s || '<M>' || m end) as output_sha256, sha256(t) as restored_sha256 from p"""
