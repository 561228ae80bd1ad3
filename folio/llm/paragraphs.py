"""Substring dedup: paragraph MinHash banding, exact verification, components; repeated sentences inside other paragraphs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SLICE_BYTES, Words, fresh, mix, powers, removed, sets, shingles, slices, table, tidied, written
from .graph import components
from .jaccard import CHUNK_BYTES, MEET, WORDS, _column, _near, _pack, _unpack, blocked, parities

#: Words of a shingle, the similarity of a link, the recall that bands are tuned for at it, and rows of a band.
K, SIMILARITY, RECALL, ROWS = 5, 0.8, 0.995, 3
#: Every paragraph (line) of K words is compared. One of fewer than so many is cut only within a longer run of repeated words, or
#: with a text that repeats whole: lines such as a licence's name stay.
PARAGRAPH_WORDS = 20
#: A text of so many words or more that repeats whole is cut, whatever its paragraphs.
TEXT_WORDS = 10
#: A sentence of fewer words belongs to the next one.
SENTENCE_WORDS = 5
#: Repeated words in a row that are removed at least: paragraphs and sentences that repeat add up.
RUN_WORDS = 30
#: A run of so many words that repeats is found wherever it begins. Words of the anchors that lead to it, and of the stretch
#: of text that has one at least: a repeated run holds a whole stretch, and so the same anchor in each of its places.
WINDOW, ANCHOR = 50, 20
STRETCH = WINDOW - ANCHOR + 1
#: Bits of a filter of keys: so many for each key, as a power of two between these (64 MB at most; a fuller filter lets more
#: through to the exact step and loses none); and its segments.
BITS_A_KEY, LEAST_BITS, MOST_BITS, SEGMENTS = 16, 20, 29, 64
_U = np.uint64


def tune_bands(similarity: float = SIMILARITY, rows: int = ROWS, recall: float = RECALL) -> int:
    """The least number of bands that lets a pair of that similarity collide with probability `recall` at least."""
    return max(1, int(np.ceil(np.log(1 - recall) / np.log(1 - similarity**rows))))


_SEEDS = np.random.default_rng(977).integers(1, 1 << 63, ROWS * 64, dtype=np.uint64) * _U(2) + _U(1)


class Parts:
    """Words of texts, cut into lines and sentences; hashes of both."""

    def __init__(self, col: pa.Array):
        w = self.words = Words(col)
        n = len(w.start)
        newline = np.cumsum(np.concatenate([[0], (w.data == 10).astype(np.int64)]))
        ends = np.zeros(n, bool)  # the last word of a line
        if n:
            ends[:-1] = newline[w.start[1:]] > newline[w.end[:-1]]
            ends[w.first[1:][w.per_doc > 0] - 1] = True
        self.line = self._spans(np.flatnonzero(ends) + 1)
        last = w.data[w.end - 1] if n else np.zeros(0, np.uint8)
        stop = (last == 46) | (last == 33) | (last == 63)
        # a sentence end counts if its own sentence is long enough
        raw = np.flatnonzero(stop | ends) + 1
        size = np.diff(raw, prepend=0)
        self.sentence = self._spans(raw[(size >= SENTENCE_WORDS) | ends[raw - 1]])
        up, down = powers(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(w.hash * up[:n], out=total[1:])
        self.line_key = mix((total[self.line[1:]] - total[self.line[:-1]]) * down[self.line[:-1]])
        self.sentence_key = mix((total[self.sentence[1:]] - total[self.sentence[:-1]]) * down[self.sentence[:-1]] + _U(1))

    def _grams(self, size: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of `size` words from each word on, and which of them end in their own text."""
        n = len(self.words.hash)
        if n < size:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        up, down = powers(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(self.words.hash * up[:n], out=total[1:])
        bound = np.repeat(self.words.first[1:], self.words.per_doc)
        at = np.arange(n - size + 1)
        return mix((total[size:] - total[:-size]) * down[at] + _U(salt)), at + size <= bound[at]

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and first words of the anchors: of each stretch within a text the gram of least hash, all of them if equal."""
        h, whole = self._grams(ANCHOR, 2)
        if len(h) < STRETCH:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        m = len(h) - STRETCH + 1
        # minima of stretches by doubling
        low, size = h.copy(), 1
        while size * 2 <= STRETCH:
            low = np.minimum(low[:-size], low[size:])
            size *= 2
        low = np.minimum(low[:m], low[STRETCH - size : STRETCH - size + m])
        inside = whole[STRETCH - 1 :][:m] & (self._row()[:m] == self._row()[STRETCH - 1 :][:m])
        pick = np.zeros(len(h), bool)
        for i in range(STRETCH):
            pick[i : i + m] |= inside & (h[i : i + m] == low)
        at = np.flatnonzero(pick)
        return h[at], at

    def _row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.words.per_doc)), self.words.per_doc)

    def windows(self, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and first words of the windows that hold an anchor which the filter knows."""
        a, at = self.anchors()
        at = at[_known(bits, a)]
        if not len(at):
            return np.zeros(0, np.uint64), at
        h, whole = self._grams(WINDOW, 3)
        near = np.zeros(len(self.words.hash) + 1, np.int64)
        np.add.at(near, np.maximum(at - (WINDOW - ANCHOR), 0), 1)
        np.add.at(near, at + 1, -1)
        at = np.flatnonzero((np.cumsum(near)[: len(h)] > 0) & whole)
        return h[at], at

    @staticmethod
    def _spans(ends: np.ndarray) -> np.ndarray:
        return np.concatenate([[0], ends]).astype(np.int64)

    def doc_of(self, spans: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.words.first, spans[:-1], "right") - 1

    def line_sets(self) -> tuple[np.ndarray, np.ndarray]:
        return shingles(self.words.hash, self.line, K)


def _lines(docs: DataFrame, text: str, bands: int) -> DataFrame:
    """(key, doc_id, line_no, bands) of every paragraph of K words or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, text):
                p = Parts(b.column(text))
                doc = p.doc_of(p.line)
                no = np.arange(len(doc)) - np.searchsorted(doc, doc)
                keep = np.flatnonzero(np.diff(p.line) >= K)
                h, row = p.line_sets()
                order = np.argsort(row, kind="stable")
                h, row = h[order], row[order]
                begin = np.searchsorted(row, keep)
                end = np.searchsorted(row, keep, "right")
                if not len(keep):
                    continue
                # minima over each kept line; reduceat on (begin, end) pairs
                cut = np.stack([begin, end], 1).reshape(-1)
                h = np.append(h, _U(2**64 - 1))
                out = []
                for i in range(bands):
                    total = np.zeros(len(keep), np.uint64)
                    for j in range(ROWS):
                        total = mix(total + np.minimum.reduceat(h * _SEEDS[i * ROWS + j], cut)[::2] + _U(i + 1))
                    out.append(total.view(np.int64))
                every = np.stack(out, 1)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, every.size + 1, bands), pa.int32()), pa.array(every.reshape(-1)))
                yield pa.RecordBatch.from_arrays([pa.array(p.line_key[keep].view(np.int64)), b.column("doc_id").take(pa.array(doc[keep])), pa.array(no[keep], pa.int64()), lists], names=["key", "doc_id", "line_no", "bands"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text).mapInArrow(tidied(run), "key bigint, doc_id bigint, line_no bigint, bands array<bigint>")


def _known(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys' bits are set."""
    k = keys & _U(8 * len(bits) - 1)
    return (bits[(k >> _U(3)).astype(np.int64)] >> (k & _U(7)).astype(np.uint8)) & 1 > 0


def _filter_of(keys: DataFrame) -> np.ndarray:
    """A bit for each value of the keys' last bits, as many as their number asks for."""
    keys = written(keys)
    width = 1 << (min(MOST_BITS, max(LEAST_BITS, (keys.count() * BITS_A_KEY).bit_length())) - 3)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(width, np.uint8)
        for b in batches:
            k = b.column(0).to_numpy().view(np.uint64) & _U(8 * width - 1)
            np.bitwise_or.at(bits, (k >> _U(3)).astype(np.int64), (_U(1) << (k & _U(7))).astype(np.uint8))
        parts = [(i, x) for i, x in enumerate(bits.reshape(SEGMENTS, -1)) if x.any()]
        yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in parts], pa.int32()), pa.array([zstandard.compress(x.tobytes(), 1) for _, x in parts], pa.binary())], names=["segment", "bits"])

    def merge(t):
        out = None
        for x in t.column("bits").to_pylist():
            x = np.frombuffer(zstandard.decompress(x), np.uint8)
            out = x if out is None else out | x
        return pa.table({"segment": t.column("segment").slice(0, 1), "bits": pa.array([zstandard.compress(out.tobytes(), 1)], pa.binary())})

    bits = np.zeros((SEGMENTS, width // SEGMENTS), np.uint8)
    # written first: read one by one from the shuffle, the segments would be a job for each of its partitions
    merged = written(keys.mapInArrow(tidied(mark), "segment int, bits binary").groupBy("segment").applyInArrow(merge, "segment int, bits binary"))
    for r in merged.toLocalIterator():
        bits[r.segment] = np.frombuffer(zstandard.decompress(bytes(r.bits)), np.uint8)
    removed(keys)
    removed(merged)
    return bits.reshape(-1)


def _repeated_anchors(docs: DataFrame, text: str) -> np.ndarray:
    """The filter of the anchors that are in more than one place. It may know others too, but lacks none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, text):
                every, n = np.unique(Parts(b.column(text)).anchors()[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(every.view(np.int64)), pa.array(n, pa.int64())], names=["key", "n"])

    every = docs.select(text).mapInArrow(tidied(run), "key bigint, n bigint")
    return _filter_of(every.groupBy("key").agg(F.sum("n").alias("n")).where("n > 1").select("key"))


def near_paragraphs(docs: DataFrame, text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """(key, keeper_doc, keeper_line): for every distinct paragraph that has a copy or a near copy, the first place (least
    doc_id, then line) of its component.

    First every member of a band bucket is held against the bucket's least and greatest key, two pairs a member, which joins
    most groups. Then members of a bucket that are in different components are paired with each other: no two paragraphs
    that meet in a band and are alike end in different components."""
    bands = tune_bands(similarity)
    percent = int(np.floor(100 * similarity))
    lines = written(_lines(docs, text, bands))
    first = lines.groupBy("key").agg(F.min(F.struct("doc_id", "line_no")).alias("at"), F.count("*").alias("n"))
    once = lines.select("key", F.posexplode("bands").alias("band", "hash")).distinct()
    hubs = once.groupBy("band", "hash").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).where("lo <> hi")
    met = written(once.join(hubs, ["band", "hash"]))
    pairs = met.select("key", F.explode(F.array("lo", "hi")).alias("hub")).where("key <> hub").select(F.least("key", "hub").alias("a"), F.greatest("key", "hub").alias("b")).distinct()
    pairs = written(pairs)
    wanted = _filter_of(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct())
    held = docs.sparkSession.sparkContext.broadcast(wanted)

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = held.value
        for whole in batches:
            for b in slices(whole, text):
                p = Parts(b.column(text))
                keep = np.flatnonzero((np.diff(p.line) >= K) & _known(bits, p.line_key))
                if not len(keep):
                    continue
                _, one = np.unique(p.line_key[keep], return_index=True)
                keep = keep[np.sort(one)]
                h, begin = sets(*p.line_sets(), len(p.line) - 1)
                size = begin[keep + 1] - begin[keep]
                got = h[np.repeat(begin[keep] - (np.cumsum(size) - size), size) + np.arange(size.sum())]
                bitmap = parities(got, np.concatenate([[0], np.cumsum(size)]))
                out = {"key": pa.array(p.line_key[keep].view(np.int64)), "members": pa.array([h[begin[i] : begin[i + 1]].tobytes() for i in keep], pa.binary()), "n": pa.array(size, pa.int64())}
                out |= {f"s{w}": pa.array(bitmap[:, w]) for w in range(WORDS)}
                yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    marks = [f"s{w}" for w in range(WORDS)]
    found = docs.select(text).mapInArrow(tidied(members), ", ".join(["key bigint, members binary, n bigint", *[f"{m} bigint" for m in marks]])).dropDuplicates(["key"])
    found = written(found.join(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct(), "key", "left_semi"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = []
            for x, y in zip(b.column("members_a").to_pylist(), b.column("members_b").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                inter = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(inter >= similarity * (len(x) + len(y) - inter))
            yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    def verified(both: DataFrame) -> DataFrame:
        for side in "ab":
            both = both.join(found.select(F.col("key").alias(side), F.col("members").alias(f"members_{side}")), side)
        return both.select("a", "b", "members_a", "members_b").mapInArrow(tidied(verify), "a bigint, b bigint")

    linked = written(verified(pairs))
    label = components(linked)
    # buckets whose members are still in different components: all pairs across these, but those already held against a hub
    marked = written(met.join(label, met["key"] == label["node"], "left").select("band", "hash", "lo", "hi", "key", F.coalesce("component", "key").alias("c")))
    mixed = marked.groupBy("band", "hash").agg(F.min("c").alias("c0"), F.max("c").alias("c1"), F.count("*").alias("m")).where("c0 <> c1 and m > 2").select("band", "hash", "m")
    # made distinct before the join: a line that very many documents have is one row of each task by then
    sketch = lines.select("key", "bands").dropDuplicates(["key"]).join(found, "key", "left_semi")
    left = written(blocked(marked.where("key <> lo and key <> hi").join(mixed, ["band", "hash"]), "m").join(found.select("key", "n", *marks), "key").join(sketch, "key"))
    # a pair comes from its first common band alone, and only if its bitmaps allow a link
    alone = "array_position(zip_with(x.bands, y.bands, (p, q) -> p = q), true) = x.band + 1"
    sizes = f"100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n)"
    same = [f"x.band = y.band and x.hash = y.hash and x.c < y.c and {MEET}", sizes, _near(percent, "x", "y"), alone]
    more = left.alias("x").join(left.alias("y"), F.expr(" and ".join(same))).select(F.least("x.key", "y.key").alias("a"), F.greatest("x.key", "y.key").alias("b")).distinct()
    stars = label.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    label = components(stars.unionByName(verified(more)))
    named = written(first.join(label, first["key"] == label["node"], "left").where("n > 1 or component is not null").select("key", "at", F.coalesce("component", "key").alias("component")))
    keepers = named.groupBy("component").agg(F.min("at").alias("keeper"))
    return written(named.join(keepers, "component").select("key", F.col("keeper.doc_id").alias("keeper_doc"), F.col("keeper.line_no").alias("keeper_line")))


def dedup(docs: DataFrame, text: str = "text", similarity: float = SIMILARITY, run_words: int = RUN_WORDS) -> DataFrame:
    """docs with repeated passages cut out of text, plus n_words, removed_words, kept_in (see below).

    Two things repeat: a paragraph (a line of 5 words or more) whose 5-word shingles are 80 % like an earlier one's, found
    by MinHash bands, verified exactly and clustered by components; and a sentence, or a run of WINDOW words wherever it
    begins, equal to an earlier one. Earlier is by doc_id, then by place; the first occurrence stays. Such a paragraph of
    PARAGRAPH_WORDS or more is cut, and so is a text of TEXT_WORDS or more all of which repeat; where other repeated words in a row come to `run_words` or more they are cut, with the space after
    them; anything shorter is left as it is, so a document without such a run keeps its text to the byte. n_words and removed_words are counts; kept_in lists (ascending, distinct) the
    doc_ids that hold the copies which stay. Null and empty texts stay as they are. Of rows that share a doc_id, the first
    (by text) keeps a passage; rows alike in doc_id and text are one document and get the same result. A doc_id is any integer; null ones come
    before others. A new name that docs already has gets underscores at its end.

    Every WINDOW words in a row that repeat hold an anchor (20 words chosen by their hashes) that repeats too: all windows about
    such anchors count as sentences do. Chunks send their sentences' and windows' hashes, with the least doc_id that has each, to buckets by range and get a byte and a
    doc_id for each that repeats: texts cross once, hashes in a few bytes, and a passage that many documents have is
    one row from each chunk."""
    names = fresh(docs, "n_words", "removed_words", "kept_in")
    key = [F.col("doc_id"), F.xxhash64(text), F.xxhash64(F.lit(5), text)]
    if not docs.groupBy(*[k.alias(f"k{i}") for i, k in enumerate(key)]).count().where("count > 1").isEmpty():
        # repeated rows are cut once and joined to: however many there are, no chunk holds them
        few = docs.select("doc_id", F.col(text).alias("text_")).dropDuplicates()
        cut = dedup(few.withColumn("h1_", F.xxhash64("text_")).withColumn("h2_", F.xxhash64(F.lit(5), "text_")), "text_", similarity, run_words)
        cut = cut.select(F.col("doc_id").alias("id_"), "h1_", "h2_", F.struct("text_", "n_words", "removed_words", "kept_in").alias("new_"))
        d = docs.select(F.struct("*").alias("row_"), *[k.alias(n) for k, n in zip(key, ("id_", "h1_", "h2_"))])
        d = d.alias("d").join(cut.alias("c"), F.expr("d.id_ <=> c.id_ and d.h1_ = c.h1_ and d.h2_ = c.h2_"))
        kept = [F.col(f"new_.text_").alias(text) if c == text else F.col(f"row_.`{c}`").alias(c) for c in docs.columns]
        return d.select(*kept, *[F.col(f"new_.{a}").alias(b) for a, b in zip(("n_words", "removed_words", "kept_in"), names)])
    near = near_paragraphs(docs, text, similarity)
    anchored = docs.sparkSession.sparkContext.broadcast(_repeated_anchors(docs, text))
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)), F.count("*")).first()
    chunks = max(1, -(-size[0] // CHUNK_BYTES), -(-size[1] // 40_000))
    bits = min(20, max(0, int(np.ceil(np.log2(max(1, size[0] / 50 / (1 << 19)))))))
    columns = docs.columns
    chunk = F.pmod(F.xxhash64("doc_id", F.substring(text, 1, 64), F.lit(23)), F.lit(chunks)).cast("int")
    chunk_name = fresh(docs, "chunk_")[0]
    dealt = docs.withColumn(chunk_name, chunk).groupBy(chunk_name)

    def ordered(t):
        # by doc_id (null first), then text
        ids, texts = _column(t, "doc_id").to_pylist(), _column(t, text).to_pylist()
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0, texts[i] or ""))
        return t.take(pa.array(order, pa.int64())).combine_chunks()

    def parts_of(t):
        """(rows' range, their Parts) in slices."""
        at = 0
        for b in slices(pa.RecordBatch.from_arrays([_column(t, text)], names=["text"]), most=SLICE_BYTES):
            yield at, b.num_rows, Parts(b.column(0))
            at += b.num_rows

    none = np.int64(-(2**63))

    def doc_ids(t) -> np.ndarray:
        return _column(t, "doc_id").cast(pa.int64()).fill_null(int(none)).to_numpy(zero_copy_only=False)

    def sentences(t):
        """Distinct sentence and window hashes of a chunk, ascending, and the least doc_id of each."""
        ids, keys, owner = doc_ids(t), [], []
        for at, _, p in parts_of(t):
            keys.append(p.sentence_key)
            owner.append(ids[at + p.doc_of(p.sentence)])
            k, first = p.windows(anchored.value)
            keys.append(k)
            owner.append(ids[at + p._row()[first]])
        k, o = np.concatenate([*keys, np.zeros(0, np.uint64)]), np.concatenate([*owner, np.zeros(0, np.int64)])
        every, one, n = np.unique(k, return_index=True, return_counts=True)  # rows are ordered: the first has the least doc_id
        return every, o[one], n

    def cuts_of(every):
        return np.searchsorted(every >> _U(64 - bits) if bits else np.zeros(len(every), np.uint64), np.arange((1 << bits) + 1, dtype=np.uint64))

    def send(key, t):
        every, owner, n = sentences(ordered(t))
        cuts = cuts_of(every)
        at = [i for i in range(1 << bits) if cuts[i + 1] > cuts[i]]
        pack = lambda x: zstandard.compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T).tobytes(), 1)
        more = np.minimum(n, 2).astype(np.uint8)
        return pa.table({"chunk_": pa.array([key[0].as_py()] * len(at), pa.int32()), "bucket": pa.array(at, pa.int32()), "packed": pa.array([_pack(every[cuts[i] : cuts[i + 1]]) for i in at], pa.binary()), "owner": pa.array([pack(owner[cuts[i] : cuts[i + 1]]) for i in at], pa.binary()), "more": pa.array([zstandard.compress(more[cuts[i] : cuts[i + 1]].tobytes(), 1) for i in at], pa.binary())})

    def tally(t):
        lists = [_unpack(x) for x in t.column("packed").to_pylist()]
        owner = np.concatenate([np.ascontiguousarray(np.frombuffer(zstandard.decompress(x), np.uint8).reshape(8, -1).T).reshape(-1).view(np.int64) for x in t.column("owner").to_pylist()])
        more = np.concatenate([np.frombuffer(zstandard.decompress(x), np.uint8) for x in t.column("more").to_pylist()])
        every, where, n = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
        least = np.full(len(every), 2**63 - 1, np.int64)
        np.minimum.at(least, where, owner)
        again = ((n[where] > 1) | (more > 1)).astype(np.uint8)
        kept, cuts, out = least[where], np.cumsum([0, *map(len, lists)]), []
        for a, b in zip(cuts, cuts[1:]):
            flag = again[a:b]
            out.append(zstandard.compress(flag.tobytes() + kept[a:b][flag > 0].tobytes(), 1))
        return pa.table({"chunk_": t.column("chunk_"), "bucket": t.column("bucket"), "answer": pa.array(out, pa.binary())})

    def runs_of(gone, w):
        """Where runs of such words begin and end, each within a document."""
        n = len(gone)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        firsts = w.first[:-1][w.per_doc > 0]
        start = np.union1d(np.flatnonzero(gone & ~np.concatenate([[False], gone[:-1]])), firsts[gone[firsts]])
        stop_at = np.append(np.flatnonzero(~gone), n)
        bound = w.first[np.searchsorted(w.first, start, "right")] if len(start) else start
        return start, np.minimum(stop_at[np.searchsorted(stop_at, start)], bound) if len(start) else start

    def cut(key, t, answers):
        t = ordered(t)
        ids, texts = doc_ids(t), _column(t, text).to_pylist()
        every, _, _ = sentences(t)
        cuts = cuts_of(every)
        again, keeper = np.zeros(len(every), bool), np.full(len(every), none)
        near_doc, near_line = {}, {}
        for bucket, answer, k, d, ln in zip(*(answers.column(c).to_pylist() for c in ("bucket", "answer", "key", "keeper_doc", "keeper_line"))):
            if answer is None:
                near_doc[k], near_line[k] = (int(none) if d is None else d), ln
                continue
            a, b = cuts[bucket], cuts[bucket + 1]
            raw = zstandard.decompress(answer)
            flag = np.frombuffer(raw, np.uint8, b - a) > 0
            again[a:b] = flag
            keeper[a:b][flag] = np.frombuffer(raw, np.int64, offset=b - a)
        near_keys = np.array(sorted(near_doc), np.int64)
        kd = np.array([near_doc[k] for k in near_keys.tolist()], np.int64)
        kl = np.array([near_line[k] for k in near_keys.tolist()], np.int64)
        seen, seen_near = np.zeros(len(every), bool), set()
        words, removed, kept_in, out = [], [], [], []
        for at, rows, p in parts_of(t):
            w = p.words
            n = len(w.start)
            gone, source = np.zeros(n, bool), np.full(n, none)
            # sentences: every occurrence but the first one of the document that keeps it
            idx = np.searchsorted(every, p.sentence_key)
            own = ids[at + p.doc_of(p.sentence)]
            order = np.zeros(len(idx), bool)
            _, one = np.unique(idx, return_index=True)
            order[one] = True
            stays = (keeper[idx] == own) & order & ~seen[idx]
            seen[idx[stays]] = True
            flag = again[idx] & ~stays
            spread = np.diff(p.sentence)
            gone |= np.repeat(flag, spread)
            source = np.where(np.repeat(flag, spread), np.repeat(keeper[idx], spread), source)
            # paragraphs
            must = np.zeros(n, bool)
            if len(near_keys):
                lk = p.line_key.view(np.int64)
                pos = np.minimum(np.searchsorted(near_keys, lk), len(near_keys) - 1)
                hit = (near_keys[pos] == lk) & (np.diff(p.line) >= K)
                doc = p.doc_of(p.line)
                no = np.arange(len(doc)) - np.searchsorted(doc, doc)
                first = hit & (kd[pos] == ids[at + doc]) & (kl[pos] == no)
                for i in np.flatnonzero(first).tolist():
                    name = (int(kd[pos[i]]), int(kl[pos[i]]))
                    if name in seen_near:
                        first[i] = False
                    seen_near.add(name)
                flag = hit & ~first
                size = np.diff(p.line)
                must = np.repeat(flag & (size >= PARAGRAPH_WORDS), size)
                new = np.repeat(flag, size) & ~gone
                gone |= new
                source = np.where(new, np.repeat(kd[pos], np.diff(p.line)), source)
            # windows: as sentences, but a window that overlaps its first occurrence leaves the words of that alone
            k, first = p.windows(anchored.value)
            if len(k):
                idx, row = np.searchsorted(every, k), p._row()[first]
                own = keeper[idx] == ids[at + row]
                order = np.zeros(len(idx), bool)
                _, one, same = np.unique(idx, return_index=True, return_inverse=True)
                order[one] = True
                stays = own & order & ~seen[idx]
                origin = first[one][same]
                seen[idx[stays]] = True
                flag = np.flatnonzero(again[idx] & ~stays)
                a, z = first[flag], first[flag] + WINDOW
                inside = own[flag] & (p._row()[origin[flag]] == row[flag]) & (origin[flag] < a)
                a = np.where(inside, np.maximum(a, origin[flag] + WINDOW), a)
                depth = np.zeros(n + 1, np.int64)
                np.add.at(depth, a, 1)
                np.add.at(depth, z, -1)
                latest = np.full(n, -1)
                latest[first[flag]] = np.arange(len(flag))
                new = (np.cumsum(depth)[:n] > 0) & ~gone
                gone |= new
                source[new] = keeper[idx][flag][np.maximum.accumulate(latest)[new]]
            # a text that repeats whole
            left = np.bincount(p._row()[~gone], minlength=rows)
            must |= np.repeat((left == 0) & (w.per_doc >= TEXT_WORDS), w.per_doc)
            # runs within documents: long ones, and of others the paragraphs
            start, end = runs_of(gone, w)
            big = (end - start) >= run_words
            long = np.zeros(n + 1, np.int64)
            long[start[big]] += 1
            np.add.at(long, end[big], -1)
            start, end = runs_of((np.cumsum(long)[:n] > 0) | must, w)
            owner_doc = np.searchsorted(w.first, start, "right") - 1
            by_doc: dict[int, list[tuple[int, int]]] = {}
            for d, a, b in zip(owner_doc.tolist(), start.tolist(), end.tolist()):
                by_doc.setdefault(d, []).append((a, b))
            for d in range(rows):
                s = texts[at + d]
                words.append(int(w.per_doc[d]))
                runs = by_doc.get(d, [])
                removed.append(sum(b - a for a, b in runs))
                where = [source[a:b] for a, b in runs]
                kept_in.append(np.unique(np.concatenate(where)).tolist() if where else [])
                if runs:
                    raw, base = s.encode("utf-8"), int(w.off[d])
                    pieces, last = [], 0
                    for a, b in runs:
                        pieces.append(raw[last : int(w.start[a]) - base])
                        last = int(w.start[b]) - base if b < w.first[d + 1] else len(raw)
                    s = b"".join([*pieces, raw[last:]]).decode("utf-8")
                out.append(s)
        kept_in = [[x for x in k if x != none] for k in kept_in]
        got = {c: (pa.array(out, pa.string()) if c == text else _column(t, c)) for c in columns}
        return pa.table(got | dict(zip(names, (pa.array(words, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept_in, pa.list_(pa.int64()))))))

    answers = dealt.applyInArrow(send, "chunk_ int, bucket int, packed binary, owner binary, more binary").groupBy("bucket").applyInArrow(tally, "chunk_ int, bucket int, answer binary")
    wanted = docs.sparkSession.sparkContext.broadcast(_filter_of(near.select("key")))
    where = docs.select(chunk.alias("chunk_"), text).mapInArrow(tidied(_line_keys(text, wanted)), "chunk_ int, key bigint").distinct()
    told = where.join(near, "key").select("chunk_", F.lit(None).cast("int").alias("bucket"), F.lit(None).cast("binary").alias("answer"), "key", "keeper_doc", "keeper_line")
    answers = answers.select("chunk_", "bucket", "answer", F.lit(None).cast("bigint").alias("key"), F.lit(None).cast("bigint").alias("keeper_doc"), F.lit(None).cast("bigint").alias("keeper_line")).unionByName(told)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), f"`{names[0]}` bigint, `{names[1]}` bigint, `{names[2]}` array<bigint>"])
    return dealt.cogroup(answers.groupBy("chunk_")).applyInArrow(cut, schema)


def _line_keys(text: str, wanted):
    """(chunk_, key) of the paragraphs whose key the filter knows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, text):
                p = Parts(b.column(text))
                keep = np.flatnonzero((np.diff(p.line) >= K) & _known(wanted.value, p.line_key))
                yield pa.RecordBatch.from_arrays([b.column("chunk_").take(pa.array(p.doc_of(p.line)[keep])), pa.array(p.line_key[keep].view(np.int64))], names=["chunk_", "key"])

    return run


def op5_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
