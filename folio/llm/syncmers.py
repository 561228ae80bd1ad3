"""Document fingerprints from closed syncmers."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import mix, powers, slices, table, tidied

_U = np.uint64
#: Code points of an anchor and of its inner substrings.
K, S = 16, 8
#: A fingerprint keeps so many anchors, or one in SPARSE of a text that has more than KEEP * SPARSE.
KEEP, SPARSE = 48, 16
#: Range slots for each shuffle partition, in the search for the next document.
SLOTS = 8


def _anchors(cps: np.ndarray, off: np.ndarray, k: int, s: int) -> tuple[np.ndarray, np.ndarray]:
    """(global position, hash) of all closed syncmers: k-mers whose least inner s-mer is their first or last one."""
    n, w = len(cps), k - s + 1
    if n < k:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    up, down = powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(mix(cps.astype(np.uint64) + _U(1)) * up[:n], out=total[1:])
    inner = mix((total[s:] - total[:-s]) * down[: n - s + 1])
    least, width = inner, 1
    while width * 2 <= w:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < w:
        least = np.minimum(least[: n - k + 1], least[w - width : w - width + n - k + 1])
    at = np.flatnonzero((least == inner[: n - k + 1]) | (least == inner[w - 1 : w + n - k]))
    end_of = np.repeat(off[1:], np.diff(off))  # a k-mer stays in its document
    at = at[at + k <= end_of[at]]
    return at, mix(((total[at + k] - total[at]) * down[at]) ^ _U(0x5851F42D4C957F2D))


def _utf32(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    off = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=off[1:])
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32), off


def sketches(cps: np.ndarray, off: np.ndarray, k: int = K, s: int = S, keep: int = KEEP, sparse: int = SPARSE) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per document its `keep` least distinct anchors, or a `sparse`-th of them all if that is more: (hashes ascending,
    position of each one's first occurrence)."""
    at, h = _anchors(cps, off, k, s)
    doc = np.searchsorted(off, at, "right") - 1
    at = at - off[doc]
    order = np.lexsort((at, h, doc))
    doc, h, at = doc[order], h[order], at[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    doc, h, at = doc[first], h[first], at[first]
    begin = np.searchsorted(doc, np.arange(len(off)))
    out = []
    for i in range(len(off) - 1):
        a, b = begin[i], min(begin[i + 1], begin[i] + max(keep, (begin[i + 1] - begin[i]) // sparse))
        if a == b and off[i + 1] > off[i]:  # shorter than an anchor: the whole text is one
            whole = hashlib.blake2b(cps[off[i] : off[i + 1]].tobytes(), digest_size=8).digest()
            out.append((np.frombuffer(whole, np.uint64), np.zeros(1, np.int64)))
        else:
            out.append((h[a:b], at[a:b]))
    return out


def as_text(sketch: tuple[np.ndarray, np.ndarray]) -> str:
    """16 hexadecimal digits of hash and 8 of position for each anchor, by ascending hash."""
    return "".join([f"{h:016x}{p:08x}" for h, p in zip(sketch[0].tolist(), sketch[1].tolist())])


def from_text(s: str) -> tuple[np.ndarray, np.ndarray]:
    parts = [s[i : i + 24] for i in range(0, len(s), 24)]
    return np.array([int(p[:16], 16) for p in parts], np.uint64), np.array([int(p[16:], 16) for p in parts], np.int64)


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], keep: int = KEEP) -> float:
    """Share of the least anchors of the two fingerprints together that both have at one offset (the most frequent
    difference of positions); 1 if both are empty, 0 if one is. As many anchors count as the shorter fingerprint keeps, `keep`
    at least: so many of either text are surely known."""
    if not len(a[0]) or not len(b[0]):
        return float(len(a[0]) == len(b[0]))
    union = np.union1d(a[0], b[0])[: max(keep, min(len(a[0]), len(b[0])))]
    common, i, j = np.intersect1d(a[0], b[0], True, return_indices=True)
    ok = common <= union[-1]
    if not ok.any():
        return 0.0
    _, n = np.unique(a[1][i[ok]] - b[1][j[ok]], return_counts=True)
    return float(n.max() / len(union))


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs' rows as (doc_id, n_chars, fingerprint); a map. Null text is empty; an empty text's fingerprint is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, text):
                texts = [t or "" for t in b.column(text).to_pylist()]
                got = sketches(*_utf32(texts))
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array([as_text(g) for g in got], pa.string())], names=["doc_id", "n_chars", "fingerprint"])

    return docs.select("doc_id", text).mapInArrow(tidied(run), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_chars bigint, fingerprint string")


def edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def next_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """Rows (slot, place, doc_id, h, text) such that, sorted within a partition by slot, place, doc_id and h, each row of
    place 0 is followed by its next document's row; a row of place 1 closes a slot with the first row of the next one. In
    the slots below 0 are the rows without doc_id, and the row of place -1 is the next document of all of them.

    Slots are ranges of doc_id (some per shuffle partition). Their bounds are any numbers, compared as exact integers; their
    first rows are found by an aggregation, so that no id's size matters. The driver holds a few numbers for each slot; each
    row is shuffled once, and one row per slot twice."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    d = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    low, high, missing = d.agg(F.min("doc_id"), F.max("doc_id"), F.count_if(F.col("doc_id").isNull())).first()
    bounds = np.zeros(0, np.int64)
    if low is not None and low < high:
        wide = high - low >= 1 << 62  # a difference might overflow: halves are near enough for a quantile
        x = (F.floor(F.col("doc_id") / 2).cast("double") - float(low // 2)) * 2 if wide else (F.col("doc_id") - F.lit(low)).cast("double")
        q = d.where("doc_id is not null").select(x.alias("x")).approxQuantile("x", [i / (parts * SLOTS) for i in range(1, parts * SLOTS)], 0.25 / (parts * SLOTS))
        bounds = np.array(sorted({b for v in q if low < (b := low + int(v)) <= high}), np.int64)

    @F.pandas_udf("int")
    def slot_of(ids):
        # the number of bounds that are not above an id
        return pd.Series(np.searchsorted(bounds, ids.to_numpy(), "right").astype(np.int32))

    # rows without id go to slots of their own by hash; a column with nulls would cross as doubles
    lone = F.when(F.col("doc_id").isNull(), -1 - F.pmod("h", F.lit(parts * SLOTS)).cast("int"))
    known = slot_of(F.coalesce("doc_id", F.lit(0)))
    d = d.withColumn("slot", F.coalesce(lone, known) if missing else known).withColumn("place", F.lit(0))
    firsts = [(r.slot, r.f.doc_id, r.f.h) for r in d.where("doc_id is not null").groupBy("slot").agg(F.min(F.struct("doc_id", "h")).alias("f")).orderBy("slot").collect()]
    closing = [(s, 1, i, h) for (s, _, _), (_, i, h) in zip(firsts, firsts[1:] + firsts[:1])]
    if missing and firsts:
        closing += [(-1 - k, -1, *firsts[0][1:]) for k in range(parts * SLOTS)]
    close = spark.createDataFrame(closing, "to_slot int, to_place int, at_id bigint, at_h bigint")
    extra = d.join(F.broadcast(close), (F.col("doc_id") == F.col("at_id")) & (F.col("h") == F.col("at_h"))).select(F.col("to_slot").alias("slot"), F.col("to_place").alias("place"), "doc_id", "h", "text").dropDuplicates(["slot", "place"])
    return d.select("slot", "place", "doc_id", "h", "text").unionByName(extra).repartition(parts, "slot").sortWithinPartitions("slot", "place", "doc_id", "h")


def with_edits(docs: DataFrame, text: str = "text") -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document follows by ascending doc_id (by a hash of the text among repeated ids); after the last comes the first,
    and a lone document follows itself. Null text is empty. Rows without doc_id have no place in the order: each is followed
    by the first document, or by itself if no row has an id. Rows that share a doc_id are one task's. Other columns are
    ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None  # a row whose next document comes with the next batch
        lead = None  # (slot, text): what follows the rows without id of that slot
        todo: list[tuple] = []  # (id, text, next text)
        size = 0

        def flush() -> pa.RecordBatch:
            texts, nexts = [t for _, t, _ in todo], [n for _, _, n in todo]
            once = {id(t): t for t in texts + nexts}  # a next document is most often a row too
            of = dict(zip(once, sketches(*_utf32(list(once.values())))))
            own, following = [of[id(t)] for t in texts], [of[id(t)] for t in nexts]
            new = [edited(t, n) for t, n in zip(texts, nexts)]
            changed = sketches(*_utf32(new))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([i for i, _, _ in todo], pa.int64()),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in new], pa.string()),
                    pa.array([as_text(s) for s in own], pa.string()),
                    pa.array([as_text(c) for c in changed], pa.string()),
                    pa.array([likeness(a, c) for a, c in zip(own, changed)], pa.float64()),
                    pa.array([likeness(a, b) for a, b in zip(own, following)], pa.float64()),
                ],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

        for whole in batches:
            for b in slices(whole, "text", 1 << 20):
                for slot, place, i, body in zip(*(b.column(c).to_pylist() for c in ("slot", "place", "doc_id", "text"))):
                    if place < 0:
                        lead = (slot, body)
                        continue
                    if i is None:
                        todo.append((None, body, lead[1] if lead and lead[0] == slot else body))
                    elif waiting is not None:
                        todo.append((*waiting, body))
                    size += len(body)
                    waiting = (i, body) if place == 0 and i is not None else None
                if size > 1 << 20 and todo:
                    yield flush()
                    todo, size = [], 0
        if todo:
            yield flush()

    schema = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return next_documents(docs, text).mapInArrow(tidied(run), schema)


def op10_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_edits(table(spark, sf_dir, "documents"))
