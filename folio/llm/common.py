"""Shared helpers: shared folder, arrow slicing, vectorised word hashing."""

from __future__ import annotations

import sys
import uuid
import weakref
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most bytes of text that one vectorised step works on (a longer text is a step of its own).
SLICE_BYTES = 1 << 20
#: Most bytes of an Arrow batch between Spark and a worker.
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 | 1)
_INV = _U(pow(int(_BASE), -1, 1 << 64))
_BYTE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers: dict[str, np.ndarray] = {}
_paths: dict[int, tuple] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; set only where the session names none."""
    sc = spark.sparkContext
    at = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        got = sc._jsc.sc().getCheckpointDir()
        if got.isDefined():
            return got.get()
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
        import tempfile

        at = tempfile.mkdtemp(prefix="folio-checkpoint-")
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(at)
    return at


def written(df: DataFrame, *partition_by: str) -> DataFrame:
    """Cuts the lineage: writes df to the shared folder and reads it again. Survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/folio-{uuid.uuid4().hex}"
    w = df.write.option("compression", "zstd")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)  # at the session's end, if not by removed()
    out = spark.read.schema(df.schema).parquet(path)
    _paths[id(out)] = (weakref.ref(out, lambda _, k=id(out): _paths.pop(k, None)), path)
    return out


def removed(df: DataFrame) -> None:
    """Deletes the folder of a DataFrame of written(), once nothing reads it any more."""
    _, path = _paths.pop(id(df))
    spark = df.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def tidied(run):
    """A task's generator that, when it ends, gives the memory that its worker no longer needs back to the system: workers
    go on to other tasks, and what one stage took would otherwise stay theirs. Batches that come to it are of BATCH_BYTES at
    most, or one row: the session's setting is lowered if it is Spark's own."""
    spark = SparkSession.getActiveSession()
    if spark is not None and spark.conf.get(_BATCH) in ("67108864b", "64m", "64MB"):
        spark.conf.set(_BATCH, str(BATCH_BYTES))

    def tidy(batches):
        try:
            yield from run(batches)
        finally:
            import ctypes

            pa.default_memory_pool().release_unused()
            if sys.platform == "linux":
                ctypes.CDLL(None).malloc_trim(0)

    return tidy


def sampled(df: DataFrame, rows: int, *key: str) -> DataFrame:
    """About `rows` rows of df (all, if it has fewer), those with the least hashes of `key`: a filter, so that no task gets
    more than its share however many partitions there are. Rows alike in `key` are in or out together."""
    n = df.count()
    return df if n <= rows else df.where(F.pmod(F.xxhash64(*key), F.lit(1 << 40)) < int((1 << 40) * rows / n))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(col: str, n: int):
    return F.pmod(F.crc32(F.coalesce(F.col(col).cast("string"), F.lit(""))), F.lit(n))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that don't clash with df's."""
    have, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in have:
            n += "_"
        have.add(n.lower())
        out.append(n)
    return out


def slices(batch: pa.RecordBatch, text: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts a batch into runs of rows of at most `most` bytes of text, or one row."""
    n = batch.num_rows
    if not n:
        return
    off = _offsets(batch.column(text))[0]
    at = 0
    while at < n:
        end = int(np.searchsorted(off, off[at] + most, "right")) - 1
        end = min(max(end, at + 1), n)
        yield batch.slice(at, end - at)
        at = end


def _offsets(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string array; nulls have length 0."""
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off, data = col.buffers()
    if not len(col):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    o = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return o - o[0], raw[o[0] : o[-1]]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least n powers of the base and of its inverse; tables of a step's size are kept, longer ones aren't."""
    size = max(n, SLICE_BYTES + 1)
    if n <= SLICE_BYTES + 1 and _powers:
        return _powers["up"], _powers["down"]
    got = []
    for b in (_BASE, _INV):
        p = np.full(size, b, np.uint64)
        p[0] = 1
        got.append(np.cumprod(p))
    if size == SLICE_BYTES + 1:
        _powers["up"], _powers["down"] = got
    return got[0], got[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Words:
    """Words of a string array: bytes between separators (space, 0x09-0x0D), A-Z lower-cased.

    start, end: byte spans in `data`; per_doc: words of each row; first: index of each row's first word
    (one more entry than rows); hash: 64 bits of each word."""

    def __init__(self, col: pa.Array):
        off, raw = _offsets(col)
        self.off = off
        self.data = data = _LOWER[raw]
        n = len(data)
        word = ~_SPACE[data]
        before = np.empty(n, bool)
        after = np.empty(n, bool)
        if n:
            before[0], before[1:] = False, word[:-1]
            after[-1], after[:-1] = False, word[1:]
            inner = off[(off > 0) & (off < n)]
            before[inner] = False
            after[inner - 1] = False
        self.start = np.flatnonzero(word & ~before)
        self.end = np.flatnonzero(word & ~after) + 1
        self.first = np.searchsorted(self.start, off)
        self.per_doc = np.diff(self.first)
        up, down = powers(n)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[data] * up[:n], out=total[1:])
        self.hash = mix((total[self.end] - total[self.start]) * down[self.start]) if len(self.start) else np.zeros(0, np.uint64)

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.per_doc)), self.per_doc)


_STEP = [_U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]


def shingles(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of all k-word shingles; a row of 1..k-1 words has its whole sequence as one."""
    per = np.diff(first)
    n = len(hashes)
    out = np.zeros(max(n - k + 1, 0), np.uint64)
    for j in range(k):
        out += mix(hashes[j : n - k + 1 + j] * _STEP[j] + _U(j + 1)) if len(out) else 0
    row = np.repeat(np.arange(len(per)), np.maximum(per - k + 1, 0))
    keep = np.repeat(first[:-1], np.maximum(per - k + 1, 0)) + _ramp(np.maximum(per - k + 1, 0))
    h = mix(out[keep])
    few = np.flatnonzero((per > 0) & (per < k))
    if len(few):
        short = np.array([_short(hashes[first[r] : first[r + 1]]) for r in few], np.uint64)
        h, row = np.concatenate([h, short]), np.concatenate([row, few])
    return h, row


def _short(x: np.ndarray) -> int:
    total = mix(x * np.array(_STEP[: len(x)]) + np.arange(1, len(x) + 1, dtype=np.uint64)).sum(dtype=np.uint64)
    return int(mix(np.array([(int(total) + len(x) * 0x5851F42D4C957F2D) & (2**64 - 1)], np.uint64))[0])


def _ramp(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each count."""
    total = int(counts.sum())
    return np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)


ramp = _ramp


def sets(h: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each row, ascending, and where each row's begin (rows + 1 entries)."""
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    if len(h):
        keep = np.ones(len(h), bool)
        keep[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
        h, row = h[keep], row[keep]
    return h, np.searchsorted(row, np.arange(rows + 1))
