"""The main store: documents in buckets by key, changed bucket by bucket.

A store is a folder with `data/write=<id>/kind=<kind>/bucket=<n>` and numbered manifests that say which write each bucket is in. A
change reads and writes the buckets that its rows fall in, then puts the next manifest in place by a rename; until then, and if the
change is lost, readers see the last one. One change at a time."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import versions

BUCKETS = 64
COLUMNS = "pmid bigint, body string, hash bigint, updated bigint, file_index bigint"
_READ = f"{COLUMNS}, `write` string, kind string, bucket int"


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _numbers(spark: SparkSession, path: str) -> list[int]:
    fs, at = _fs(spark, f"{path}/_manifest")
    if not fs.exists(at):
        return []
    return sorted(int(n) for s in fs.listStatus(at) if (n := s.getPath().getName()).isdigit())


def exists(spark: SparkSession, path: str) -> bool:
    return bool(_numbers(spark, path))


def manifest(spark: SparkSession, path: str, number: int | None = None) -> dict:
    """{"buckets": how many, "at": {"kind/bucket": write}} of the last change, or of an earlier one that is kept."""
    numbers = _numbers(spark, path)
    if not numbers:
        return {"buckets": BUCKETS, "at": {}}
    fs, at = _fs(spark, f"{path}/_manifest/{(number or numbers[-1]):012d}")
    source = fs.open(at)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8"))
    finally:
        source.close()


def bucket_of(buckets: int):
    return F.pmod(F.xxhash64("pmid"), F.lit(buckets)).cast("int")


def rows(spark: SparkSession, path: str, only: set[tuple[str, int]] | None = None) -> DataFrame:
    """(kind, pmid, body, hash, updated, file_index) of the store, or of some (kind, bucket) of it."""
    at = manifest(spark, path)["at"]
    folders = [f"{path}/data/write={w}/kind={k.rpartition('/')[0]}/bucket={k.rpartition('/')[2]}" for k, w in sorted(at.items()) if only is None or (k.rpartition("/")[0], int(k.rpartition("/")[2])) in only]
    columns = ("kind", "pmid", "body", "hash", "updated", "file_index")
    if not folders:
        return spark.createDataFrame([], _READ).select(*columns)
    return spark.read.option("basePath", f"{path}/data").schema(_READ).parquet(*folders).select(*columns)


def lookup(spark: SparkSession, path: str, ids: DataFrame) -> DataFrame:
    """The store's rows in the buckets of the ids (ord, pmid): what a lookup has to read. The driver gets the numbers of buckets."""
    n = manifest(spark, path)["buckets"]
    touched = {r[0] for r in ids.where("pmid is not null").select(bucket_of(n)).distinct().collect()}
    return rows(spark, path, {(k, b) for k in ("abstract", "fulltext") for b in touched})


def change(spark: SparkSession, path: str, inputs: list[DataFrame], buckets: int = BUCKETS, fold: bool = True) -> dict:
    """Folds inputs, tables of the store's columns in their order, into the store; {"touched": buckets written, "of": buckets}.

    What is there is version 0. A pmid occurs once in an input. Nothing is written where there are no inputs or no rows.
    Without `fold` the inputs, which then have no pmid in common, replace what is there."""
    state = manifest(spark, path)
    buckets = state["buckets"] if state["at"] else buckets
    new = None
    for i, one in enumerate(inputs, 1):
        one = one.select("kind", "pmid", "body", "hash", "updated", "file_index").withColumn("input_ord", F.lit(i))
        new = one if new is None else new.unionByName(one)
    if new is None:
        return {"touched": 0, "of": len(state["at"])}
    touched = {(r.kind, r.bucket) for r in new.select("kind", bucket_of(buckets).alias("bucket")).distinct().collect()}
    if not touched:
        return {"touched": 0, "of": len(state["at"])}
    old = rows(spark, path, touched).withColumn("input_ord", F.lit(0))
    if fold:
        won = versions.winners(old.unionByName(new))
    else:
        won = old.join(new.select("kind", "pmid"), ["kind", "pmid"], "left_anti").unionByName(new).drop("input_ord")
    write = uuid.uuid4().hex
    won.withColumn("bucket", bucket_of(buckets)).repartition("kind", "bucket").write.partitionBy("kind", "bucket").parquet(f"{path}/data/write={write}")
    state = {"buckets": buckets, "at": state["at"] | {f"{k}/{b}": write for k, b in touched}}
    number = (_numbers(spark, path) or [0])[-1] + 1
    fs, at = _fs(spark, f"{path}/_manifest/{number:012d}")
    _, part = _fs(spark, f"{path}/_manifest/{write}.part")
    out = fs.create(part, True)
    out.write(json.dumps(state).encode())
    out.close()
    if not fs.rename(part, at):
        raise OSError(f"the store at {path} was changed meanwhile")
    _tidy(spark, path)
    return {"touched": len(touched), "of": len(state["at"])}


def _tidy(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Deletes manifests but the last ones, and the buckets that none of these names; readers of the one before go on."""
    numbers = _numbers(spark, path)
    named = {(w, k) for n in numbers[-keep:] for k, w in manifest(spark, path, n)["at"].items()}
    before = {(w, k) for n in numbers[:-keep] for k, w in manifest(spark, path, n)["at"].items()}
    for w, k in sorted(before - named):
        kind, _, b = k.rpartition("/")
        fs, at = _fs(spark, f"{path}/data/write={w}/kind={kind}/bucket={b}")
        fs.delete(at, True)
    for n in numbers[:-keep]:
        fs, at = _fs(spark, f"{path}/_manifest/{n:012d}")
        fs.delete(at, False)
