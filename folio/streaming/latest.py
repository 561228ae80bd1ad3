"""Late updates as keyed state: hash and time of each document, and of each batch only what it changes."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.versions import TIMES
from ..sources import store

#: A version of a document; ord tells the order of those of one batch.
VERSION = "kind string, pmid bigint, body string, hash bigint, updated bigint, file_index bigint, ord string"
#: Groups of documents that have their state in one value, for each kind. A group's documents are folded side by side.
GROUPS = 1024
_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def fold(before: tuple[np.ndarray, np.ndarray, np.ndarray], pmid: np.ndarray, hashes: np.ndarray, times: np.ndarray) -> tuple[tuple, np.ndarray]:
    """((pmid, hash, time) of what stands, by pmid; the rows that came to stand) of what stood and of versions in their order. The
    first versions of all documents are taken at once, then all second ones, and so on."""
    ids, at = np.unique(np.concatenate([before[0], pmid]), return_inverse=True)
    known, old, new = np.zeros(len(ids), bool), at[: len(before[0])], at[len(before[0]) :]
    h, t, won = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64), np.full(len(ids), -1)
    known[old], h[old], t[old] = True, before[1], before[2]
    rows = np.argsort(new, kind="stable")
    begins = np.flatnonzero(np.r_[True, np.diff(new[rows]) != 0])
    turn = np.arange(len(rows)) - np.repeat(begins, np.diff(np.r_[begins, len(rows)]))
    turns = rows[np.argsort(turn, kind="stable")]
    for r in np.split(turns, np.cumsum(np.bincount(turn))[:-1]):
        k = new[r]
        late, newer, same = times[r] < t[k], times[r] > t[k], hashes[r] == h[k]
        r = r[~(known[k] & (late & ~same | newer & same))]
        k = new[r]
        known[k], h[k], t[k], won[k] = True, hashes[r], times[r], r
    return (ids, h, t), np.sort(won[won >= 0])


class Latest(StatefulProcessor):
    """Folds the versions of each (kind, pmid) in the order they come: a version that is late and different, or newer but the same, is
    left out. State is the hash and the time of the version that stands, of all documents of a group. A batch gives of each document
    the version that stands after it, if it isn't the one that stood before."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.stand = handle.getValueState("stand", "pmid binary, hash binary, time binary")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        new = pd.concat(rows).sort_values("ord", kind="stable")
        time = TIMES["fulltext" if key[0] == "fulltext" else "abstract"]
        old = self.stand.get() if self.stand.exists() else (b"", b"", b"")
        stands, won = fold(tuple(np.frombuffer(x, np.int64) for x in old), *(new[c].to_numpy(np.int64) for c in ("pmid", "hash", time)))
        if len(won):
            self.stand.update(tuple(x.tobytes() for x in stands))
            yield new.iloc[won].drop(columns=["ord", "group_"])


def changes(versions: DataFrame) -> DataFrame:
    """A stream of VERSION rows to the stream of rows that a store has to take over."""
    versions.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", _PROVIDER)
    out = VERSION.rpartition(",")[0]
    grouped = versions.withColumn("group_", F.pmod(F.xxhash64("pmid"), F.lit(GROUPS)).cast("int")).groupBy("kind", "group_")
    return grouped.transformWithStateInPandas(statefulProcessor=Latest(), outputStructType=out, outputMode="Update", timeMode="None")


def ingest(spark: SparkSession, source: str, schema, path: str, checkpoint: str, prepare: Callable[[DataFrame], DataFrame], files_per_batch: int = 1, buckets: int = store.BUCKETS) -> None:
    """Streams the Parquet files at source that weren't yet seen into the bucketed store at path (availableNow). prepare gives VERSION
    rows. Each batch writes the buckets of the documents it changes; one that runs again after a failure writes the same."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)

    def take(batch: DataFrame, _: int) -> None:
        batch.persist()  # of one batch: it is read for its buckets and for its rows
        store.change(batch.sparkSession, path, [batch], buckets, fold=False)
        batch.unpersist()

    q = changes(prepare(stream)).writeStream.outputMode("update").foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
