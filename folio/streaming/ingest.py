"""Incremental ingestion: file streams folded into the store batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.versions import merge_exact


def ingest_versions(spark: SparkSession, source: str, schema, store: str, checkpoint: str, prepare, files_per_batch: int = 1) -> DataFrame:
    """Streams Parquet files once (availableNow) into the store, in file order, and returns it.

    prepare(batch) gives (pmid, input_ord, time, hash). Each micro-batch is folded on top of the stored winners; a batch is
    written under its own number and read back by it, so a batch that runs again after a failure gives the same store."""

    def fold(batch: DataFrame, number: int) -> None:
        new = prepare(batch).select("pmid", "input_ord", "time", "hash")
        if number:
            new = spark.read.parquet(f"{store}/batch={number - 1}").select("pmid", "input_ord", "time", "hash").unionByName(new)
        merge_exact(new).write.mode("overwrite").parquet(f"{store}/batch={number}")
        if number > 1:  # the batch before is kept: this one may run again
            at = spark._jvm.org.apache.hadoop.fs.Path(f"{store}/batch={number - 2}")
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    q = stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    last = spark.read.option("basePath", store).parquet(store).agg(F.max("batch")).first()[0]
    return spark.read.parquet(f"{store}/batch={last}")
