"""Conversion from one format to another, end to end."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import articles
from ..sources import readers, sinks

OUT = ("biocxml", "txt")
#: Where a record is from: its file, and (block, pos), its place there.
PLACE = ("file", "block", "pos")
FAILED = "can't convert a record of "


def parsed(spark: SparkSession, path: str | list[str], in_format: str, strict: bool = False, **options) -> DataFrame:
    """(file, block, pos, failed, id, infons, passages) of the records at path; failed: why a record gave no document, else null."""
    return parsed_records(readers.open_format(spark, path, in_format), in_format, strict, **options)


def parsed_records(rows: DataFrame, in_format: str, strict: bool = False, **options) -> DataFrame:
    """The same of records (file, block, pos, xml), or, of biocxml, of documents."""
    if in_format == "pubmedxml":
        got = articles.citations(rows, kept=[*PLACE], strict=strict)
        docs, failed = articles.citation_documents(got, kept=[*PLACE, "errors", "pmid"], **options), F.col("pmid").isNull()
    elif in_format == "pmcxml":
        # a file has several articles: their order is that of its rows
        got = articles.fulltexts(rows, kept=[*PLACE], strict=strict, **options).withColumn("pos", F.monotonically_increasing_id())
        docs, failed = articles.fulltext_documents(got, kept=[*PLACE, "errors"]), F.col("passages").isNull()
    else:
        docs, failed = rows.withColumn("errors", F.array(F.lit("no passages"))), F.col("id").isNull() & (F.size("passages") == 0)
    return docs.select(*PLACE, F.when(failed, F.coalesce(F.nullif(F.array_join("errors", "; "), F.lit("")), F.lit("no document"))).alias("failed"), "id", "infons", "passages")


def none_failed(docs: DataFrame) -> DataFrame:
    """docs, but a failed record raises with its file and reason."""
    raised = F.raise_error(F.concat(F.lit(FAILED), F.coalesce("file", F.lit("?")), F.lit(": "), F.col("failed"))).cast("boolean")
    return docs.where(F.when(F.col("failed").isNotNull(), raised).otherwise(True))


def documents(spark: SparkSession, path: str, in_format: str, strict: bool = False, **options) -> DataFrame:
    """(id, infons, passages) of the files at path, without records that fail unless strict, which raises. Options of citations:
    trim (True unless given); of full texts: those of articles.parse_fulltext."""
    return parsed(spark, path, in_format, strict, **options).where("failed is null").select("id", "infons", "passages")


def convert(spark: SparkSession, paths: list[str], in_format: str, out: str, out_format: str, errors: str | None = None, strict: bool = False, **options) -> dict[str, int]:
    """Writes the documents of all paths to the folder `out`; {"read", "failed", "written"}, counted on the way.

    A record that fails raises RuntimeError with its file and reason; with `errors`, a folder, the others are written and the
    failures, (file, block, pos, failed), go there as JSON lines: only if there are some, by a second pass."""
    if out_format not in OUT:
        raise ValueError(f"{out_format} is not one of {'/'.join(OUT)}")
    every = None
    for path in paths:
        one = parsed(spark, path, in_format, strict, **options)
        every = one if every is None else every.unionByName(one)
    if every is None:
        raise ValueError("nothing to convert")
    seen = Observation()
    docs = every.observe(seen, F.count("*").alias("read"), F.count("failed").alias("failed"))
    if errors is None:
        docs = none_failed(docs)
    docs = docs.where("failed is null").select("id", "infons", "passages")
    try:
        (sinks.write_text if out_format == "txt" else sinks.write_bioc)(docs, out)
    except PySparkException as e:
        if FAILED in str(e):
            raise RuntimeError(FAILED + str(e).split(FAILED, 1)[1].splitlines()[0]) from e
        raise
    got = seen.get
    if got["failed"]:
        every.where("failed is not null").select(*PLACE, "failed").write.json(errors)
    return {"read": got["read"], "failed": got["failed"], "written": got["read"] - got["failed"]}


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> None:
    """python -m folio.plans.convert --i FILES --iFormat FORMAT --o FOLDER --oFormat FORMAT [--errors FOLDER] [--strict]"""
    import argparse

    p = argparse.ArgumentParser(description="Converts literature files.")
    p.add_argument("--i", required=True, help="comma-separated paths")
    p.add_argument("--iFormat", required=True, choices=sorted(readers.FORMATS))
    p.add_argument("--o", required=True)
    p.add_argument("--oFormat", required=True, choices=OUT)
    p.add_argument("--errors", help="a folder for records that fail; without it, they raise")
    p.add_argument("--strict", action="store_true", help="raise for whatever is wrong with a record")
    got = p.parse_args(args)
    n = convert(spark or SparkSession.builder.getOrCreate(), got.i.split(","), got.iFormat, got.o, got.oFormat, got.errors, got.strict)
    print(f"read {n['read']}, failed {n['failed']}, written {n['written']}")


if __name__ == "__main__":
    main()
