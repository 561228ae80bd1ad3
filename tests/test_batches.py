"""What goes to Python goes in small batches, whatever the size of the input."""

import pytest
from pyspark.sql import functions as F

from folio.functions import arrow, spans, tables
from folio.operators import articles, retrieve
from folio.sources import sinks

BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def xml_of(spark):
    return spark.range(3).select(F.lit("<article/>").alias("xml"))


BY_NAME = {
    "unescape": lambda spark: arrow.unescape(F.col("x")),
    "gzip_text": lambda spark: arrow.gzip_text(F.col("x")),
    "gunzip_text": lambda spark: arrow.gunzip_text(F.col("x")),
    "strip_citations": lambda spark: arrow.strip_citations(F.col("x"), F.col("m")),
    "choose_spans": lambda spark: spans.choose_spans(F.col("s")),
    "chosen_only": lambda spark: spans.chosen_only(F.col("s")),
    "register": tables.register,
    "overridden": lambda spark: retrieve.overridden(F.col("f"), F.col("a")),
    "fulltexts": lambda spark: articles.fulltexts(xml_of(spark)),
    "citations": lambda spark: articles.citations(xml_of(spark)),
    "bioc_document": lambda spark: sinks.bioc_document("id", "infons", "passages"),
}


@pytest.mark.parametrize("name", BY_NAME)
def test_limit(spark, name):
    spark.conf.unset(BATCH)
    BY_NAME[name](spark)
    assert spark.conf.get(BATCH) == str(arrow.BATCH_BYTES)
    spark.conf.set(BATCH, "1000000")  # another limit that was set stays
    BY_NAME[name](spark)
    assert spark.conf.get(BATCH) == "1000000"
    spark.conf.unset(BATCH)


def test_batches_of_texts(spark):
    """The limit holds for what a worker gets: 40 MB in one task never come as one batch."""
    spark.conf.unset(BATCH)
    size = F.pandas_udf(lambda s: s.map(len) * 0 + s.str.len().sum(), "bigint")
    docs = spark.range(400, numPartitions=1).select(F.repeat(F.lit("x"), 100_000).alias("x"))
    arrow.unescape(F.col("x"))
    assert docs.select(size("x").alias("n")).agg(F.max("n")).first()[0] < 2 * arrow.BATCH_BYTES


def test_overridden_once(spark):
    """A full text goes through Python once."""
    rows = spark.createDataFrame([("fulltext", 1, "<document><id>1</id></document>"), ("abstract", 1, '<document><id>1</id><infon key="k">v</infon></document>'), ("abstract", 2, "<document><id>2</id></document>")], "kind string, pmid bigint, body string")
    ids = spark.createDataFrame([(0, 1), (1, 2), (2, 3)], "ord int, pmid bigint")
    for mode, got, missed in (("fulltext", [1], [2, 3]), ("all", [1, 2], [3]), ("abstracts", [1, 2], [3])):
        there, missing = retrieve.documents(ids, rows, mode)
        assert there._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == (mode != "abstracts")
        assert sorted(r.pmid for r in there.collect()) == got and sorted(r.pmid for r in missing.collect()) == missed
