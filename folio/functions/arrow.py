"""The few functions that Catalyst can't express, by Arrow batches."""

from __future__ import annotations

import gzip
import html

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Most bytes of an Arrow batch between Spark and a worker: a worker holds some of these and what it makes of them.
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession | None = None) -> None:
    """Lowers Spark's own limit of an Arrow batch (64 MB) for the session; another one that was set stays. Whatever hands texts to
    Python calls this where its plan is made."""
    spark = spark or SparkSession.getActiveSession()
    if spark is not None and spark.conf.get(_BATCH) in ("67108864b", "64m", "64MB"):
        spark.conf.set(_BATCH, str(BATCH_BYTES))


@F.pandas_udf(T.StringType())
def _unescape(s: pd.Series) -> pd.Series:
    return s.map(html.unescape, na_action="ignore")


def unescape(col: Column) -> Column:
    """HTML entities; texts without '&' never leave the JVM's value."""
    small_batches()
    return F.when(F.contains(col, F.lit("&")), _unescape(col)).otherwise(col)


@F.pandas_udf(T.BinaryType())
def _gzip(s: pd.Series) -> pd.Series:
    return s.map(lambda x: gzip.compress(x.encode("utf-8"), mtime=0), na_action="ignore")


@F.pandas_udf(T.StringType())
def _gunzip(s: pd.Series) -> pd.Series:
    return s.map(lambda x: gzip.decompress(x).decode("utf-8"), na_action="ignore")


def gzip_text(col: Column) -> Column:
    small_batches()
    return _gzip(col)


def gunzip_text(col: Column) -> Column:
    small_batches()
    return _gunzip(col)


#: Types are objects: a DDL string needs a session, and importing this doesn't.
_NOTES = T.ArrayType(T.StructType().add("id", T.StringType()).add("citation_text", T.StringType()).add("offset", T.IntegerType()))


@F.pandas_udf(T.StructType().add("text", T.StringType()).add("annotations", _NOTES))
def _strip(text: pd.Series, markers: pd.Series) -> pd.DataFrame:
    from ..operators.citations import strip_markers

    got = [strip_markers(t, dict(m) if m is not None else {}) if t is not None else (None, None) for t, m in zip(text, markers)]
    return pd.DataFrame({"text": [g[0] for g in got], "annotations": [None if g[1] is None else [{"id": i, "citation_text": c, "offset": o} for i, c, o in g[1]] for g in got]})


def strip_citations(text: Column, markers: Column) -> Column:
    """(text without markers, zero-length annotations at their places); markers: map<id, citation text>."""
    small_batches()
    return _strip(text, markers)
