"""Listing and lookup in the store."""

from __future__ import annotations

import xml.etree.ElementTree as ET

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.arrow import small_batches

MODES = ("abstracts", "fulltext", "all")


def listing(abstracts: DataFrame, fulltext: DataFrame) -> DataFrame:
    """(type, pmid, hash, updated, file_index): bodies aren't read; full texts have file index -1."""
    a = abstracts.select(F.lit("abstract").alias("type"), "pmid", "hash", "updated", F.col("file_index").cast("bigint").alias("file_index"))
    f = fulltext.select(F.lit("fulltext").alias("type"), "pmid", "hash", "updated", F.lit(-1).cast("bigint").alias("file_index"))
    return a.unionByName(f)


def sorted_listing(abstracts: DataFrame, fulltext: DataFrame) -> DataFrame:
    return listing(abstracts, fulltext).orderBy("type", "pmid")


def retrieve(ids: DataFrame, abstracts: DataFrame, fulltext: DataFrame, mode: str = "all") -> tuple[DataFrame, DataFrame]:
    """((ord, pmid, kind, body, infons), (ord, pmid) of those missing). ids: (ord, pmid), in request order with repeats.

    Stores: (pmid, body, infons). A full text takes its abstract's infons where there is one. Spark broadcasts the
    ids' side if it is small enough."""
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}")
    a = abstracts.select("pmid", F.struct("body", "infons").alias("a"))
    f = fulltext.select("pmid", F.struct("body", "infons").alias("f"))
    both = ids.join(a, "pmid", "left").join(f, "pmid", "left")
    full = F.when(F.col("f").isNotNull(), F.struct(F.lit("fulltext").alias("kind"), F.col("f.body").alias("body"), F.coalesce("a.infons", "f.infons").alias("infons")))
    abstract = F.when(F.col("a").isNotNull(), F.struct(F.lit("abstract").alias("kind"), F.col("a.body").alias("body"), F.col("a.infons").alias("infons")))
    pick = {"abstracts": abstract, "fulltext": full, "all": F.coalesce(full, abstract)}[mode]
    got = both.select("ord", "pmid", pick.alias("r"))
    return got.where("r is not null").select("ord", "pmid", "r.*"), got.where("r is null").select("ord", "pmid")


@F.arrow_udf(T.StringType())
def _overridden(fulltext: pa.Array, abstract: pa.Array) -> pa.Array:
    out = []
    for full, source in zip(fulltext.to_pylist(), abstract.to_pylist()):
        if full is None or source is None:
            out.append(full)
            continue
        root = ET.fromstring(full)
        if not len(root) or root[0].tag != "id":
            raise ValueError(f"the first part of a document is its id, not {full[:80]!r}")
        for infon in root.findall("./infon"):
            root.remove(infon)
        for k, infon in enumerate(ET.fromstring(source).findall("./infon"), 1):
            infon.tail = None
            root.insert(k, infon)
        out.append(ET.tostring(root, encoding="unicode", short_empty_elements=False))
    return pa.array(out, pa.string())


def overridden(fulltext: Column, abstract: Column) -> Column:
    """A full text's document XML with its own direct infons taken out and those of the abstract's document, in order, put after its
    id. Without an abstract the full text as it is, to the byte; without a full text null. A document that doesn't begin with
    its id raises."""
    small_batches()
    return F.when(fulltext.isNotNull() & abstract.isNotNull(), _overridden(fulltext, abstract)).otherwise(fulltext)


def documents(ids: DataFrame, rows: DataFrame, mode: str = "all") -> tuple[DataFrame, DataFrame]:
    """((ord, pmid, kind, body), (ord, pmid) of those missing) of ids (ord, pmid), from a store's rows (kind, pmid, body): a full
    text carries its abstract's infons (overridden)."""
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}")
    of = lambda kind, name: rows.where(F.col("kind") == kind).select("pmid", F.col("body").alias(name))
    both = ids.join(of("abstract", "a"), "pmid", "left")
    if mode != "abstracts":
        both = both.join(of("fulltext", "f"), "pmid", "left")
    # what is there is told by the bodies as they are: a full text goes to Python once, to be overridden
    there = {"abstracts": "a is not null", "fulltext": "f is not null", "all": "a is not null or f is not null"}[mode]
    missed, both = both.where(f"not ({there})").select("ord", "pmid"), both.where(there)
    if mode != "abstracts":
        both = both.withColumn("f", overridden(F.col("f"), F.col("a")))
    if mode == "abstracts":
        kind, body = F.lit("abstract"), F.col("a")
    elif mode == "fulltext":
        kind, body = F.lit("fulltext"), F.col("f")
    else:
        kind, body = F.when(F.col("f").isNotNull(), "fulltext").otherwise("abstract"), F.coalesce("f", "a")
    return both.select("ord", "pmid", kind.alias("kind"), body.alias("body")), missed


def missing(expected: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    return expected.join(existing.select(key).distinct(), key, "left_anti")


def guard(existing: DataFrame, expected: DataFrame, key: str, what: str = "unexpected") -> DataFrame:
    """existing, but raises, with up to ten offenders, if it has keys that aren't expected."""
    extra = [r[0] for r in missing(existing, expected, key).select(key).distinct().orderBy(key).limit(10).collect()]
    if extra:
        raise ValueError(f"{what}: {', '.join(map(str, extra))}")
    return existing


def collection(docs: DataFrame, body: str = "body", order: str = "ord") -> str:
    """A retrieved collection as one XML text (for a requested list of ids, streamed to the driver in order)."""
    head = '<?xml version="1.0" encoding="UTF-8"?>\n<!DOCTYPE collection SYSTEM "BioC.dtd">\n<collection>\n'
    return head + "".join(f"{r[0]}\n" for r in docs.orderBy(order).select(body).toLocalIterator()) + "</collection>\n"


def pretty(xml: str) -> str:
    root = ET.fromstring(xml)
    ET.indent(root)
    return ET.tostring(root, encoding="unicode")
