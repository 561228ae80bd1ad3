"""Documents with the annotations that a mention table gives them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import sums_before
from . import align

#: An annotation of a document: infons type and conceptid, the text it covers, and where that is in the document.
ANNOTATION = "struct<id:string,infons:map<string,string>,text:string,locations:array<struct<offset:bigint,length:bigint>>>"


def before(counts: DataFrame, file: str, *order: str, n: str = "n") -> DataFrame:
    """counts with `before`, the sum of n over the rows of the file that come earlier. order: a block, then what orders rows
    within it. Sums of blocks come first, so that a window holds the rows of one block, or one row a block of a file."""
    block = order[0]
    w = Window.partitionBy(file).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    blocks = counts.groupBy(file, block).agg(F.sum(n).alias("sum_")).withColumn("base_", F.coalesce(F.sum("sum_").over(w), F.lit(0)))
    blocks = blocks.select(F.col(file).alias("f_"), F.col(block).alias("b_"), "base_")
    w = Window.partitionBy(file, block).orderBy(*order[1:]).rowsBetween(Window.unboundedPreceding, -1)
    inner = counts.withColumn("inner_", F.coalesce(F.sum(n).over(w), F.lit(0)))
    both = inner.join(blocks, inner[file].eqNullSafe(blocks["f_"]) & inner[block].eqNullSafe(blocks["b_"]))
    return both.withColumn("before", (F.col("base_") + F.col("inner_")).cast("bigint")).drop("f_", "b_", "base_", "inner_")


def annotated(docs: DataFrame, mentions: DataFrame, pmid: str = "pmid") -> DataFrame:
    """docs with passages of (infons, offset, text, annotations): for a document whose infon pmid is a number, per passage the
    longest spans of its mentions that don't touch; annotations it had are dropped.

    docs: (file, block, pos, id, infons, passages); (file, block, pos) names a document and orders those of a file. Ids count
    T1, T2, ... through each file: by document, passage, then the longest span first (the later of equals), then type. A span that
    several concepts of one type have is one annotation with the concepts sorted and joined by ';'. Documents of one pmid each
    get the annotations; those without a pmid get none."""
    number = F.expr(f"try_cast(infons['{pmid}'] as bigint)")
    key = ["file", "block", "pos"]
    rows = docs.where(number.isNotNull()).select(*key, number.alias("pmid"), F.posexplode("passages").alias("passage_idx", "p")).select(*key, "pmid", "passage_idx", F.col("p.text").alias("text"))
    longest = F.transform("hits", lambda h: F.struct((h["start"] - h["end"]).alias("least"), (-h["start"]).alias("later"), h["type"].alias("type"), h["start"].alias("start"), h["end"].alias("end"), h["conceptid"].alias("conceptid")))
    per = align.chosen(rows, mentions, *key).select(*key, "passage_idx", F.array_sort(longest).alias("hits"))
    one = per.groupBy(*key).agg(F.sum(F.size("hits")).alias("n"), F.map_from_entries(F.collect_list(F.struct("passage_idx", "hits"))).alias("by"))
    one = before(one, *key)
    d = docs.alias("d").join(one.alias("o"), [F.col(f"d.{k}").eqNullSafe(F.col(f"o.{k}")) for k in key], "left").select("d.*", F.col("o.by").alias("by_"), F.col("o.before").alias("before_"))
    hits = lambda i: F.coalesce(F.try_element_at("by_", i), F.array().cast(per.schema["hits"].dataType))
    d = d.withColumn("firsts_", sums_before(F.transform("passages", lambda p, i: F.size(hits(i)).cast("bigint"))))

    def passage(p, i):
        first = F.col("before_") + F.get("firsts_", i)
        notes = F.transform(hits(i), lambda h, k: F.struct(
            F.concat(F.lit("T"), (first + k + 1).cast("string")).alias("id"),
            F.create_map(F.lit("type"), h["type"], F.lit("conceptid"), h["conceptid"]).alias("infons"),
            p["text"].substr(h["start"] + 1, h["end"] - h["start"]).alias("text"),
            F.array(F.struct((p["offset"] + h["start"]).cast("bigint").alias("offset"), (h["end"] - h["start"]).cast("bigint").alias("length"))).alias("locations"),
        ))
        return F.struct(p["infons"].alias("infons"), p["offset"].cast("bigint").alias("offset"), p["text"].alias("text"), notes.cast(f"array<{ANNOTATION}>").alias("annotations"))

    return d.withColumn("passages", F.transform("passages", passage)).drop("by_", "before_", "firsts_")
