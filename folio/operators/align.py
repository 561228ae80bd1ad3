"""Alignment of an external mention table to passages."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.spans import chosen_only, concept_list, find_spans, first_word, mention_pattern, words_of


def patterns(mentions: DataFrame, passages: DataFrame) -> DataFrame:
    """(pmid, type, conceptid, pattern, word) of the mentions of documents at hand; one row for each mention, its pattern made once;
    word: spans.first_word."""
    wanted = mentions.where("mentions <> ''").join(passages.select("pmid").distinct(), "pmid", "left_semi")
    each = wanted.select("pmid", "type", "conceptid", F.explode(F.filter(F.transform(F.split("mentions", r"\|"), lambda m: F.trim(m)), lambda m: m != "")).alias("mention"))
    return each.distinct().select("pmid", "type", "conceptid", mention_pattern(F.col("mention")).alias("pattern"), first_word(F.col("mention")).alias("word"))


def candidates(passages: DataFrame, mentions: DataFrame, *document: str) -> DataFrame:
    """(pmid, document columns, passage_idx, start, end, type, conceptid) of all matches.

    Passages and mentions meet by a word: each passage gives the hashes of its distinct words, a mention that of its first one (of ''
    for a mention without a word, which meets all passages of its pmid). A passage is matched only with the mentions it met, in its own row, so a text
    isn't copied for each of them. Documents with very many mentions are skewed keys that Spark splits in the joins."""
    keys = ["pmid", *document, "passage_idx"]
    words = passages.select(*keys, F.explode(F.array_union(words_of(F.col("text")), F.array(F.xxhash64(F.lit(""))))).alias("word"))
    met = words.join(patterns(mentions, passages), ["pmid", "word"]).groupBy(*keys).agg(F.collect_set(F.struct("pattern", "type", "conceptid")).alias("ms"))
    rows = passages.alias("p").join(met.alias("m"), [F.col(f"p.{k}").eqNullSafe(F.col(f"m.{k}")) if k in document else F.col(f"p.{k}") == F.col(f"m.{k}") for k in keys])
    found = F.flatten(F.transform("ms", lambda m: F.transform(find_spans(F.col("p.text"), m["pattern"]), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), m["type"].alias("type"), m["conceptid"].alias("conceptid")))))
    return rows.select(*[f"p.{k}" for k in keys], F.explode(F.array_distinct(found)).alias("s")).select(*keys, "s.start", "s.end", "s.type", "s.conceptid")


def chosen(passages: DataFrame, mentions: DataFrame, *document: str) -> DataFrame:
    """(pmid, document columns, passage_idx, hits) of passages that have some: the longest spans that don't touch, a struct (start, end, type,
    conceptid) for each span and type, concepts joined; by start, end and type."""
    keys = ["pmid", *document, "passage_idx"]
    hits = candidates(passages, mentions, *document)
    concepts = hits.groupBy(*keys, "start", "end", "type").agg(concept_list(F.col("conceptid")).alias("conceptid"))
    per = concepts.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("start", "end", "type", "conceptid"))).alias("hits"))
    return per.select(*keys, chosen_only(F.col("hits")).alias("hits"))


def align(passages: DataFrame, mentions: DataFrame) -> DataFrame:
    """(pmid, passage_idx, ann_id, type, conceptid, text, offset, length): per passage the longest spans that don't touch, one
    annotation for each span and type with its concepts joined. passages: (pmid, passage_idx, text, offset)."""
    rows = chosen(passages, mentions).select("pmid", "passage_idx", F.posexplode("hits").alias("k", "h"))
    rows = rows.join(passages.select("pmid", "passage_idx", "text", "offset"), ["pmid", "passage_idx"])
    return rows.select(
        "pmid", "passage_idx", F.concat(F.lit("T"), F.col("passage_idx") + 1, F.lit("."), F.col("k") + 1).alias("ann_id"), F.col("h.type").alias("type"), F.col("h.conceptid").alias("conceptid"),
        F.col("text").substr(F.col("h.start") + 1, F.col("h.end") - F.col("h.start")).alias("text"), (F.col("offset") + F.col("h.start")).cast("bigint").alias("offset"), (F.col("h.end") - F.col("h.start")).cast("bigint").alias("length"),
    )


def numbered(annotations: DataFrame, *order: str) -> DataFrame:
    """Adds ann_no, counting over all rows in order from 1: ranges of rows, numbers within each, and the sum of the ranges before,
    never one partition. The ranges are sampled, so they are fixed by a checkpoint before they are read twice; what goes to the
    driver is a count for each range."""
    spark = annotations.sparkSession
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    a = checkpointed(annotations.repartitionByRange(spread, *order).withColumn("p_", F.spark_partition_id()))
    counts = {r.p_: r["count"] for r in a.groupBy("p_").count().collect()}
    before, total = [], 0
    for p in sorted(counts):
        before.append((p, total))
        total += counts[p]
    a = a.withColumn("k_", F.row_number().over(Window.partitionBy("p_").orderBy(*order)))
    return a.join(F.broadcast(spark.createDataFrame(before, "p_ int, b_ bigint")), "p_").withColumn("ann_no", F.col("k_") + F.col("b_")).drop("p_", "k_", "b_")


def checkpointed(df: DataFrame) -> DataFrame:
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        at = sc.getConf().get("spark.checkpoint.dir")
        if not at:
            if not sc.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
            at = tempfile.mkdtemp(prefix="folio-checkpoint-")
        sc.setCheckpointDir(at)
    return df.checkpoint()
