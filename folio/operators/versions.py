"""The versioned store: dedupe within a file, merge across files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_in_file(docs: DataFrame, file: str = "file", pos: str = "pos", pmid: str = "pmid") -> DataFrame:
    """The first record of each pmid of a file; '', 'None', '0' and null are no pmids."""
    good = docs.where(F.col(pmid).isNotNull() & ~F.col(pmid).cast("string").isin("", "None", "0"))
    w = Window.partitionBy(file, pmid).orderBy(pos)
    return good.withColumn("rn_", F.row_number().over(w)).where("rn_ = 1").drop("rn_")


def rejected(time: Column, hash_: Column, cur_time: Column, cur_hash: Column) -> Column:
    """An incoming version is late and different, or newer but the same."""
    return ((time < cur_time) & (hash_ != cur_hash)) | ((time > cur_time) & (hash_ == cur_hash))


def merge_exact(versions: DataFrame, key: str = "pmid", order: str = "input_ord", time: str = "time", hash_: str = "hash") -> DataFrame:
    """(key, hash, time, input_ord) after folding every key's versions in input order. Only hashes and stamps are shuffled;
    a key's group is its versions. The fold isn't associative, so there is no partial one."""
    one = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(time).alias("t"), F.col(hash_).alias("h"))))
    rows = versions.groupBy(key).agg(one.alias("v"))
    fold = F.aggregate(F.slice("v", 2, F.greatest(F.size("v") - 1, F.lit(0))), F.get("v", F.lit(0)), lambda a, x: F.when(rejected(x["t"], x["h"], a["t"], a["h"]), a).otherwise(x))
    return rows.select(key, fold.alias("w")).select(key, F.col("w.h").alias(hash_), F.col("w.t").alias(time), F.col("w.o").alias(order))


def merge_ordered(versions: DataFrame, key: str = "pmid", order: str = "input_ord", time: str = "time", hash_: str = "hash") -> DataFrame:
    """The same where times don't decrease in input order: the last row, stamped with the start of its run of equal hashes.
    Rows of one time are ties: the last of them wins its stamp as in the fold."""
    w = Window.partitionBy(key).orderBy(order)
    before_h = F.lag(hash_).over(w)
    v = versions.select(key, order, time, hash_).withColumn("new_", before_h.isNull() | (before_h != F.col(hash_)))
    v = v.withColumn("stamp_", F.last(F.when(F.col("new_"), F.col(time)), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    v = v.withColumn("rn_", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order))))
    return v.where("rn_ = 1").select(key, hash_, F.col("stamp_").alias(time))


def upsert(current: DataFrame, incoming: DataFrame, key: str = "pmid", time: str = "updated", hash_: str = "hash") -> DataFrame:
    """current after one input's rows: rejected ones are dropped, the others replace or are added. Two anti joins and a union."""
    if [(f.name, f.dataType) for f in current.schema] != [(f.name, f.dataType) for f in incoming.schema]:
        raise ValueError("schemas differ")
    i, c = incoming.alias("i"), current.select(key, time, hash_).alias("c")
    taken = i.join(c, (F.col(f"i.{key}") == F.col(f"c.{key}")) & rejected(F.col(f"i.{time}"), F.col(f"i.{hash_}"), F.col(f"c.{time}"), F.col(f"c.{hash_}")), "left_anti")
    return current.join(taken.select(key), key, "left_anti").unionByName(taken)


def merge_store(versions: DataFrame, **names) -> DataFrame:
    """Winning rows of a store with bodies, by the exact fold: bodies are joined back after it."""
    key, order = names.get("key", "pmid"), names.get("order", "input_ord")
    return versions.join(merge_exact(versions, **names).select(key, order), [key, order], "left_semi")


#: What tells versions of a kind apart: full texts by their stamp, abstracts by their file (fixed values).
TIMES = {"fulltext": "updated", "abstract": "file_index"}


def winners(versions: DataFrame) -> DataFrame:
    """The rows of (kind, pmid, body, hash, updated, file_index, input_ord) that are left after folding all inputs in order, the
    least input_ord being what is there: of each kind by its own time. Bodies cross once, after the fold."""
    time = F.when(F.col("kind") == "fulltext", F.col(TIMES["fulltext"])).otherwise(F.col(TIMES["abstract"]))
    v = versions.withColumn("key_", F.struct("kind", "pmid")).withColumn("time_", time)
    return merge_store(v, key="key_", time="time_").drop("key_", "time_", "input_ord")


def latest_view(docs: DataFrame, key: str = "pmid", rank: str = "kind_rank", time: str = "time") -> DataFrame:
    """One row for each key: of the highest rank, then the latest."""
    rest = [c for c in docs.columns if c != key]
    return docs.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(rank, time)).alias("w")).select(key, "w.*")
