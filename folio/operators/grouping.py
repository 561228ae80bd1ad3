"""Grouping of archive members into named chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

GROUP = 2000


def group_members(members: DataFrame, n: int = GROUP, src: str = "src", member: str = "member", order: str = "ord") -> DataFrame:
    """(group_name, src, member, ord): groups of n in order, none over two archives; names are base_00, base_01, ... with more
    digits from 100 on."""
    w = Window.partitionBy(src).orderBy(order)
    g = F.floor((F.row_number().over(w) - 1) / n).cast("int")
    base = F.regexp_replace(F.substring_index(src, "/", -1), r"\.tar\.gz$", "")
    return members.select(F.format_string("%s_%02d", base, g).alias("group_name"), src, member, order)


def groupings(grouped: DataFrame, src: str = "src", member: str = "member", order: str = "ord") -> DataFrame:
    """A row for each group with its members in order."""
    sorted_members = F.transform(F.array_sort(F.collect_list(F.struct(order, member))), lambda x: x[member])
    return grouped.groupBy("group_name", src).agg(sorted_members.alias("group"))


def only_xml(listing: DataFrame, name: str = "member", regular: str = "is_file") -> DataFrame:
    return listing.where(F.col(regular) & F.lower(F.regexp_extract(name, r"\.([^./]+)$", 1)).isin("xml", "nxml"))


def not_yet_grouped(archives: DataFrame, done: DataFrame, src: str = "src") -> DataFrame:
    return archives.join(done.select(src).distinct(), src, "left_anti")


def id_index(docs: DataFrame, key: str = "pmid") -> DataFrame:
    """Distinct ids in string order."""
    return docs.select(F.col(key).cast("string").alias(key)).where(F.col(key).isNotNull()).distinct().orderBy(key)
