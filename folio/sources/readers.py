"""Readers of citation, full-text and annotation files."""

from __future__ import annotations

import os
import tarfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .. import schema


def raw_records(spark: SparkSession, path: str | list[str], tag: str) -> DataFrame:
    """(file, block, pos, xml) of each <tag ...>...</tag>; gz files are read as they are. Splittable unless compressed.

    block is where the record's split of the file begins, pos grows within it: (block, pos) orders a file's records as they are
    written, however it is split, and no task has to see the whole file for that."""
    end = f"</{tag}>"
    rows = spark.read.option("lineSep", end).text(path)
    rows = rows.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("pos"))
    opened = rows.where(F.col("value").rlike(f"<{tag}[ >]"))
    body = F.regexp_extract("value", rf"(?s).*(<{tag}[ >].*)$", 1)
    return opened.select("file", "block", "pos", F.concat(body, F.lit(end)).alias("xml"))


def citation_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return raw_records(spark, path, "PubmedArticle")


def biocxml(spark: SparkSession, path: str) -> DataFrame:
    """Documents of annotation XML: file, block, pos (as raw_records), id, infons, passages with their annotations."""
    kind = "array<struct<_key:string,_VALUE:string>>"
    note = f"array<struct<_id:string,infon:{kind},location:array<struct<_offset:bigint,_length:bigint>>,text:string>>"
    doc = f"id string, infon {kind}, passage array<struct<infon:{kind},offset:bigint,text:string,annotation:{note}>>"
    rows = raw_records(spark, path, "document")
    rows = rows.withColumn("d", F.from_xml("xml", doc, {"ignoreSurroundingSpaces": "false", "rowTag": "document"}))
    as_map = lambda c: F.map_from_entries(F.transform(F.coalesce(c, F.array().cast(kind)), lambda x: F.struct(x["_key"], F.coalesce(x["_VALUE"], F.lit("")))))
    where = lambda a: F.transform(F.coalesce(a["location"], F.array().cast("array<struct<_offset:bigint,_length:bigint>>")), lambda x: F.struct(x["_offset"].alias("offset"), x["_length"].alias("length")))
    notes = lambda p: F.transform(F.coalesce(p["annotation"], F.array().cast(note)), lambda a: F.struct(a["_id"].alias("id"), as_map(a["infon"]).alias("infons"), F.coalesce(a["text"], F.lit("")).alias("text"), where(a).alias("locations")))
    passages = F.transform(F.coalesce("d.passage", F.array().cast(f"array<struct<infon:{kind},offset:bigint,text:string,annotation:{note}>>")), lambda p: F.struct(as_map(p["infon"]).alias("infons"), p["offset"].alias("offset"), p["text"].alias("text"), notes(p).alias("annotations")))
    return rows.select("file", "block", "pos", F.col("d.id").alias("id"), as_map(F.col("d.infon")).alias("infons"), passages.alias("passages"))


def bioc_raw(spark: SparkSession, path: str) -> DataFrame:
    """(file, id, xml) of each document of annotation XML as it is written; no id: ''."""
    return raw_records(spark, path, "document").select("file", F.xpath_string("xml", F.lit("/document/id")).alias("id"), "xml")


def store_tables(spark: SparkSession, path: str) -> DataFrame:
    """(table, column, type, position) of a store of sinks.save_store, from its folders and file footers."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    kinds = [s.getPath().getName()[5:] for s in at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at) if s.getPath().getName().startswith("kind=")]
    rows = [(k, f.name, f.dataType.simpleString(), i) for k in sorted(kinds) for i, f in enumerate(spark.read.parquet(f"{path}/kind={k}").schema)]
    return spark.createDataFrame(rows, "table string, column string, type string, position int")


def mention_table(spark: SparkSession, path: str) -> DataFrame:
    """Five TAB-separated fields, no quoting; any other number of fields raises, and so does an empty table."""
    rows = spark.read.text(path).select(F.split("value", "\t", -1).alias("f"))
    names = [x.split()[0] for x in schema.MENTIONS.split(", ")]
    good = F.when(F.size("f") == 5, F.col("f")).otherwise(F.raise_error(F.concat(F.lit("not five fields: "), F.array_join("f", "|"))).cast("array<string>"))
    out = rows.select(good.alias("f")).select(*[F.col("f")[i].alias(n) for i, n in enumerate(names)]).withColumn("pmid", F.col("pmid").cast("bigint"))
    if rows.isEmpty():
        raise ValueError("empty mention table")
    return out


def id_list(spark: SparkSession, ids: str | None = None, text: str | None = None, json: str | None = None) -> DataFrame:
    """(ord, pmid) of a comma list, a text file or a JSON array; empty entries drop, order and repeats stay."""
    if sum(x is not None for x in (ids, text, json)) != 1:
        raise ValueError("exactly one of ids, text and json")
    if ids is not None:
        rows = spark.createDataFrame([(ids.split(","),)], "a array<string>")
    elif json is not None:
        rows = spark.read.text(json, wholetext=True).select(F.from_json("value", "array<string>").alias("a"))
    else:
        rows = spark.read.text(text, wholetext=True).select(F.split("value", r"\r?\n").alias("a"))
    return rows.select(F.posexplode(F.filter(F.transform("a", lambda x: F.trim(x)), lambda x: x != "")).alias("ord", "p")).select("ord", F.col("p").cast("bigint").alias("pmid"))


def grouping_file(spark: SparkSession, path: str) -> DataFrame:
    """(group_name, src, member, ord) of a groupings JSON."""
    rows = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", schema.GROUPS)).alias("group_name", "g"))
    return rows.select("group_name", "g.src", F.posexplode("g.group").alias("ord", "member")).select("group_name", "src", "member", "ord")


def checked(files: DataFrame, sums: DataFrame) -> DataFrame:
    """binaryFile rows whose MD5 agrees with the side files' `MD5(name)= sum` lines; raises on a difference or no sum."""
    want = sums.select(F.regexp_extract("value", r"MD5\s*\(([^)]*)\)", 1).alias("name_"), F.regexp_extract("value", r"=\s*([0-9a-f]{32})", 1).alias("md5_"))
    found = files.withColumn("name_", F.substring_index("path", "/", -1)).join(want, "name_", "left")
    ok = F.when(F.md5("content") == F.col("md5_"), F.col("content")).otherwise(F.raise_error(F.concat(F.lit("checksum of "), F.col("path"))).cast("binary"))
    return found.withColumn("content", ok).drop("name_", "md5_")


FORMATS = {"pubmedxml": citation_records, "pmcxml": lambda spark, path: spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.lit(0).cast("bigint").alias("block"), F.lit(0).cast("bigint").alias("pos"), F.col("value").alias("xml")), "biocxml": biocxml}


def open_format(spark: SparkSession, path: str | list[str], kind: str) -> DataFrame:
    if kind not in FORMATS:
        raise RuntimeError(f"unknown format {kind}")
    return FORMATS[kind](spark, path)


class _Archive(InputPartition):
    def __init__(self, path: str, wanted: list[str] | None):
        self.path, self.wanted = path, wanted


class TarReader(DataSourceReader):
    """One partition for each archive, or for each (archive, group) of option `groups`; reading stops when all of a group's
    members were seen. Option `list` gives names without contents."""

    def __init__(self, options):
        import json

        self.listing = options.get("list", "false") == "true"
        self.paths = [p for p in options["path"].split(",") if p]
        self.groups = json.loads(options["groups"]) if "groups" in options else None

    def partitions(self):
        if self.groups:
            return [_Archive(g["src"], g["group"]) for _, g in sorted(self.groups.items())]
        return [_Archive(p, None) for p in self.paths]

    def read(self, partition):
        left = set(partition.wanted) if partition.wanted is not None else None
        with tarfile.open(partition.path, "r:*") as tar:
            for k, m in enumerate(tar):
                if left is not None and m.name not in left:
                    continue
                body = tar.extractfile(m).read() if m.isfile() and not self.listing else None
                yield partition.path, m.name, k, m.isfile(), body
                if left is not None:
                    left.discard(m.name)
                    if not left:
                        return
        if left:
            raise ValueError(f"{partition.path} lacks {sorted(left)[:10]}")


class TarSource(DataSource):
    """spark.read.format('folio_tar'): members of .tar and .tar.gz archives."""

    @classmethod
    def name(cls):
        return "folio_tar"

    def schema(self):
        return "src string, member string, ord int, is_file boolean, content binary"

    def reader(self, schema):
        return TarReader(self.options)


def tar_members(spark: SparkSession, *paths: str, listing: bool = False, groups: dict | None = None) -> DataFrame:
    import json

    spark.dataSource.register(TarSource)
    r = spark.read.format("folio_tar").option("list", str(listing).lower())
    return (r.option("groups", json.dumps(groups)) if groups else r).load(",".join(os.fspath(p) for p in paths))
