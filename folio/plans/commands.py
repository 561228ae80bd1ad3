"""Command lines: python -m folio.plans.commands COMMAND --help"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import align, annotate, grouping, retrieve, versions
from ..sources import readers, remote, sinks, store
from . import convert


def fetch(spark: SparkSession, database: str, ids: str, folder: str, email: str, out: str | None = None, out_format: str = "biocxml", opener=remote.opened) -> list[str]:
    """Records of ids to files of a shared folder and, if `out` is given, converted."""
    if out is not None and out_format not in convert.OUT:
        raise ValueError(f"{out_format} is not one of {'/'.join(convert.OUT)}")
    paths = remote.fetch(database, ids.split(","), folder, email, opener)
    if out is not None:
        convert.convert(spark, paths, remote.DATABASES[database], out, out_format)
    return paths


def group(spark: SparkSession, archives: str, out: str, before: str | None = None, n: int = grouping.GROUP) -> None:
    """A groupings file of the XML members of archives (comma-separated paths); those of the file `before` stay as they are."""
    old = readers.grouping_file(spark, before) if before else None
    paths = spark.createDataFrame([(p,) for p in archives.split(",")], "src string")
    if old is not None:
        paths = grouping.not_yet_grouped(paths, old)
    new = [r.src for r in paths.orderBy("src").collect()]
    rows = old
    if new:
        members = grouping.group_members(grouping.only_xml(readers.tar_members(spark, *new, listing=True)), n)
        rows = members if old is None else old.unionByName(members)
    sinks.write_groupings(grouping.groupings(rows), out)


def _same_schema(spark: SparkSession, main: str, other: str) -> None:
    """Raises unless the tables that both stores have are alike, and there are some."""
    have, more = readers.store_tables(spark, main), readers.store_tables(spark, other)
    both = have.select("table").intersect(more.select("table"))
    if both.isEmpty() or not have.join(both, "table", "left_semi").exceptAll(more).isEmpty() or not more.join(both, "table", "left_semi").exceptAll(have).isEmpty():
        raise ValueError("schemas differ")


def merge(spark: SparkSession, main: str, update: str, out: str) -> None:
    """The store `main` after the rows of the stores `update` (comma-separated, in order), written to `out`, which may be `main`."""
    every = None
    for i, path in enumerate([main, *update.split(",")]):
        if i:
            _same_schema(spark, main, path)
        one = spark.read.parquet(path).withColumn("input_ord", F.lit(i))
        every = one if every is None else every.unionByName(one)
    sinks.swap(versions.winners(every), out, "kind", "file_index")


def merge_folder(spark: SparkSession, main: str, folder: str, truncate: bool = False, buckets: int = store.BUCKETS) -> dict:
    """Folds the stores in `folder`, by name, into the bucketed store `main` (sources.store), of which only the buckets that change
    are written. A store of several files is as many inputs, by file index. Empty ones are skipped; with `truncate`, those used
    are emptied afterwards but stay known. {"touched", "of"}: buckets; {"used", "skipped"}: stores."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    names = sorted(s.getPath().toString() for s in at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at) if s.isDirectory())
    used = [n for n in names if sinks.filled(spark, n)]
    if not used and not store.exists(spark, main):
        raise ValueError("no store to begin with")
    inputs = []
    for k, n in enumerate(used):
        if k:
            _same_schema(spark, used[0], n)
        rows = spark.read.parquet(n).withColumn("file_index", F.col("file_index").cast("bigint"))
        files = [r[0] for r in rows.select("file_index").distinct().orderBy("file_index").collect()]  # from folders' names
        inputs += [rows.where(F.col("file_index") == f) for f in files]
    got = store.change(spark, main, inputs, buckets)
    if truncate:
        for n in used:
            sinks.emptied(spark, n)
    return got | {"used": len(used), "skipped": len(names) - len(used)}


def _stored(spark: SparkSession, path: str, ids: DataFrame | None = None) -> DataFrame:
    """Rows of a store, bucketed or a plain table; of a bucketed one the buckets of ids."""
    if not store.exists(spark, path):
        return spark.read.parquet(path)
    return store.rows(spark, path) if ids is None else store.lookup(spark, path, ids)


def pubmed(spark: SparkSession, urls: DataFrame, folder: str, out: str, updated: int, form: str = "store", opener=remote.opened) -> dict[str, int]:
    """Citation files (column `url`): downloads those that `folder` hasn't, each checked by its MD5, and converts all of them to `out`, as
    biocxml, txt, or a store with a partition for each file by the number in its name. A record that isn't read raises."""
    files = [r.path for r in remote.downloads(urls, folder, True, opener).orderBy("path").collect()]  # as many as were asked for
    if not files:
        raise ValueError("no files")
    return _job(spark, convert.parsed(spark, files, "pubmedxml"), out, "abstract", updated, form)


def pmc(spark: SparkSession, archives: str, groups: str, names: str, out: str, updated: int, form: str = "store") -> dict[str, int]:
    """Full texts of the named groups (comma-separated; '': all) of a groupings file, whose archives lie in the folder `archives`.
    A member that an archive lacks raises, and so does one that isn't read."""
    rows = readers.grouping_file(spark, groups)
    if names:
        rows = rows.where(F.col("group_name").isin(names.split(",")))
    got = {r.group_name: {"src": os.path.join(archives, r.src), "group": r.group} for r in grouping.groupings(rows).collect()}
    if not got or names and set(names.split(",")) - set(got):
        raise ValueError("no such group")
    members = readers.tar_members(spark, groups=got)
    records = members.select(F.col("src").alias("file"), F.col("ord").cast("bigint").alias("block"), F.lit(0).cast("bigint").alias("pos"), F.decode("content", "UTF-8").alias("xml"))
    return _job(spark, convert.parsed_records(records, "pmcxml"), out, "fulltext", updated, form)


def _job(spark: SparkSession, docs: DataFrame, out: str, kind: str, updated: int, form: str) -> dict[str, int]:
    if form not in ("store", *convert.OUT):
        raise ValueError(f"{form} is not one of store/{'/'.join(convert.OUT)}")
    seen = Observation()
    docs = convert.none_failed(docs.observe(seen, F.count("*").alias("read"))).drop("failed")
    if form == "store":
        sinks.save_documents(docs, out, kind, updated)
    else:
        (sinks.write_text if form == "txt" else sinks.write_bioc)(docs, out)
    return {"read": seen.get["read"]}


def annotate_file(spark: SparkSession, docs: str, mentions: str, out: str) -> dict[str, int]:
    """Documents of annotation XML with the annotations of a mention table, in the order of their files."""
    read = readers.biocxml(spark, docs)
    # checkpointed: ranges are sampled, which would align twice
    got = align.checkpointed(annotate.annotated(read, readers.mention_table(spark, mentions)))
    seen, notes = Observation(), F.aggregate("passages", F.lit(0), lambda a, p: a + F.size(p["annotations"]))
    got = got.repartitionByRange(*convert.PLACE).sortWithinPartitions(*convert.PLACE).observe(seen, F.count("*").alias("documents"), F.sum(notes).alias("annotations"))
    sinks.write_bioc(got, out)
    return seen.get


def listing(spark: SparkSession, path: str, out: str) -> None:
    rows = _stored(spark, path)
    sinks.write_listing(retrieve.sorted_listing(rows.where("kind = 'abstract'"), rows.where("kind = 'fulltext'")), out)


def fetch_store(spark: SparkSession, path: str, ids: DataFrame, out: str, mode: str = "all") -> dict[str, int]:
    """Writes the documents of ids, in request order, as one collection; full texts carry their abstracts' infons. How many were
    asked for and written."""
    got, _ = retrieve.documents(ids, _stored(spark, path, ids), mode)
    head = '<?xml version="1.0" encoding="UTF-8"?>\n<!DOCTYPE collection SYSTEM "BioC.dtd">\n<collection>\n'
    written = sinks.write_lines(got.orderBy("ord").select("body"), out, head, "\n", "\n</collection>\n")
    return {"asked": ids.count(), "written": written}


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> None:
    p = argparse.ArgumentParser(prog="folio", description="Literature analytics on Spark.")
    to = p.add_subparsers(dest="command", required=True)

    def command(name: str, about: str, /, *required: str, **more: dict) -> None:
        c = to.add_parser(name, help=about)
        for r in required:
            c.add_argument(f"--{r}", required=True)
        for k, v in more.items():
            c.add_argument(f"--{k}", **v)

    command("fetch", "records by id", "database", "ids", "folder", "email", out={}, format={"default": "biocxml", "choices": convert.OUT})
    command("download", "files of remote folders", "from", "folder", kind={"default": "pubmed", "choices": sorted(remote.DATABASES)}, md5={"action": "store_true"})
    command("group", "groups of archive members", "archives", "out", before={}, n={"type": int, "default": grouping.GROUP})
    command("merge", "stores into another, in order", "main", "update", "out")
    command("merge-folder", "all stores of a folder into a bucketed one", "main", "folder", truncate={"action": "store_true"})
    command("pubmed", "citation files by address", "urls", "folder", "out", "updated", form={"default": "store", "choices": ["store", *convert.OUT]})
    command("pmc", "full texts of groups of archives", "archives", "groups", "out", "updated", names={"default": ""}, form={"default": "store", "choices": ["store", *convert.OUT]})
    command("align", "annotations of a mention table", "docs", "mentions", "out")
    command("list", "what a store holds", "store", "out")
    command("retrieve", "documents by id", "store", "out", ids={}, text={}, json={}, mode={"default": "all", "choices": retrieve.MODES})
    a = p.parse_args(args)
    spark = spark or SparkSession.builder.getOrCreate()
    if a.command == "fetch":
        fetch(spark, a.database, a.ids, a.folder, a.email, a.out, a.format)
    elif a.command == "download":
        pattern, name = (remote.CITATION_FILES, os.path.basename) if a.kind == "pubmed" else (remote.FULLTEXT_FILES, remote.local_name)
        files = remote.listing(spark, getattr(a, "from").split(","), pattern, required=True)
        print(sum(r.fetched for r in remote.downloads(files, a.folder, a.md5, name=name).select("fetched").toLocalIterator()))
    elif a.command == "group":
        group(spark, a.archives, a.out, a.before, a.n)
    elif a.command == "merge":
        merge(spark, a.main, a.update, a.out)
    elif a.command == "merge-folder":
        print(merge_folder(spark, a.main, a.folder, a.truncate))
    elif a.command == "pubmed":
        print(pubmed(spark, spark.createDataFrame([(u,) for u in a.urls.split(",")], "url string"), a.folder, a.out, int(a.updated), a.form))
    elif a.command == "pmc":
        print(pmc(spark, a.archives, a.groups, a.names, a.out, int(a.updated), a.form))
    elif a.command == "align":
        print(annotate_file(spark, a.docs, a.mentions, a.out))
    elif a.command == "list":
        listing(spark, a.store, a.out)
    else:
        n = fetch_store(spark, a.store, readers.id_list(spark, a.ids, a.text, a.json), a.out, a.mode)
        print(f"{n['written']} of {n['asked']} written")


if __name__ == "__main__":
    main()
