"""Writers."""

from __future__ import annotations

from xml.sax.saxutils import escape

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.arrow import small_batches
from ..functions.text import file_index as text_file_index
from ..functions.text import hash40


def plain_text(passages: DataFrame, *document: str, order: str = "passage_idx", text: str = "text") -> DataFrame:
    """(document, text): every passage followed by an empty line."""
    lines = F.transform(F.array_sort(F.collect_list(F.struct(order, F.concat(text, F.lit("\n\n")).alias("t")))), lambda x: x["t"])
    return passages.groupBy(*document).agg(F.array_join(lines, "").alias("text"))


def bioc_xml(doc_id, infons, passages) -> str:
    """A <document> element; passages: structs of infons (a map), offset and text, with annotations if they have a field of that
    name: citation notes, structs of id, citation_text, offset and length, or others, structs of id, infons, text and locations
    (structs of offset and length)."""

    def infon(m):
        return "".join(f"<infon key={_quoted(k)}>{escape('' if v is None else str(v))}</infon>" for k, v in (dict(m) if m is not None else {}).items())

    def note(a):
        cited = "citation_text" in a
        infons = {"citation_text": a["citation_text"], "type": "citation"} if cited else a["infons"]
        places = "".join(f"<location offset=\"{x['offset']}\" length=\"{x['length']}\"/>" for x in ([a] if cited else a["locations"]))
        return f"<annotation id={_quoted(a['id'])}>{infon(infons)}{places}<text>{'' if cited else escape(a['text'] or '')}</text></annotation>"

    def passage(p):
        notes = p.get("annotations")
        return f"<passage>{infon(p['infons'])}<offset>{p['offset']}</offset><text>{escape(p['text'] or '')}</text>{''.join(map(note, notes if notes is not None else []))}</passage>"

    body = "".join(map(passage, passages if passages is not None else []))
    return f"<document><id>{escape('' if doc_id is None else str(doc_id))}</id>{infon(infons)}{body}</document>"


@F.pandas_udf(T.StringType())
def _bioc_document(doc_id: pd.Series, infons: pd.Series, passages: pd.Series) -> pd.Series:
    return pd.Series([bioc_xml(*x) for x in zip(doc_id, infons, passages)])


def bioc_document(doc_id: Column | str, infons: Column | str, passages: Column | str) -> Column:
    """bioc_xml of columns."""
    small_batches()
    return _bioc_document(doc_id, infons, passages)


def _quoted(s: str) -> str:
    return '"' + escape(s, {'"': "&quot;"}) + '"'


def write_bioc(docs: DataFrame, path: str, source: str = "", date: str = "", key: str = "") -> None:
    """Writes docs (id, infons, passages) to a folder of files, each a whole collection."""
    head = f'<?xml version="1.0" encoding="UTF-8"?>\n<!DOCTYPE collection SYSTEM "BioC.dtd">\n<collection><source>{escape(source)}</source><date>{escape(date)}</date><key>{escape(key)}</key>'

    def wrapped(batches):
        yield pa.RecordBatch.from_arrays([pa.array([head])], names=["value"])
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([bioc_xml(*r) for r in zip(*(c.to_pylist() for c in b.columns))], pa.string())], names=["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["</collection>"])], names=["value"])

    small_batches(docs.sparkSession)
    docs.select("id", "infons", "passages").mapInArrow(wrapped, "value string").write.text(path)


def write_text(docs: DataFrame, path: str) -> None:
    """Writes documents' passages (see articles.citation_documents), each followed by an empty line."""
    docs.select(F.array_join(F.transform("passages", lambda p: F.concat(p["text"], F.lit("\n"))), "\n").alias("value")).where("value <> ''").write.text(path)


def save_store(docs: DataFrame, path: str, kind: str, updated: int, file_index: int = -1) -> None:
    """Writes (pmid, body) as a store partition, replacing that file's rows. Abstract stores need a file index."""
    if kind == "abstract" and file_index <= 0:
        raise ValueError("abstracts need a file index above 0")
    rows = docs.select(F.lit(kind).alias("kind"), F.col("pmid").cast("bigint").alias("pmid"), "body", hash40(F.col("body")).alias("hash"), F.lit(updated).cast("bigint").alias("updated"), F.lit(file_index).cast("bigint").alias("file_index"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("kind", "file_index").parquet(path)


def save_documents(docs: DataFrame, path: str, kind: str, updated: int, file_index=None) -> None:
    """Writes documents (file, block, pos, id, infons, passages) as the store partitions of their files, replacing those.

    Of a file's documents of one id the first by (block, pos) stays; a null id, '', 'None' and '0' is none, and its document is left
    out; an id that is no number raises. file_index: of abstracts, a column (by default the six digits of the file's name); full
    texts have -1, and all files given are one input. Documents are shuffled once, by file and id, with only the first of each
    split's repeats."""
    key = F.col("file") if kind == "abstract" else F.lit("")
    good = docs.where(F.col("id").isNotNull() & ~F.trim("id").isin("", "None", "0"))
    index = F.lit(-1) if kind != "abstract" else text_file_index(F.col("file")) if file_index is None else file_index
    good = good.select(key.alias("f_"), F.trim("id").cast("bigint").alias("pmid"), index.cast("bigint").alias("i_"), F.struct("file", "block", "pos").alias("at_"), F.struct("id", "infons", "passages").alias("d_"))
    one = good.groupBy("f_", "pmid", "i_").agg(F.min_by("d_", "at_").alias("d_")).where("pmid <> 0")
    rows = one.select("pmid", bioc_document("d_.id", "d_.infons", "d_.passages").alias("body"), "i_")
    rows = rows.select(F.lit(kind).alias("kind"), "pmid", "body", hash40(F.col("body")).alias("hash"), F.lit(updated).cast("bigint").alias("updated"), F.col("i_").alias("file_index"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("kind", "file_index").parquet(path)


def write_listing(listing: DataFrame, path: str) -> None:
    listing.write.csv(path, sep="\t", header=True)


def consume(manifest: DataFrame, used: DataFrame, key: str = "path") -> DataFrame:
    """manifest with consumed = true for the inputs used: they stay known without their contents."""
    return manifest.join(used.select(key, F.lit(True).alias("u_")).distinct(), key, "left").withColumn("consumed", F.coalesce("u_", "consumed")).drop("u_")


def live(manifest: DataFrame) -> DataFrame:
    return manifest.where("not consumed and size > 0")


def emptied(spark, path: str) -> None:
    """Takes the contents of a table's folder away but leaves the folder, with the time it was last changed: an input that has been
    used stays known, without its disk."""
    fs, (at,) = _paths(spark, path)
    status = fs.getFileStatus(at)
    for s in fs.listStatus(at):
        fs.delete(s.getPath(), True)
    fs.setTimes(at, status.getModificationTime(), -1)


def filled(spark, path: str) -> bool:
    """Whether a table's folder has contents."""
    fs, (at,) = _paths(spark, path)
    return fs.getContentSummary(at).getLength() > 0


def write_lines(rows: DataFrame, path: str, head: str = "", between: str = "\n", tail: str = "") -> int:
    """Writes the one column of rows, in their order, to one file, and returns how many. The driver streams them, a partition at a time; for files that
    have to be one: indexes, groupings and collections of requested ids."""
    fs, (part, at) = _paths(rows.sparkSession, f"{path}.part", path)
    out, held, n = fs.create(part, True), [head], 0
    for n, r in enumerate(rows.toLocalIterator(), 1):
        held += [between, r[0]] if n > 1 else [r[0]]
        if len(held) > 4096:
            out.write("".join(held).encode())
            held = []
    out.write("".join([*held, tail]).encode())
    out.close()
    fs.delete(at, False)
    if not fs.rename(part, at):
        raise OSError(f"can't rename to {path}")
    return n


def write_groupings(groups: DataFrame, path: str) -> None:
    """Writes (group_name, src, group) as a JSON object by group_name, sorted."""
    quoted = F.to_json(F.array("group_name")).substr(F.lit(2), F.length(F.to_json(F.array("group_name"))) - 2)
    write_lines(groups.orderBy("group_name").select(F.concat(quoted, F.lit(": "), F.to_json(F.struct("group", "src")))), path, "{", ",\n", "}")


def write_index(ids: DataFrame, path: str) -> None:
    """Writes ids of grouping.id_index, one a line, in string order."""
    write_lines(ids.orderBy(ids.columns[0]), path, tail="\n" if not ids.isEmpty() else "")


def swap(df: DataFrame, path: str, *partition_by: str) -> None:
    """Writes beside `path`, then puts the new table in the old one's place by two renames. The old one is deleted last; if the
    driver is lost between the renames, the next swap, or restored(), brings it back."""
    restored(df.sparkSession, path)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}.tmp")
    fs, (new, now, old) = _paths(df.sparkSession, f"{path}.tmp", path, f"{path}.old")
    if fs.exists(now):
        fs.rename(now, old)
    if not fs.rename(new, now):
        raise OSError(f"can't rename to {path}")
    fs.delete(old, True)


def restored(spark, path: str) -> bool:
    """Whether a table that an unfinished swap had put aside was put back; one that a finished swap left is deleted."""
    fs, (now, old) = _paths(spark, path, f"{path}.old")
    if not fs.exists(old):
        return False
    if fs.exists(now):
        fs.delete(old, True)
        return False
    return fs.rename(old, now)


def _paths(spark, *paths: str):
    at = [spark._jvm.org.apache.hadoop.fs.Path(p) for p in paths]
    return at[0].getFileSystem(spark._jsc.hadoopConfiguration()), at
