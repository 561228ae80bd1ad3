"""Table functions for SQL: register(spark), then `... from t, lateral text_chunks(t.xml) c`."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import udtf
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from .arrow import small_batches


class _TextChunks:
    """text_chunks(xml): the passages of an article's or any element's text, as operators.xmltext gives them.

    With a column, those of one text. With a table that has a column xml, `text_chunks(table(t) partition by k order by n)`, those of
    each partition's texts one after the other, behind the table's other columns: numbers and offsets go on through a
    partition. Nulls and '' have none; what isn't XML raises."""

    def __init__(self):
        self.at = self.offset = 0

    @staticmethod
    def analyze(xml: AnalyzeArgument) -> AnalyzeResult:
        if xml.isTable and "xml" not in xml.dataType.names:
            raise ValueError("the table has no column xml")
        if not xml.isTable and not isinstance(xml.dataType, (T.StringType, T.NullType)):
            raise ValueError("text_chunks takes a string or a table")
        own = [f for f in xml.dataType if f.name != "xml"] if xml.isTable else []
        return AnalyzeResult(T.StructType(own).add("passage_idx", "integer").add("text", "string").add("tag", "string").add("xml_path", "string").add("offset", "long"))

    def eval(self, xml):
        from ..operators import xmltext

        own: tuple = ()
        if isinstance(xml, Row):
            row = xml.asDict()
            xml = row.pop("xml")
            own = tuple(row.values())
        else:
            self.at = self.offset = 0
        for c in xmltext.passages(xmltext.parse(xml)) if xml else []:
            yield *own, self.at, c.text, c.tag, c.path, self.offset
            self.at, self.offset = self.at + 1, self.offset + len(c.text)


class _XmlNodes:
    """xml_nodes(xml): (id, parent, tag, head) of all elements in document order; the root's parent is null."""

    @staticmethod
    def analyze(xml: AnalyzeArgument) -> AnalyzeResult:
        return AnalyzeResult(T.StructType().add("id", "integer").add("parent", "integer").add("tag", "string").add("head", "string"))

    def eval(self, xml):
        from ..operators import xmltext

        todo, n = [(xmltext.parse(xml), None)] if xml else [], 0
        while todo:
            e, parent = todo.pop()
            yield n, parent, e.tag, (e.text or "").strip()
            todo.extend((c, n) for c in reversed(list(e)) if isinstance(c.tag, str))
            n += 1


def register(spark: SparkSession) -> None:
    small_batches(spark)
    for name, kind in (("text_chunks", _TextChunks), ("xml_nodes", _XmlNodes)):
        spark.udtf.register(name, udtf(kind, useArrow=True))


def node_paths(nodes: DataFrame, key: str = "doc_id", depth: int = 100) -> DataFrame:
    """(key, id, path) of nodes (key, id, parent, tag): the tags from the root down, by a recursive table expression, a join for each
    level, by shuffles: a broadcast would take the nodes through the driver. Trees deeper than `depth` raise."""
    spark = nodes.sparkSession
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")  # the number of nodes is the data's
    return spark.sql(
        f"""with recursive p(k, id, path) max recursion level {depth} as (
              select {key}, id, tag from {{nodes}} where parent is null
              union all select /*+ merge(n, p) */ n.{key}, n.id, concat(p.path, '/', n.tag) from {{nodes}} n join p on n.{key} = p.k and n.parent = p.id)
            select k as {key}, id, path from p""",
        nodes=nodes,
    )
