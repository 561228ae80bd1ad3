"""Citation and full-text XML records to typed documents and passages."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schema
from ..functions import dates
from ..functions.arrays import let, sums_before
from ..functions.arrow import small_batches
from ..functions.text import SKIPPED_TYPES, SUBSECTIONS
from . import xmltext
from .citations import strip_markers

_doi = re.compile(r"^[0-9\.]+\/.+[^\/]$")
_sections = frozenset(SUBSECTIONS)
_shown = frozenset(("thead", "tbody", "fig"))


def _int(s):
    s = (s or "").strip()
    return int(s) if re.fullmatch(r"[+-]?\d{1,9}", s) else None


def _month(s):
    return dates.NUMBER.get((s or "").strip()) or _int(s)


def _named_month(s):
    return next((dates.NUMBER[n] for n in dates.NAMES if n in (s or "")), None)


def _year(y):
    return y if y is not None and 1700 < y < 2100 else None


def _issue_date(article):
    node = article.find("./MedlineCitation/Article/Journal/JournalIssue/PubDate")
    if node is None:
        return None, None, None
    free = node.findtext("MedlineDate")
    if free is not None:
        y = re.search(r"(18|19|20)\d\d", free)
        return int(y[0]) if y else None, _named_month(free), None
    return _year(_int(node.findtext("Year"))), _month(node.findtext("Month")), _int(node.findtext("Day"))


def _entry_date(article):
    by: dict[str, tuple] = {}
    for d in article.findall("./PubmedData/History/PubMedPubDate"):
        y = _year(_int(d.findtext("Year")))
        if y is not None:
            by[d.get("PubStatus", "")] = (y, _int(d.findtext("Month")), _int(d.findtext("Day")))
    return next((by[s] for s in dates.PRIORITY if s in by), next(iter(by.values()), (None, None, None)))


def parse_citation(xml: str, handlers=None, strict: bool = False) -> dict:
    """A citation record. What is wrong with it is listed in errors, or raised if strict."""
    errors: list[str] = []

    def wrong(what: str) -> None:
        if strict:
            raise ValueError(what)
        errors.append(what)

    root = xmltext.parse(xml)
    article = root if root.tag == "PubmedArticle" else next(root.iter("PubmedArticle"))
    pmid = _int(article.findtext("./MedlineCitation/PMID"))
    if pmid is None:
        wrong("no PMID")
    late = lambda d: tuple(9999 if x is None else x for x in d)
    issue, entry = _issue_date(article), _entry_date(article)
    year, month, day = issue if late(issue) < late(entry) else entry
    authors = []
    for a in article.findall("./MedlineCitation/Article/AuthorList/Author"):
        fore, last, coll = (a.findtext(k) or None for k in ("ForeName", "LastName", "CollectiveName"))
        name = " ".join(x for x in (fore, last) if x) or coll
        authors.append(name) if name else wrong("author without a name")

    def field(e, *keys):
        got = {"ui": e.get("UI"), "major": e.get("MajorTopicYN"), "type": e.get("Type"), "name": e.text}
        if "major" in keys and any(c in (got[k] or "") for k in keys for c in "|~"):
            wrong(f"delimiter in {got['name']}")
        return {k: got[k] for k in keys}

    mesh = []
    for h in article.findall("./MedlineCitation/MeshHeadingList/MeshHeading"):
        d = h.find("DescriptorName")
        if d is not None:
            mesh.append(field(d, "ui", "major", "name") | {"qualifiers": [field(q, "ui", "major", "name") for q in h.findall("QualifierName")]})
    ids = lambda kind: [x.text for x in article.findall("./PubmedData/ArticleIdList/ArticleId") if x.get("IdType") == kind and x.text]
    if len(ids("pmc")) > 1:
        wrong("more than one PMCID")
    journals = [j.text for j in article.findall("./MedlineCitation/Article/Journal/Title")]
    if len(journals) > 1:
        wrong("more than one journal")
    clean = lambda t: xmltext.strip_empty_brackets(xmltext.unescape(t))
    titles = [clean(t) for c in xmltext.passages(article.findall("./MedlineCitation/Article/ArticleTitle"), handlers=handlers) if (t := xmltext.title_without_brackets(c.text))]
    return {
        "pmid": pmid, "pmcid": next(iter(ids("pmc")), None), "doi": next((d for d in ids("doi") if _doi.match(d)), None),
        "year": year, "month": month, "day": day, "title": titles,
        "abstract": [clean(c.text) for c in xmltext.passages(article.findall("./MedlineCitation/Article/Abstract/AbstractText"), handlers=handlers)],
        "journal": next(iter(journals), None), "journal_iso": article.findtext("./MedlineCitation/Article/Journal/ISOAbbreviation"),
        "authors": authors,
        "chemicals": [field(c, "ui", "name") for c in article.findall("./MedlineCitation/ChemicalList/Chemical/NameOfSubstance")],
        "mesh": mesh,
        "supp_mesh": [field(c, "ui", "type", "name") for c in article.findall("./MedlineCitation/SupplMeshList/SupplMeshName")],
        "publication_types": [t.text for t in article.findall("./MedlineCitation/Article/PublicationTypeList/PublicationType") if t.text and t.text not in SKIPPED_TYPES],
        "errors": errors,
    }


def _meta(node, strict_dates: bool) -> dict:
    """Ids, date and journal; a sub-article has them below front-stub."""
    both = lambda front, stub: node.findall(f"./front/{front}") + node.findall(f"./front-stub/{stub}")
    out = {"pmid": "", "pmcid": "", "doi": ""}
    kinds = {"pmid": "pmid", "pmc": "pmcid", "pmcid": "pmcid", "doi": "doi"}
    for a in both("article-meta/article-id", "article-id"):
        if a.text and a.get("pub-id-type") in kinds:
            out[kinds[a.get("pub-id-type")]] = a.text.strip().replace("\n", " ")
    best, most, carried = (None, None, None), 0, (None, None, None)
    for d in both("article-meta/pub-date", "pub-date"):
        y, m, day = (None, None, None) if strict_dates else carried
        y = _int(d.findtext("year")) or y
        m = _month(d.findtext("month")) or _named_month(d.findtext("season")) or m
        day = _int(d.findtext("day")) or day
        carried = (y, m, day)
        if (full := sum(x is not None for x in carried)) > most:
            best, most = carried, full
    journal = node.findall("./front/journal-meta/journal-title") + both("journal-meta/journal-title-group/journal-title", "journal-title-group/journal-title")
    iso = [j.text for j in both("journal-meta/journal-id", "journal-id") if j.get("journal-id-type") == "iso-abbrev"]
    return out | dict(zip(("year", "month", "day"), best)) | {"journal": " ".join(c.text for c in xmltext.passages(journal)), "journal_iso": iso[-1] if iso else "", "journals": len(journal)}


def parse_fulltext(xml: str, handlers=None, mark_citations: bool = False, all_paths: bool = False, trim: bool = False, strict_dates: bool = False, inherit_journal: bool = False, passage_tags=xmltext.PASSAGE_TAGS) -> list[dict]:
    """Every article of a file, each with its direct sub-articles. A sub-article without ids of its own has its parent's; without a year, its
    parent's date; its parent's journal only with inherit_journal. Elements of passage_tags begin passages of their own."""
    out = []
    for article in xmltext.parse(xml).iter("article"):
        out += _with_parts(article, handlers, mark_citations, all_paths, trim, strict_dates, inherit_journal, passage_tags)
    return out


def _with_parts(article, handlers, mark_citations: bool, all_paths: bool, trim: bool, strict_dates: bool, inherit_journal: bool, passage_tags) -> list[dict]:
    parent, out = _meta(article, strict_dates), []
    for k, node in enumerate([article, *article.findall("./sub-article")]):
        meta = parent if not k else _meta(node, strict_dates)
        if k:
            if not (meta["pmid"] or meta["pmcid"] or meta["doi"]):
                meta |= {i: parent[i] for i in ("pmid", "pmcid", "doi")}
            if meta["year"] is None:
                meta |= {i: parent[i] for i in ("year", "month", "day")}
            if inherit_journal and not meta["journal"]:
                meta |= {i: parent[i] for i in ("journal", "journal_iso")}
        citations: dict[str, str] = {}
        seed = f"{meta['pmid']}|{meta['pmcid']}|{k}"
        errors = ["more than one journal"] * (meta["journals"] > 1)
        found = []
        for section, front, stub in (("title", "article-meta/title-group/article-title", "title-group/article-title"), ("subtitle", "article-meta/title-group/subtitle", "title-group/subtitle"), ("abstract", "article-meta/abstract", "abstract"), ("article", "body", None), ("back", "back", None), ("floating", "floats-group", None)):
            nodes = node.findall(f"./front/{front}") + node.findall(f"./front-stub/{stub}") if stub else node.findall(f"./{front}")
            titled = section in ("title", "subtitle")
            if section == "title" and len(nodes) > 1:
                errors.append("more than one title")
            header = None
            for c in xmltext.passages(nodes, passage_tags, handlers=handlers, citations=None if titled else citations, seed=seed):
                text = xmltext.title_without_brackets(c.text) if titled else c.text
                if not text:
                    continue
                text, notes = strip_markers(xmltext.unescape(text), citations)
                if trim:
                    text = xmltext.trim_sentences(text)
                name = text.lower().strip("01234567890. ")
                header = name if name in _sections else header
                path = c.path if not titled and (all_paths or _shown & set(c.path.split("/"))) else None
                marked = [{"id": i, "citation_text": t, "offset": o, "length": 0} for i, t, o in notes] if mark_citations and not trim else []
                found.append({"section": section, "subsection": header, "xml_path": path, "text": text, "annotations": marked})
        out.append({"sub_article": k, **{i: meta[i] for i in ("pmid", "pmcid", "doi", "year", "month", "day", "journal", "journal_iso")}, "passages": found, "errors": errors})
    return out


def _mapped(records: DataFrame, xml: str, kept: list[str], ddl: str, parse) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    own = [f for f in records.schema if f.name in kept]
    out = StructType([*own, *StructType.fromDDL(ddl)])
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            before = b.select(kept).to_pylist()
            rows = [keep | r for keep, x in zip(before, b.column(xml).to_pylist()) if x for r in parse(x)]
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    small_batches(records.sparkSession)
    return records.mapInArrow(run, out)


def citations(records: DataFrame, xml: str = "xml", kept: list[str] = (), handlers=None, strict: bool = False) -> DataFrame:
    """One typed row for each citation record. A record that isn't XML gives a row with its error, or raises if strict."""
    ddl = schema.ABSTRACT

    def parse(x: str) -> list[dict]:
        try:
            return [parse_citation(x, handlers, strict)]
        except Exception as e:
            if strict:
                raise
            return [{"errors": [f"{type(e).__name__}: {e}"]}]

    return _mapped(records, xml, list(kept), ddl, parse)


def fulltexts(records: DataFrame, xml: str = "xml", kept: list[str] = (), handlers=None, strict: bool = False, **options) -> DataFrame:
    """One row for each article and sub-article of each record; options are parse_fulltext's. A record that isn't XML gives a row
    with its error; strict raises for that and for any other error."""

    def parse(x: str) -> list[dict]:
        try:
            got = parse_fulltext(x, handlers, **options)
        except Exception as e:
            if strict:
                raise RuntimeError(f"can't parse article: {e}") from e
            return [{"errors": [f"{type(e).__name__}: {e}"]}]
        if strict and (wrong := [w for a in got for w in a["errors"]]):
            raise ValueError("; ".join(wrong))
        return got

    return _mapped(records, xml, list(kept), schema.FULLTEXT, parse)


def with_offsets(passages: DataFrame, *document: str, order: str = "passage_idx", text: str = "text") -> DataFrame:
    """Adds offset: the summed length, in code points, of the document's passages before."""
    w = Window.partitionBy(*document).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return passages.withColumn("offset", F.coalesce(F.sum(F.length(text)).over(w), F.lit(0)).cast("bigint"))


def citation_passages(articles: DataFrame, trim: bool = True) -> DataFrame:
    """(pmid, passage_idx, section, text, offset) of parsed citations; offsets without a shuffle."""
    from ..functions.text import trim_sentences

    cut = (lambda x: trim_sentences(x)) if trim else (lambda x: x)
    every = F.concat(*[F.transform(s, lambda x, s=s: F.struct(F.lit(s).alias("section"), cut(x).alias("text"))) for s in ("title", "abstract")])
    return offsets_in_row(articles.select("pmid", every.alias("p")), "pmid")


def offsets_in_row(rows: DataFrame, *document: str) -> DataFrame:
    """Explodes p: array<struct<..., text>> with passage_idx and offset, computed in the row."""
    offsets = sums_before(F.transform("p", lambda x: F.coalesce(F.length(x["text"]), F.lit(0)).cast("bigint")))
    placed = F.arrays_zip(F.col("p").alias("x"), offsets.alias("offset"))
    return rows.select(*document, F.posexplode(placed).alias("passage_idx", "q")).select(*document, "passage_idx", "q.x.*", "q.offset")


#: What a document's infons are called, by the columns that hold them (fixed values).
INFONS = {"pmid": "pmid", "pmcid": "pmcid", "doi": "doi", "year": "year", "month": "month", "day": "day", "journal": "journal", "journalISO": "journal_iso"}


def _infons(title, more: dict):
    every = {"title": title} | {name: F.col(c).cast("string") for name, c in INFONS.items()} | more
    return F.map_from_arrays(F.array(*map(F.lit, every)), F.array(*every.values()))


def citation_documents(articles: DataFrame, trim: bool = True, kept: list[str] = ()) -> DataFrame:
    """(kept columns, id, infons, passages) of parsed citations, as sinks.bioc_document takes them; passages have section, offset
    and text."""
    from ..functions.metadata import encode_fields, encode_mesh
    from ..functions.text import trim_sentences

    cut = trim_sentences if trim else (lambda x: x)
    more = {"authors": F.array_join("authors", ", "), "chemicals": encode_fields(F.col("chemicals"), "ui", "name"), "meshHeadings": encode_mesh(F.col("mesh")), "supplementaryMesh": encode_fields(F.col("supp_mesh"), "ui", "type", "name"), "publicationTypes": F.array_join("publication_types", "|")}
    every = F.concat(*[F.transform(s, lambda x, s=s: F.struct(F.create_map(F.lit("section"), F.lit(s)).alias("infons"), cut(x).alias("text"))) for s in ("title", "abstract")])
    return _placed(articles.select(*kept, F.col("pmid").cast("string").alias("id"), _infons(F.array_join("title", " "), more).alias("infons"), every.alias("p")), kept=kept)


def fulltext_documents(articles: DataFrame, kept: list[str] = ()) -> DataFrame:
    """(kept columns, id, infons, passages) of parsed full texts; passages have section, subsection, xml_path where it was kept, offset, text
    and annotations at offsets in the document."""
    title = F.array_join(F.transform(F.filter("passages", lambda x: x["section"] == "title"), lambda x: x["text"]), " ")
    names = ("section", "subsection", "xml_path")
    infons = lambda x: F.map_from_entries(F.filter(F.array(*[F.struct(F.lit(n).alias("key"), x[n].alias("value")) for n in names]), lambda e: e["value"].isNotNull()))
    every = F.transform("passages", lambda x: F.struct(infons(x).alias("infons"), x["text"].alias("text"), x["annotations"].alias("annotations")))
    return _placed(articles.select(*kept, F.col("pmid").alias("id"), _infons(title, {}).alias("infons"), every.alias("p")), True, kept)


def _placed(rows: DataFrame, noted: bool = False, kept: list[str] = ()) -> DataFrame:
    offsets = sums_before(F.transform("p", lambda x: F.length(x["text"]).cast("bigint")))

    def one(x, at):
        notes = [F.transform(x["annotations"], lambda a: F.struct(a["id"].alias("id"), a["citation_text"].alias("citation_text"), (a["offset"] + at).alias("offset"), a["length"].alias("length"))).alias("annotations")] if noted else []
        return F.struct(x["infons"].alias("infons"), at.alias("offset"), x["text"].alias("text"), *notes)

    return rows.select(*kept, "id", "infons", let(offsets, lambda o: F.zip_with("p", o, one)).alias("passages"))


def fulltext_passages(articles: DataFrame) -> DataFrame:
    return offsets_in_row(articles.select("pmid", "sub_article", F.col("passages").alias("p")), "pmid", "sub_article")


def carry_subsection(passages: DataFrame, *group: str, order: str = "passage_idx", header: str = "header") -> DataFrame:
    """Adds subsection: the last header in the group up to and with the row."""
    w = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return passages.withColumn("subsection", F.last(header, ignorenulls=True).over(w))


def show_path(path, always: bool = False):
    """The path column where it is emitted: for tables and figures, or always."""
    return F.when(F.lit(always) | F.arrays_overlap(F.split(path, "/"), F.array(*map(F.lit, sorted(_shown)))), path)
