import html
import re
import tarfile
import time
import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F

from folio.functions import dates, metadata, spans, text
from folio.operators import align, articles, grouping, retrieve, versions, xmltext
from folio.operators.citations import strip_markers
from folio.plans import catalogue, convert
from folio.sources import readers, sinks

BRACKETS = [(" ((())(", " ("), ("( [3] [4] )", "( [3] [4] )"), ("( [] )", ""), ("(Fig. 1)", "(Fig. 1)"), ("( ; )", ""), ("( . )", ""), ("   }{ \t}{   ", "   }{ \t}{   "), ("( [] [ ] )", "")]
CLEANUP = [("sentence . that", "sentence. that"), ("space , before", "space, before"), ("space ; before", "space; before"), ("   }{ \t}{   ", "}{\t}{"), ("a\nb", "ab"), ("a b", "a b"), ("a­b", "ab"), ("a , , b", "a, b"), ("x ,.", "x."), ("( x )", "(x)"), ("a ,b", "a ,b")]


def one(spark, kind, value, f):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first().y


def test_strings(spark):
    for cases, native, plain in ((BRACKETS, text.strip_empty_brackets, xmltext.strip_empty_brackets), (CLEANUP, text.cleanup, xmltext.cleanup)):
        got = [r.y for r in spark.createDataFrame([(i, a) for i, (a, _) in enumerate(cases)], "i int, x string").orderBy("i").select(native(F.col("x")).alias("y")).collect()]
        assert got == [b for _, b in cases]
        assert [plain(a) for a, _ in cases] == got


@pytest.mark.parametrize("s, y, m", [("1998 Dec-1999 Jan", 1998, 1), ("Nov-Jan 2001", 2001, 1), ("Sep-May 1990", 1990, 5), ("Spring 1975", 1975, None), ("1699", None, None)])
def test_medline_date(spark, s, y, m):
    assert tuple(one(spark, "string", s, dates.medline_date)) == (y, m, None)


def test_dates(spark):
    kind = "array<struct<status:string,y:int,m:int,d:int>>"
    assert tuple(one(spark, kind, [("entrez", 2001, 1, 1), ("pubmed", 1700, 1, 1), ("entrez", 2002, 2, 2)], dates.by_status)) == (2002, 2, 2)
    assert one(spark, kind, [("x", 2100, 1, 1)], dates.by_status) is None
    kind = "array<struct<year:string,season:string,month:string,day:string>>"
    assert tuple(one(spark, kind, [("2001", None, None, None), (None, "May-June", None, "4")], dates.most_complete)) == (2001, 5, 4)
    assert tuple(one(spark, kind, [("2001", None, None, None), (None, "May", None, "4")], lambda c: dates.most_complete(c, strict=True))) == (None, 5, 4)
    assert tuple(one(spark, kind, [], dates.most_complete)) == (None, None, None)


def test_mesh(spark):
    kind = "array<struct<ui:string,major:string,name:string,qualifiers:array<struct<ui:string,major:string,name:string>>>>"
    mesh = [("D1", "Y", "A", [("Q1", "N", "b"), ("Q2", "N", "c")]), ("D2", "N", "B", [])]
    packed = one(spark, kind, mesh, metadata.encode_mesh)
    assert packed == "Descriptor|D1|Y|A~Qualifier|Q1|N|b~Qualifier|Q2|N|c\tDescriptor|D2|N|B"
    back = one(spark, "string", packed, metadata.decode_mesh)
    assert [(h.ui, h.major, h.name, [tuple(q) for q in h.qualifiers]) for h in back] == mesh
    with pytest.raises(Exception, match="delimiter"):
        one(spark, kind, [("D1", "Y", "a|b", [])], metadata.encode_mesh)


V = "pmid int, input_ord int, time int, hash string"


@pytest.mark.parametrize("rows, want", [([(1, 1, 1, "A"), (1, 2, 2, "B"), (1, 3, 3, "A")], ("A", 3)), ([(1, 1, 1, "A"), (1, 2, 3, "A"), (1, 3, 2, "B")], ("B", 2)), ([(1, 1, 1, "A"), (1, 2, 2, "A"), (1, 3, 3, "A")], ("A", 1)), ([(1, 1, 5, "A"), (1, 2, 5, "B")], ("B", 5)), ([(1, 1, 5, "A"), (1, 2, 4, "A")], ("A", 4)), ([(1, 1, 5, "A"), (1, 2, 4, "B")], ("A", 5))])
def test_merge(spark, rows, want):
    w = versions.merge_exact(spark.createDataFrame(rows, V)).first()
    assert (w.hash, w.time) == want
    cur = spark.createDataFrame(rows[:1], V).select("pmid", "time", "hash")
    for r in rows[1:]:
        cur = versions.upsert(cur, spark.createDataFrame([r], V).select("pmid", "time", "hash"), time="time")
    assert (cur.first().hash, cur.first().time) == want


def test_dedupe_and_retrieve(spark):
    d = spark.createDataFrame([("f", 1, "7"), ("f", 2, "7"), ("f", 3, ""), ("f", 4, "None"), ("f", 5, "0"), ("f", 6, None)], "file string, pos int, pmid string")
    assert [(r.pos, r.pmid) for r in versions.first_in_file(d).collect()] == [(1, "7")]
    s = "pmid bigint, body string, infons string"
    a, f = spark.createDataFrame([(1, "a1", "A1"), (2, "a2", "A2")], s), spark.createDataFrame([(2, "f2", "F2"), (3, "f3", "F3")], s)
    ids = readers.id_list(spark, ids="2,1,9,2,,3")
    got, gone = retrieve.retrieve(ids, a, f)
    assert [tuple(r) for r in got.orderBy("ord").collect()] == [(0, 2, "fulltext", "f2", "A2"), (1, 1, "abstract", "a1", "A1"), (3, 2, "fulltext", "f2", "A2"), (4, 3, "fulltext", "f3", "F3")]
    assert [r.pmid for r in gone.collect()] == [9]
    with pytest.raises(ValueError, match="unexpected: 1"):
        retrieve.guard(a, f, "pmid")


def test_grouping(spark):
    m = spark.range(4001).selectExpr("'x/pmc.tar.gz' as src", "concat('m', id) as member", "id as ord")
    n = {r.group_name: r["count"] for r in grouping.group_members(m).groupBy("group_name").count().collect()}
    assert n == {"pmc_00": 2000, "pmc_01": 2000, "pmc_02": 1}


def test_find_spans(spark):
    rows = [("ab 𝒳 ab, abc ab", "ab", [(0, 2), (5, 7), (13, 15)]), ("none", "ab", []), ("", "ab", []), (None, "ab", []), ("ab", None, []), ("ab", "ab", [(0, 2)])]
    df = spark.createDataFrame([(i, s, m) for i, (s, m, _) in enumerate(rows)], "i int, s string, m string")
    got = df.select("i", spans.find_spans(F.col("s"), spans.mention_pattern(F.col("m"))).alias("at")).collect()
    assert {r.i: [tuple(x) for x in r.at] for r in got} == {i: want for i, (_, _, want) in enumerate(rows)}


def test_alignment(spark):
    p = spark.createDataFrame([(1, 0, "Interferon α and interferon  gamma receptor binds TNF.", 10), (2, 0, "nothing", 0)], "pmid bigint, passage_idx int, text string, offset bigint")
    m = spark.createDataFrame([(1, "G", "g2", "interferon gamma|interferon gamma receptor", "x"), (1, "G", "g1", "interferon gamma receptor", "x"), (1, "C", "c1", "Interferon alpha", "x"), (1, "G", "g3", "tnf", "x"), (3, "G", "g", "nothing", "x")], "pmid bigint, type string, conceptid string, mentions string, database string")
    got = [(r.type, r.conceptid, r.text, r.offset) for r in align.align(p, m).orderBy("offset").collect()]
    assert got == [("C", "c1", "Interferon α", 10), ("G", "g1;g2", "interferon  gamma receptor", 27)]
    kind = "array<struct<start:int,end:int>>"
    assert [(s.start, s.end) for s in one(spark, kind, [(0, 3), (3, 6), (10, 12)], spans.choose_spans)] == [(3, 6), (10, 12)]


ARTICLE = """<article xmlns:xlink="x"><front><article-meta><article-id pub-id-type="pmid">5</article-id><title-group><article-title>[On <italic>x</italic>].</article-title></title-group>
<pub-date><year>2001</year></pub-date><pub-date><month>May</month></pub-date></article-meta></front>
<body><sec><title>2. Methods</title><p>As shown <xref ref-type="bibr">1</xref>, <xref ref-type="bibr">2</xref>. See <xref ref-type="fig">Fig 1</xref> and (<ext-link>supplementary Figure S4C</ext-link>) <ext-link>http://x</ext-link>.</p>
<table-wrap><table><thead><tr><th>a</th><th>b</th></tr></thead><tbody><tr><td>}{</td><td>}{</td></tr></tbody></table></table-wrap></sec></body>
<sub-article><front-stub><article-id pub-id-type="doi">10.1/z</article-id></front-stub><body><p>Sub</p></body></sub-article></article>"""


def test_fulltext(spark):
    rows = articles.fulltexts(spark.createDataFrame([(ARTICLE,), ("<article><a></article>",)], "xml string"), mark_citations=True).collect()
    main, sub, bad = rows
    assert (main.pmid, main.year, main.month) == ("5", 2001, 5) and bad.errors[0].startswith("ParseError")
    assert (sub.pmid, sub.doi, sub.year, sub.passages[0].text) == ("", "10.1/z", 2001, "Sub")
    by = {p.xml_path: p.text for p in main.passages if p.xml_path}
    assert sorted(by.values()) == ["a\tb", "}{\t}{"] and all(part in p.split("/") for part, p in zip(("thead", "tbody"), by))
    texts = [(p.section, p.subsection, p.text) for p in main.passages]
    assert texts[0] == ("title", None, "On x .") and texts[1] == ("article", "methods", "2. Methods")
    assert "As shown." in texts[2][2] and "(supplementary Figure S4C)" in texts[2][2] and "http" not in texts[2][2]
    assert [a.citation_text for p in main.passages for a in p.annotations] == ["1,2"]
    off = articles.fulltext_passages(spark.createDataFrame([main], articles.fulltexts(spark.createDataFrame([], "xml string")).schema)).orderBy("passage_idx").collect()
    assert [r.offset for r in off] == [sum(len(p.text) for p in main.passages[:i]) for i in range(len(off))]


@pytest.mark.parametrize("s, want, at", [("follow standard practice ANN_1.", "follow standard practice.", 23), ("practice (ANN_1).", "practice.", 7), ("practice [ANN_1].", "practice.", 7), ("practice ANN_1 and", "practice and", 7), ("a ( ANN_1 b", "a (  b", 3)])
def test_markers(s, want, at):
    got, notes = strip_markers(s, {"ANN_1": "x"}, marker=r"ANN_\d+")
    assert got == want and notes[0][2] == at


def test_files(spark, tmp_path):
    (tmp_path / "a.xml").write_text('<?xml version="1.0"?><PubmedArticleSet><PubmedArticle><MedlineCitation><PMID>3</PMID></MedlineCitation></PubmedArticle>\n<PubmedBookArticle/><PubmedArticle><MedlineCitation><PMID>4</PMID></MedlineCitation></PubmedArticle></PubmedArticleSet>')
    got = articles.citations(readers.citation_records(spark, str(tmp_path / "a.xml")), kept=["file"]).collect()
    assert sorted(r.pmid for r in got) == [3, 4]
    for n in "ab":
        (tmp_path / f"{n}.nxml").write_text(f"<article>{n}</article>")
    with tarfile.open(tmp_path / "x.tar.gz", "w:gz") as t:
        for n in "ab":
            t.add(tmp_path / f"{n}.nxml", f"{n}.nxml")
    path = str(tmp_path / "x.tar.gz")
    assert sorted((r.member, r.content) for r in readers.tar_members(spark, path, groups={"x_00": {"src": path, "group": ["b.nxml"]}}).collect()) == [("b.nxml", b"<article>b</article>")]
    assert grouping.only_xml(readers.tar_members(spark, path, listing=True)).count() == 2
    docs = spark.createDataFrame([(1, {"k": "v"}, [({"section": "t"}, 0, "a\t<b>\t")])], "id string, infons map<string,string>, p array<struct<infons:map<string,string>,offset:bigint,text:string>>")
    with pytest.raises(ValueError):
        convert.convert(spark, [str(tmp_path / "a.xml")], "pubmedxml", str(tmp_path / "no"), "pdf")
    (tmp_path / "full.xml").write_text("<set>" + ARTICLE + ARTICLE.replace(">5<", ">6<") + "</set>")
    for kind, name, n in (("pubmedxml", "a.xml", 2), ("pmcxml", "full.xml", 4)):
        convert.convert(spark, [str(tmp_path / name)], kind, str(tmp_path / f"{kind}.bioc"), "biocxml", **({"mark_citations": True} if kind == "pmcxml" else {}))
        convert.convert(spark, [str(tmp_path / name)], kind, str(tmp_path / f"{kind}.txt"), "txt")
        ids = []
        for f in (tmp_path / f"{kind}.bioc").glob("part-*"):
            root = ET.parse(f).getroot()
            assert root.tag == "collection"
            for d in root.iter("document"):
                ids.append(d.findtext("id"))
                at = 0
                for q in d.iter("passage"):
                    assert int(q.findtext("offset")) == at
                    assert all(at <= int(x.get("offset")) < at + len(q.findtext("text")) for x in q.iter("location"))
                    at += len(q.findtext("text"))
        assert len(ids) == n and readers.biocxml(spark, str(tmp_path / f"{kind}.bioc")).count() == n
    assert {"5", "6"} <= set(ids) and spark.read.text(str(tmp_path / "pmcxml.txt")).where("value like '%2. Methods%'").count() == 2
    sinks.write_bioc(docs.withColumnRenamed("p", "passages"), str(tmp_path / "bioc"))
    assert docs.select(sinks.bioc_document("id", "infons", "p").alias("xml")).first().xml.startswith("<document><id>1</id>")
    back = readers.biocxml(spark, str(tmp_path / "bioc")).first()
    assert (back.id, back.infons, back.passages[0].text) == ("1", {"k": "v"}, "a\t<b>\t")
    (tmp_path / "m.tsv").write_text("1\tG\tc\ta|b\tdb\n")
    assert readers.mention_table(spark, str(tmp_path / "m.tsv")).first().mentions == "a|b"
    sinks.swap(docs.select("id"), str(tmp_path / "t"))
    sinks.swap(docs.select("id"), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1 and not (tmp_path / "t.old").exists()
    (tmp_path / "t").rename(tmp_path / "t.old")  # lost between the renames
    assert sinks.restored(spark, str(tmp_path / "t")) and spark.read.parquet(str(tmp_path / "t")).count() == 1
    sinks.save_store(spark.createDataFrame([(1, "b")], "pmid bigint, body string"), str(tmp_path / "s"), "abstract", 5, 7)
    assert spark.read.parquet(str(tmp_path / "s")).first().hash > 0


def test_publication_types(spark):
    kinds = [*text.SKIPPED_TYPES, "Journal Article"]
    xml = "<PubmedArticle><MedlineCitation><PMID>1</PMID><Article><PublicationTypeList>" + "".join(f"<PublicationType>{html.escape(k)}</PublicationType>" for k in kinds) + "</PublicationTypeList></Article></MedlineCitation></PubmedArticle>"
    assert articles.citations(spark.createDataFrame([(xml,)], "xml string")).first().publication_types == ["Journal Article"]


def test_offsets_of_many_passages(spark):
    df = spark.createDataFrame([(1, [("x" * (i % 7),) for i in range(20_000)]), (2, []), (3, [("ab",), (None,), ("c",)])], "pmid int, p array<struct<text:string>>")
    at = time.time()
    got = articles.offsets_in_row(df, "pmid").collect()
    assert time.time() - at < 30
    total = {}
    for r in sorted(got, key=lambda r: (r.pmid, r.passage_idx)):
        assert r.offset == total.get(r.pmid, 0)
        total[r.pmid] = r.offset + len(r.text or "")
    assert len(got) == 20_003


def test_align_nonoverlap_brute(spark):
    """The query against a plain walk over each document: longest spans first, those that touch a chosen one left out."""
    sf = "/root/testdata/sf0.001"
    want = set()
    for d in spark.read.parquet(f"{sf}/documents.parquet").collect():
        w = re.findall(r"\w+", d.text)
        if len(w) < 3:
            continue
        hits = {(m.start(), m.end(), "c1") for m in re.finditer(rf"(?<!\w){w[2]}(?!\w)", d.text)}
        if len(w) > 3:
            hits |= {(m.start(), m.end(), "c2") for m in re.finditer(rf"(?<!\w){w[2]}\s+{w[3]}(?!\w)", d.text)}
        chosen = []
        for s, e, c in sorted(hits, key=lambda h: (h[0] - h[1], -h[0])):
            if all(s > y or e < x for x, y, _ in chosen):
                chosen.append((s, e, c))
        want |= {(d.doc_id, s, e - s, c, d.text[s:e]) for s, e, c in chosen}
    got = catalogue.queries()["align_nonoverlap"](spark, sf).collect()
    assert {(r.pmid, r.offset, r.length, r.conceptid, r.text) for r in got} == want and len(got) == len(want) > 200
