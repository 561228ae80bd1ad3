"""Table functions in SQL, paths of nested trees against the walker's, parser dates against the column functions."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from folio.functions import dates, tables
from folio.operators import articles, xmltext


def random_tree(r, depth):
    tag = r.choice(["sec", "p", "table", "td", "title", "b"])
    inner = "".join(random_tree(r, depth - 1) for _ in range(r.randrange(4))) if depth else ""
    return f"<{tag}>{r.choice(['', ' ', 'x y'])}{inner}</{tag}>{r.choice(['', ' t'])}"


def test_text_chunks(spark):
    tables.register(spark)
    r = random.Random(3)
    docs = [(k, k % 3, f"<article><body>{random_tree(r, 4)}</body></article>") for k in range(30)] + [(30, 0, None), (31, 1, "")]
    spark.createDataFrame(docs, "doc_id int, part int, xml string").createOrReplaceTempView("chunk_docs")
    want = {d: xmltext.passages(xmltext.parse(x)) if x else [] for d, _, x in docs}
    got = spark.sql("select d.doc_id, c.* from chunk_docs d, lateral text_chunks(d.xml) c").collect()
    assert sorted((x.doc_id, x.passage_idx, x.text, x.tag, x.xml_path, x.offset) for x in got) == sorted((d, i, c.text, c.tag, c.path, sum(len(y.text) for y in cs[:i])) for d, cs in want.items() for i, c in enumerate(cs))
    got = spark.sql("select * from text_chunks(table(chunk_docs) partition by part order by doc_id)").collect()
    for part in range(3):
        rows = sorted((x for x in got if x.part == part), key=lambda x: x.passage_idx)
        run = [(d, c) for d, p, _ in docs if p == part for c in want[d]]
        assert [(x.doc_id, x.text) for x in rows] == [(d, c.text) for d, c in run] and [x.passage_idx for x in rows] == list(range(len(run)))
        assert [x.offset for x in rows] == [0, *itertools.accumulate(len(c.text) for _, c in run)][: len(rows)]
    with pytest.raises(Exception, match="no column xml"):
        spark.sql("select * from text_chunks(table(select 1 as a))").collect()


def test_node_paths(spark):
    """Nested tables: a path for each element, as the walker gives it to the element's own text."""
    tables.register(spark)
    r = random.Random(8)
    docs = spark.createDataFrame([(k, random_tree(r, 5)) for k in range(25)], "doc_id int, xml string")
    docs = docs.where("xml not like '%</p> t' and xml not like '%> t'")
    nodes = spark.sql("select d.doc_id, n.* from {docs} d, lateral xml_nodes(d.xml) n", docs=docs)
    got = {(x.doc_id, x.id): x.path for x in tables.node_paths(nodes).collect()}
    want = {}
    for d in docs.collect():
        chunks = [c for c in xmltext.walk(xmltext.parse(d.xml)) if not c.tail]
        want |= {(d.doc_id, i): c.path for i, c in enumerate(chunks)}
    assert got == want and len(want) > 60


def test_node_paths_without_driver(spark):
    """Levels meet by shuffles: nothing is broadcast."""
    nodes = spark.createDataFrame([(k, i, i - 1 if i else None, f"t{i}") for k in range(5) for i in range(4)], "doc_id int, id int, parent int, tag string")
    spark.conf.set("spark.sql.maxBroadcastTableSize", "1")
    try:
        got = {(x.doc_id, x.id): x.path for x in tables.node_paths(nodes).collect()}
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")
    assert got == {(k, i): "/".join(f"t{j}" for j in range(i + 1)) for k in range(5) for i in range(4)}


def test_paths_shown(spark):
    """A path is kept for tables' heads and bodies and for figures, or for all."""
    xml = "<article><body><sec><p>a</p><table><thead><tr><th>h</th></tr></thead><tbody><tr><td>b</td></tr></tbody></table><fig><caption><p>f</p></caption></fig></sec></body></article>"
    rows = lambda **o: {p.text: p.xml_path for p in articles.fulltexts(spark.createDataFrame([(xml,)], "xml string"), **o).first().passages}
    some, every = rows(), rows(all_paths=True)
    assert all(every.values()) and some.keys() == every.keys()
    assert some == {t: p if {"thead", "tbody", "fig"} & set(p.split("/")) else None for t, p in every.items()}
    assert some["a"] is None and some["f"] == every["f"] and sum(p is not None for p in some.values()) >= 2
    shown = spark.createDataFrame([(p,) for p in every.values()], "path string").select("path", articles.show_path(F.col("path")).alias("s")).collect()
    assert {x.path: x.s for x in shown} == {p: some[t] for t, p in every.items()}


FREE = ["2001 Jan-Feb", "Spring 1999", "1998 Dec-1999 Jan", "Nov-Jan 2000", "May 1699", "", "no date", "2000 July", "Winter", "1821 Mar 4"]


def test_citation_dates(spark):
    """Dates of journals and histories: the parser's on every case as the column functions'."""
    years, months, days = [None, "2001", "1650", "2100", "x"], [None, "Mar", "3", "13x"], [None, "7", "z"]
    issues = [("", (y, m, d), None) for y in years for m in months for d in days] + [(f, (None, None, None), f) for f in FREE]
    history = [[], [("pubmed", 2003, 4, 5)], [("entrez", 1999, 1, 1), ("pubmed", 2003, 4, 5)], [("x", 2000, 2, 2), ("y", 2001, 1, 1)], [("medline", 1650, 1, 1), ("y", 2001, 1, 1)]]
    rows, tag = [], lambda n, v: f"<{n}>{v}</{n}>" if v is not None else ""
    for k, ((_, (y, m, d), free), h) in enumerate(itertools.product(issues, history)):
        events = "".join(f'<PubMedPubDate PubStatus="{s}">{tag("Year", a)}{tag("Month", b)}{tag("Day", c)}</PubMedPubDate>' for s, a, b, c in h)
        xml = f"<PubmedArticle><MedlineCitation><PMID>{k}</PMID><Article><Journal><JournalIssue><PubDate>{tag('MedlineDate', free)}{tag('Year', y)}{tag('Month', m)}{tag('Day', d)}</PubDate></JournalIssue></Journal></Article></MedlineCitation><PubmedData><History>{events}</History></PubmedData></PubmedArticle>"
        rows.append((k, xml, free, y, m, d, [(i, *e) for i, e in enumerate(h)]))
    df = spark.createDataFrame(rows, "pmid bigint, xml string, free string, y string, m string, d string, h array<struct<i:int,status:string,y:int,m:int,d:int>>")
    parsed = {r.pmid: (r.year, r.month, r.day) for r in articles.citations(df.select("xml")).collect()}
    number = lambda c: F.expr(f"try_cast({c} as int)")
    named = F.coalesce(*[F.when(F.col("m") == n, F.lit(v)) for n, v in dates.NUMBER.items()], number("m"))
    year = F.when((number("y") > 1700) & (number("y") < 2100), number("y"))
    issue = F.when(F.col("free").isNotNull(), dates.medline_date(F.col("free"))).otherwise(dates.date(year, named, number("d")))
    usable = F.filter("h", lambda e: (e["y"] > 1700) & (e["y"] < 2100))
    both = df.select("pmid", dates.earliest(issue, dates.by_status(usable)).alias("x")).select("pmid", "x.*").collect()
    assert {r.pmid: (r.y, r.m, r.d) for r in both} == parsed


def test_most_complete(spark):
    """Dates of full texts, with seasons: the parser's and the column function's choice among all pairs."""
    one = [(y, m, d, s) for y in (None, 1999) for m, s in ((None, None), (5, None), (None, "Oct-Nov"), (None, "Spring")) for d in (None, 3)]
    pairs = list(itertools.product(one, one))
    tag = lambda n, v: f"<{n}>{v}</{n}>" if v is not None else ""
    node = lambda e: f"<pub-date>{tag('year', e[0])}{tag('month', e[1])}{tag('day', e[2])}{tag('season', e[3])}</pub-date>"
    xml = [(f'<article><front><article-meta><article-id pub-id-type="pmid">{k}</article-id>{node(a)}{node(b)}</article-meta></front></article>',) for k, (a, b) in enumerate(pairs)]
    text = lambda v: None if v is None else str(v)
    df = spark.createDataFrame([(k, [(text(e[0]), e[3], text(e[1]), text(e[2])) for e in p]) for k, p in enumerate(pairs)], "k int, ds array<struct<year:string,season:string,month:string,day:string>>")
    for strict in (True, False):
        parsed = {int(r.pmid): (r.year, r.month, r.day) for r in articles.fulltexts(spark.createDataFrame(xml, "xml string"), strict_dates=strict).collect()}
        got = {r.k: (r.y, r.m, r.d) for r in df.select("k", dates.most_complete(F.col("ds"), strict).alias("x")).select("k", "x.*").collect()}
        assert got == parsed


def test_cleanup_shortcut():
    """A text that isn't put through the steps of cleanup is one that they leave alone."""
    r = random.Random(1)
    parts = ["a", "Bé", "日", ".", " ", ", ", ",", ";", "(", ")", "[", "]", "{", "}", "\t", "\n", "\xa0", "​", "  ", " .", "x1", "-", "…", "’", "'"]
    for _ in range(30_000):
        t = want = "".join(r.choice(parts) for _ in range(r.randrange(12)))
        for pattern, new in xmltext._steps:
            want = pattern.sub(new, want)
        assert xmltext.cleanup(t) == want
