"""Whole jobs: stores from files, folds over many stores, retrieval with metadata, annotated documents, conversions that fail."""

import gzip
import hashlib
import io
import json
import random
import tarfile
import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F

from folio.operators import annotate, grouping, retrieve, versions
from folio.plans import commands, convert
from folio.sources import readers, sinks, store

ROW = "kind string, pmid bigint, body string, hash bigint, updated bigint, file_index bigint"


def citation(pmid, title, more=""):
    return f"<PubmedArticle><MedlineCitation><PMID>{pmid}</PMID><Article><ArticleTitle>{title}</ArticleTitle></Article></MedlineCitation>{more}</PubmedArticle>"


def fold(inputs):
    """The rule, one input after the other."""
    have = {}
    for rows in inputs:
        for kind, pmid, body, h, updated, index in rows:
            now, t = have.get((kind, pmid)), updated if kind == "fulltext" else index
            if now:
                old = now[4] if kind == "fulltext" else now[5]
                if t < old and h != now[3] or t > old and h == now[3]:
                    continue
            have[kind, pmid] = (kind, pmid, body, h, updated, index)
    return sorted(have.values())


def random_input(r, index):
    out = []
    for pmid in r.sample(range(30), 12):
        h = r.choice([1, 2, 3])
        out.append(("abstract", pmid, f"a{h}", h, r.randrange(9), index) if r.random() < 0.6 else ("fulltext", pmid, f"f{h}", h, r.randrange(9), -1))
    return out


def put(spark, rows, path):
    spark.createDataFrame(rows, ROW).write.partitionBy("kind", "file_index").parquet(path)


def test_merge_by_file_index(spark, tmp_path):
    """A late file with a later stamp: the file's number decides for abstracts, the stamp for full texts."""
    put(spark, [("abstract", 1, "new", 1, 10, 5), ("fulltext", 1, "old", 1, 10, -1)], str(tmp_path / "m"))
    put(spark, [("abstract", 1, "late", 2, 20, 3), ("fulltext", 1, "newer", 2, 20, -1)], str(tmp_path / "u"))
    commands.main(["merge", "--main", str(tmp_path / "m"), "--update", str(tmp_path / "u"), "--out", str(tmp_path / "o")], spark)
    assert {(r.kind, r.body, r.updated) for r in spark.read.parquet(str(tmp_path / "o")).collect()} == {("abstract", "new", 10), ("fulltext", "newer", 20)}


def test_winners(spark):
    for seed in range(3):
        r = random.Random(seed)
        inputs = [random_input(r, r.randrange(1, 9)) for _ in range(8)]
        every = spark.createDataFrame([(*x, k) for k, rows in enumerate(inputs) for x in rows], ROW + ", input_ord int")
        assert sorted(tuple(x) for x in versions.winners(every).collect()) == fold(inputs)


def test_store_changes_buckets(spark, tmp_path):
    at = str(tmp_path / "s")
    base = [("abstract", k, "x" * 500, 1, 1, 1) for k in range(2000)]
    first = store.change(spark, at, [spark.createDataFrame(base, ROW)], 16)
    assert first == {"touched": 16, "of": 16}
    size = lambda: {p: p.stat().st_size for p in (tmp_path / "s" / "data").rglob("*.parquet")}
    before = size()
    few = [("abstract", 7, "changed", 2, 2, 2), ("fulltext", 7, "full", 3, 2, -1)]
    assert store.change(spark, at, [spark.createDataFrame(few, ROW)])["touched"] == 2
    new = {p: n for p, n in size().items() if p not in before}
    assert len(new) == 2 and sum(new.values()) < 0.2 * sum(before.values())
    assert store.change(spark, at, [])["touched"] == 0 and store.change(spark, at, [spark.createDataFrame([], ROW)])["touched"] == 0
    want = fold([base, few])
    assert sorted(tuple(r) for r in store.rows(spark, at).collect()) == want
    ids = spark.createDataFrame([(0, 7), (1, 5000)], "ord int, pmid bigint")
    seen = store.lookup(spark, at, ids)
    assert seen.where("pmid = 7").count() == 2 and seen.count() < 500
    # a change that is lost before its manifest leaves the store as it was
    (tmp_path / "s" / "data" / "write=lost" / "kind=abstract" / "bucket=0").mkdir(parents=True)
    assert sorted(tuple(r) for r in store.rows(spark, at).collect()) == want
    for k in range(3):
        store.change(spark, at, [spark.createDataFrame([("abstract", 7, f"c{k}", 10 + k, 2, 3 + k)], ROW)])
    assert len(list((tmp_path / "s" / "_manifest").glob("0*"))) == 2 and store.rows(spark, at).count() == 2001
    assert store.rows(spark, at).where("pmid = 7 and kind = 'abstract'").first().body == "c2"


def test_merge_folder(spark, tmp_path):
    r = random.Random(4)
    inputs = [random_input(r, k) for k in (3, 1, 2)]
    for name, rows in zip(("a", "b", "c"), inputs):
        put(spark, rows, str(tmp_path / "in" / name))
    (tmp_path / "in" / "d").mkdir()
    got = commands.merge_folder(spark, str(tmp_path / "main"), str(tmp_path / "in"), True, 8)
    # within a store of several files, full texts (-1) come first
    ordered = [[x for x in rows if x[5] == f] for rows in inputs for f in sorted({x[5] for x in rows})]
    assert (got["used"], got["skipped"]) == (3, 1) and sorted(tuple(x) for x in store.rows(spark, str(tmp_path / "main")).collect()) == fold(ordered)
    assert commands.merge_folder(spark, str(tmp_path / "main"), str(tmp_path / "in")) == {"touched": 0, "of": got["of"], "used": 0, "skipped": 4}
    with pytest.raises(ValueError, match="no store"):
        commands.merge_folder(spark, str(tmp_path / "none"), str(tmp_path / "in"))
    commands.main(["list", "--store", str(tmp_path / "main"), "--out", str(tmp_path / "l")], spark)
    assert spark.read.csv(str(tmp_path / "l"), sep="\t", header=True).count() == len(fold(ordered))


@pytest.mark.parametrize("split", ["700", "128m"])
def test_first_of_a_file(spark, tmp_path, split):
    """However a file is split: the first record of each pmid, as a reader from its start finds it."""
    r, size = random.Random(9), spark.conf.get("spark.sql.files.maxPartitionBytes")
    records = [(r.randrange(1, 25), f"Title {k} {'pad ' * r.randrange(30)}end.") for k in range(120)]
    (tmp_path / "pubmed26n0007.xml").write_text("<PubmedArticleSet>\n" + "\n".join(citation(*x) for x in records) + "</PubmedArticleSet>")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        docs = convert.parsed(spark, str(tmp_path / "pubmed26n0007.xml"), "pubmedxml")
        assert (docs.rdd.getNumPartitions() > 5) == (split == "700")
        sinks.save_documents(docs.drop("failed"), str(tmp_path / "s"), "abstract", 99, F.lit(7))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    first = {}
    for p, t in records:
        first.setdefault(p, " ".join(t.split()))
    got = spark.read.parquet(str(tmp_path / "s")).collect()
    assert {x.pmid: ET.fromstring(x.body).findtext("infon[@key='title']") for x in got} == first
    assert {(x.kind, x.updated, x.file_index) for x in got} == {("abstract", 99, 7)} and len(got) == len(first)


def test_pubmed_job(spark, tmp_path):
    (tmp_path / "from").mkdir()
    (tmp_path / "to").mkdir()
    for n, ids in ((1, (5, 6, 5)), (2, (6, 7))):
        body = gzip.compress(("<PubmedArticleSet>" + "".join(citation(i, f"T{n} {i}.") for i in ids) + "</PubmedArticleSet>").encode())
        (tmp_path / "from" / f"pubmed26n000{n}.xml.gz").write_bytes(body)
        (tmp_path / "from" / f"pubmed26n000{n}.xml.gz.md5").write_text(f"MD5(pubmed26n000{n}.xml.gz)= {hashlib.md5(body).hexdigest()}\n")
    urls = spark.createDataFrame([((tmp_path / "from" / f"pubmed26n000{n}.xml.gz").as_uri(),) for n in (1, 2)], "url string")
    assert commands.pubmed(spark, urls, str(tmp_path / "to"), str(tmp_path / "stores" / "all"), 50) == {"read": 5}
    rows = spark.read.parquet(str(tmp_path / "stores" / "all"))
    assert sorted((r.pmid, r.file_index, "T" in r.body) for r in rows.collect()) == [(5, 260001, True), (6, 260001, True), (6, 260002, True), (7, 260002, True)]
    commands.merge_folder(spark, str(tmp_path / "main"), str(tmp_path / "stores"))
    assert {(r.pmid, r.file_index) for r in store.rows(spark, str(tmp_path / "main")).collect()} == {(5, 260001), (6, 260002), (7, 260002)}
    assert commands.pubmed(spark, urls, str(tmp_path / "to"), str(tmp_path / "txt"), 50, "txt") == {"read": 5}


def test_pmc_job(spark, tmp_path):
    page = lambda i, x: f'<article><front><article-meta><article-id pub-id-type="pmid">{i}</article-id><title-group><article-title>{x}</article-title></title-group></article-meta></front><body><p>Body {i}</p></body></article>'
    with tarfile.open(tmp_path / "x.tar.gz", "w:gz") as t:
        for k, (i, x) in enumerate([(1, "A"), (2, "B"), (2, "C"), (3, "D")]):
            body = page(i, x).encode()
            info = tarfile.TarInfo(f"m{k}.nxml")
            info.size = len(body)
            t.addfile(info, io.BytesIO(body))
    (tmp_path / "g.json").write_text(json.dumps({"x_00": {"src": "x.tar.gz", "group": ["m0.nxml", "m1.nxml", "m2.nxml"]}, "x_01": {"src": "x.tar.gz", "group": ["m3.nxml"]}, "bad": {"src": "x.tar.gz", "group": ["m9.nxml"]}}))
    run = lambda names, out: commands.pmc(spark, str(tmp_path), str(tmp_path / "g.json"), names, str(tmp_path / out), 9)
    assert run("x_00", "one") == {"read": 3}
    got = {r.pmid: ET.fromstring(r.body).findtext("infon[@key='title']") for r in spark.read.parquet(str(tmp_path / "one")).collect()}
    assert got == {1: "A", 2: "B"}
    run("x_00,x_01", "two")
    assert {(r.pmid, r.kind, r.file_index) for r in spark.read.parquet(str(tmp_path / "two")).collect()} == {(i, "fulltext", -1) for i in (1, 2, 3)}
    with pytest.raises(Exception, match="m9.nxml"):
        run("bad", "three")
    with pytest.raises(ValueError, match="no such group"):
        run("none", "four")


def brute_override(full, abstract):
    f, a = ET.fromstring(full), ET.fromstring(abstract)
    rest = [c for c in f if c.tag != "infon"]
    root = ET.Element("document")
    root.extend([rest[0], *[c for c in a if c.tag == "infon"], *rest[1:]])
    return root


def test_override(spark, tmp_path):
    full = '<document><id>1</id><infon key="title">F &amp; f</infon><infon key="pmcid">P1</infon><passage><infon key="section">body</infon><offset>0</offset><text>é &lt;b&gt;</text></passage><infon key="late">x</infon></document>'
    short = '<document><id>1</id>\n<infon key="title">A &lt; a</infon>\n<infon key="year">2001</infon><passage><infon key="section">abstract</infon><offset>0</offset><text></text></passage></document>'
    rows = spark.createDataFrame([("fulltext", 1, full, 1, 1, -1), ("abstract", 1, short, 1, 1, 1), ("fulltext", 2, full.replace(">1<", ">2<"), 1, 1, -1), ("abstract", 3, short.replace(">1<", ">3<"), 1, 1, 1)], ROW)
    ids = readers.id_list(spark, ids="2,1,3,9,1")
    flat = lambda e: [(x.tag, dict(x.attrib), (x.text or "").strip()) for x in e.iter()]
    for mode, want in (("all", {0: "2f", 1: "1f", 2: "3a", 4: "1f"}), ("fulltext", {0: "2f", 1: "1f", 4: "1f"}), ("abstracts", {1: "1a", 2: "3a", 4: "1a"})):
        got, gone = retrieve.documents(ids, rows, mode)
        have = {r.ord: r for r in got.collect()}
        assert {k: f"{r.pmid}{r.kind[0]}" for k, r in have.items()} == want
        assert {r.ord for r in gone.collect()} == set(range(5)) - set(want)
        if mode != "abstracts":
            assert have[0].body == full.replace(">1<", ">2<") and flat(ET.fromstring(have[1].body)) == flat(brute_override(full, short))
    store.change(spark, str(tmp_path / "s"), [rows], 4)
    commands.main(["retrieve", "--store", str(tmp_path / "s"), "--ids", "2,1,3,9,1", "--out", str(tmp_path / "o.xml")], spark)
    docs = ET.parse(tmp_path / "o.xml").getroot().findall("document")
    assert [d.findtext("id") for d in docs] == ["2", "1", "3", "1"] and [d.findtext("infon") for d in docs] == ["F & f", "A < a", "A < a", "A < a"]
    odd = rows.withColumn("body", F.when(F.col("kind") == "fulltext", "<document><infon key='a'>b</infon></document>").otherwise(F.col("body")))
    with pytest.raises(Exception, match="first part of a document"):
        retrieve.documents(ids, odd)[0].collect()


def test_convert_loses_nothing(spark, tmp_path):
    for n, x in (("a", "<article><body><p>fine</p></body></article>"), ("b", "<article><body><p>broken</body></article>")):
        (tmp_path / f"{n}.nxml").write_text(x)
    path = [str(tmp_path / "*.nxml")]
    with pytest.raises(RuntimeError, match="b.nxml: ParseError"):
        convert.convert(spark, path, "pmcxml", str(tmp_path / "o1"), "biocxml")
    convert.main(["--i", path[0], "--iFormat", "pmcxml", "--o", str(tmp_path / "o2"), "--oFormat", "biocxml", "--errors", str(tmp_path / "e")], spark)
    bad = spark.read.json(str(tmp_path / "e")).collect()
    assert len(bad) == 1 and bad[0].file.endswith("b.nxml") and "ParseError" in bad[0].failed and readers.biocxml(spark, str(tmp_path / "o2")).count() == 1
    (tmp_path / "c.xml").write_text("<S>" + citation(1, "ok.") + citation("", "no id.") + citation(2, "two.") + "</S>")
    assert convert.convert(spark, [str(tmp_path / "c.xml")], "pubmedxml", str(tmp_path / "o3"), "txt", errors=str(tmp_path / "e2")) == {"read": 3, "failed": 1, "written": 2}
    with pytest.raises(Exception, match="no PMID"):
        convert.convert(spark, [str(tmp_path / "c.xml")], "pubmedxml", str(tmp_path / "o4"), "txt", strict=True)
    (tmp_path / "two.nxml").write_text("<article><front><article-meta><title-group><article-title>a</article-title><article-title>b</article-title></title-group></article-meta></front></article>")
    with pytest.raises(Exception, match="more than one title"):
        convert.convert(spark, [str(tmp_path / "two.nxml")], "pmcxml", str(tmp_path / "o5"), "txt", strict=True)


def plain_annotations(docs, mentions):
    """T numbers, ids and places by walking files, documents, passages."""
    import re

    out = []
    for _, infons, passages in docs:
        for offset, text in passages:
            hits = {}
            for pmid, kind, concept, names in mentions if infons.get("pmid") else []:
                if str(pmid) != infons["pmid"]:
                    continue
                for m in filter(None, (x.strip() for x in names.split("|"))):
                    for x in re.finditer(rf"(?<!\w){re.escape(m)}(?!\w)", text):
                        hits.setdefault(x.span(), {}).setdefault(kind, set()).add(concept)
            taken = []
            for s, e in sorted(hits, key=lambda h: (h[0] - h[1], -h[0])):
                if all(s > y or x > e for x, y in taken):
                    taken.append((s, e))
                    out += [(f"T{len(out) + 1 + i}", kind, ";".join(sorted(c)), text[s:e], offset + s, e - s) for i, (kind, c) in enumerate(sorted(hits[s, e].items()))]
    return out


def test_annotated_documents(spark, tmp_path):
    r = random.Random(6)
    words = ["aa", "bb", "cc", "dd", "x1", "ee"]
    docs = []
    for k in range(150):
        texts, at, ps = [" ".join(r.choice(words) for _ in range(r.randrange(9))) for _ in range(r.randrange(4))], 0, []
        for t in texts:
            ps.append((at, t))
            at += len(t)
        docs.append((f"d{k}", {"pmid": r.choice(["", "1", "2", "3"])} if k % 7 else {}, ps))
    mentions = [(1, "G", "g1", "aa bb|cc"), (1, "C", "c1", "cc"), (1, "G", "g0", "cc| "), (2, "G", "g2", "dd ee dd|ee"), (2, "D", "d", "bb aa"), (9, "G", "z", "aa"), (3, "G", "n", " ")]
    df = spark.createDataFrame([(i, inf, [({"section": "s"}, o, t) for o, t in ps]) for i, inf, ps in docs], "id string, infons map<string,string>, passages array<struct<infons:map<string,string>,offset:bigint,text:string>>")
    sinks.write_bioc(df.coalesce(1), str(tmp_path / "in"))
    (tmp_path / "m.tsv").write_text("".join(f"{p}\t{k}\t{c}\t{m}\tdb\n" for p, k, c, m in mentions))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900")  # many splits of one file
    try:
        n = commands.annotate_file(spark, str(tmp_path / "in"), str(tmp_path / "m.tsv"), str(tmp_path / "out"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    back = readers.biocxml(spark, str(tmp_path / "out")).orderBy("file", "block", "pos").collect()
    got = [(a.id, a.infons["type"], a.infons["conceptid"], a.text, a.locations[0].offset, a.locations[0].length) for d in back for p in d.passages for a in p.annotations]
    want = plain_annotations(docs, mentions)
    assert [d.id for d in back] == [d[0] for d in docs] and got == want and len(want) > 60 and n == {"documents": 150, "annotations": len(want)}
    # a second run replaces what is there, and a round trip loses nothing
    again = annotate.annotated(readers.biocxml(spark, str(tmp_path / "out")), readers.mention_table(spark, str(tmp_path / "m.tsv")).where("pmid <> 1"))
    left = [a.infons["conceptid"] for d in again.orderBy("file", "block", "pos").collect() for p in d.passages for a in p.annotations]
    assert left and set(left) <= {"g2", "d"}


def test_citation_notes(spark):
    xml = sinks.bioc_xml("1", {}, [{"infons": {}, "offset": 0, "text": "ab", "annotations": [{"id": "a", "citation_text": "1", "offset": 2, "length": 0}]}])
    note = ET.fromstring(xml).find(".//annotation")
    assert {i.get("key"): i.text for i in note.iter("infon")} == {"citation_text": "1", "type": "citation"}


def test_groups(spark):
    rows = spark.createDataFrame([("x_00", "x", "b", 1), ("x_00", "x", "a", 0)], "group_name string, src string, member string, ord int")
    assert grouping.groupings(rows).first().group == ["a", "b"]
