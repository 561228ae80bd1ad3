import hashlib
import io
import json
import tarfile
from urllib.parse import parse_qs, urlparse

import pytest
from pyspark.sql import functions as F

from folio.operators import align, articles, grouping, versions
from folio.plans import commands
from folio.sources import readers, remote, sinks

CITATION = "<PubmedArticleSet><PubmedArticle><MedlineCitation><PMID>{}</PMID></MedlineCitation></PubmedArticle></PubmedArticleSet>"


def test_download(tmp_path):
    body, waits, calls = b"x" * 3_000_000, [], []

    def opener(url, timeout):
        calls.append((url, timeout))
        if len(calls) < 3:
            raise OSError("no answer")
        return io.BytesIO(f"MD5(a.gz)= {hashlib.md5(body).hexdigest()}\n".encode() if url.endswith(".md5") else body)

    at = tmp_path / "a.gz"
    assert remote.download("u/a.gz", str(at), True, opener, wait=waits.append) == hashlib.md5(body).hexdigest()
    assert at.read_bytes() == body and waits == [5, 10] and calls[-1] == ("u/a.gz", 20)
    with pytest.raises(RuntimeError, match="checksum"):
        remote.download("u/b.gz", str(tmp_path / "b.gz"), True, lambda u, t: io.BytesIO(b"MD5(b.gz)= 00" if u.endswith("md5") else b"b"), 2, waits.append)
    with pytest.raises(RuntimeError, match="no checksum"):
        remote.download("u/b.gz", str(tmp_path / "b.gz"), True, lambda u, t: io.BytesIO(b"00  b.gz"), 1)
    assert [p.name for p in tmp_path.iterdir()] == ["a.gz"]


def test_downloads(spark, tmp_path):
    (tmp_path / "from").mkdir()
    (tmp_path / "to").mkdir()
    urls = []
    for k in range(5):
        p = tmp_path / "from" / f"f{k}.gz"
        p.write_bytes(b"z" * k)
        urls.append((p.as_uri(),))
    df = spark.createDataFrame([*urls, urls[0], (None,)], "url string")
    for new in (True, False):
        got = remote.downloads(df, str(tmp_path / "to")).collect()
        assert len(got) == 5 and all(r.fetched is new for r in got)
    assert sorted((p.name, p.stat().st_size) for p in (tmp_path / "to").iterdir()) == [(f"f{k}.gz", k) for k in range(5)]
    assert remote.downloads(df.where("false"), str(tmp_path / "to")).count() == 0


def test_listing(spark):
    pages = {"h/baseline/": "pubmed26n0002.xml.gz pubmed26n0001.xml.gz\npubmed26n0001.xml.gz.md5", "h/updatefiles/": "a pubmed26n0003.xml.gz", "h/none/": "nothing"}
    opener = lambda u, t: io.BytesIO(pages[u].encode())
    got = remote.listing(spark, list(pages), remote.CITATION_FILES, opener=opener).orderBy("ord").collect()
    assert [r.url for r in got] == ["h/baseline/pubmed26n0001.xml.gz", "h/baseline/pubmed26n0002.xml.gz", "h/updatefiles/pubmed26n0003.xml.gz"]
    with pytest.raises(Exception, match="no files at h/none/"):
        remote.listing(spark, list(pages), remote.CITATION_FILES, True, opener).collect()
    assert [remote.local_name(u) for u in ("h/x.baseline.2026.tar.gz", "h/x.incr.tar.gz")] == ["baseline.x.baseline.2026.tar.gz", "update.x.incr.tar.gz"]


def test_fetch(spark, tmp_path):
    asked = []

    def opener(url, timeout):
        q = parse_qs(urlparse(url).query)
        asked.append((q["db"][0], q["id"][0], q["email"][0]))
        return io.BytesIO(CITATION.format(q["id"][0]).encode())

    paths = commands.fetch(spark, "pubmed", "7,8", str(tmp_path), "a@b", str(tmp_path / "out"), opener=opener)
    assert asked == [("pubmed", "7", "a@b"), ("pubmed", "8", "a@b")] and len(paths) == 2
    assert sorted(r.id for r in readers.biocxml(spark, str(tmp_path / "out")).collect()) == ["7", "8"]
    for args in (("books", ["1"], "a"), ("pmc", ["1"] * 11, "a"), ("pmc", ["1"], "")):
        with pytest.raises(ValueError):
            remote.fetch(args[0], args[1], str(tmp_path), args[2], opener)
    assert len(asked) == 2


def test_raw(spark, tmp_path):
    (tmp_path / "c.xml").write_text("<collection><source>s</source><document><id>1</id><passage><offset>0</offset><text>a &amp; b</text></passage></document>\n<document><passage><id>9</id></passage></document></collection>")
    got = sorted((r.id, r.xml) for r in readers.bioc_raw(spark, str(tmp_path / "c.xml")).collect())
    assert [g[0] for g in got] == ["", "1"] and "a &amp; b" in got[1][1] and got[1][1].endswith("</document>")


def test_store_commands(spark, tmp_path):
    main, update, out = (str(tmp_path / n) for n in ("main", "update", "out"))
    body = lambda i, x: f"<document><id>{i}</id>{x}</document>"
    put = lambda rows, path, when, index: sinks.save_store(spark.createDataFrame([(i, body(i, x)) for i, x in rows], "pmid bigint, body string"), path, "abstract", when, index)
    put([(1, "a"), (2, "b"), (3, "c")], main, 10, 1)
    put([(2, "B"), (3, "c"), (4, "d")], update, 20, 2)
    assert [(r.table, r.column, r.type) for r in readers.store_tables(spark, main).orderBy("position").collect()] == [("abstract", "pmid", "bigint"), ("abstract", "body", "string"), ("abstract", "hash", "bigint"), ("abstract", "updated", "bigint"), ("abstract", "file_index", "int")]
    commands.main(["merge", "--main", main, "--update", update, "--out", main], spark)
    assert sorted((r.pmid, r.body, r.updated) for r in spark.read.parquet(main).collect()) == [(1, body(1, "a"), 10), (2, body(2, "B"), 20), (3, body(3, "c"), 10), (4, body(4, "d"), 20)]
    commands.main(["list", "--store", main, "--out", out], spark)
    assert spark.read.csv(out, sep="\t", header=True).count() == 4
    commands.main(["retrieve", "--store", main, "--ids", "4,9,2,4", "--out", str(tmp_path / "got.xml")], spark)
    assert [r.id for r in readers.bioc_raw(spark, str(tmp_path / "got.xml")).collect()] == ["4", "2", "4"]
    spark.createDataFrame([(1, "x")], "pmid string, body string").withColumn("file_index", F.lit(1)).withColumn("kind", F.lit("abstract")).write.partitionBy("kind", "file_index").parquet(str(tmp_path / "odd"))
    with pytest.raises(ValueError, match="schemas"):
        commands.main(["merge", "--main", main, "--update", str(tmp_path / "odd"), "--out", out], spark)
    with pytest.raises(ValueError, match="schemas"):
        versions.upsert(spark.createDataFrame([], "pmid int, updated int, hash int"), spark.createDataFrame([], "pmid bigint, updated int, hash int"))


def test_group_command(spark, tmp_path):
    for a, n in (("x", 5), ("y", 2)):
        with tarfile.open(tmp_path / f"{a}.tar.gz", "w:gz") as t:
            for k in range(n):
                t.addfile(tarfile.TarInfo(f"{a}{k}.nxml"), io.BytesIO())
            t.addfile(tarfile.TarInfo("readme.txt"), io.BytesIO())
    x, y = (str(tmp_path / f"{a}.tar.gz") for a in "xy")
    commands.main(["group", "--archives", x, "--out", str(tmp_path / "g1.json"), "--n", "3"], spark)
    commands.main(["group", "--archives", f"{y},{x}", "--out", str(tmp_path / "g2.json"), "--before", str(tmp_path / "g1.json"), "--n", "1"], spark)
    first, both = (json.loads((tmp_path / f"{g}.json").read_text()) for g in ("g1", "g2"))
    assert first == {"x_00": {"src": x, "group": ["x0.nxml", "x1.nxml", "x2.nxml"]}, "x_01": {"src": x, "group": ["x3.nxml", "x4.nxml"]}}
    assert list(both) == ["x_00", "x_01", "y_00", "y_01"] and {k: both[k] for k in first} == first
    ids = grouping.id_index(spark.createDataFrame([(10,), (9,), (10,), (None,), (1,)], "pmid bigint"))
    sinks.write_index(ids, str(tmp_path / "ids.txt"))
    assert (tmp_path / "ids.txt").read_text() == "1\n10\n9\n"
    sinks.write_index(ids.where("false"), str(tmp_path / "none.txt"))
    assert (tmp_path / "none.txt").read_text() == ""


def test_numbered(spark):
    rows = spark.range(5000).selectExpr("id * 7919 % 5000 as k", "if(id % 3 = 0, 1, id) as pmid")
    got = sorted((r.pmid, r.k, r.ann_no) for r in align.numbered(rows, "pmid", "k").collect())
    assert [g[2] for g in got] == list(range(1, 5001))
    assert align.numbered(rows.where("false"), "pmid", "k").count() == 0


def test_passage_tags(spark):
    xml = spark.createDataFrame([("<article><body><p>a <hi>b</hi> c</p></body></article>",)], "xml string")
    texts = lambda **o: [p.text for p in articles.fulltexts(xml, **o).first().passages]
    assert texts() == ["a b c"] and len(texts(passage_tags=("p", "hi"))) > 1
