"""Queries of whole jobs, each over whole tables, with their SQL oracles: stores, overrides, annotated documents, table functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import tables
from ..operators import annotate, articles, retrieve
from ..sources import sinks, store
from ..streaming import latest
from .catalogue import _SQL_WORDS, ORACLES, _mentions, query, scratch, t


def _esc(c):
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def _infon(key: str, value):
    return F.concat(F.lit(f'<infon key="{key}">'), _esc(value), F.lit("</infon>"))


# --- metadata of an abstract on its full text


@query("""select p.page_id as pmid, case when d.doc_id is null then ['url', 'n'] else ['lang', 'source'] end as keys,
 case when d.doc_id is null then [p.url, length(p.html)::varchar] else [d.lang, d.source] end as values, length(p.html)::bigint as n_text, 1::bigint as passages from pages p left join documents d on d.doc_id = p.page_id""")
def override_documents(spark, sf_dir):
    """Pages as full texts, documents of the same number as their abstracts; what the documents that are retrieved say."""
    # control characters that XML can't hold stand as '?', one for one
    plain = F.regexp_replace("html", r"[\x00-\x08\x0B\x0C\x0E-\x1F\r￾￿]", "?")
    full = F.concat(F.lit("<document><id>"), F.col("page_id").cast("string"), F.lit("</id>"), _infon("url", F.col("url")), _infon("n", F.length("html").cast("string")), F.lit("<passage><infon key=\"section\">body</infon><offset>0</offset><text>"), _esc(plain), F.lit("</text></passage></document>"))
    short = F.concat(F.lit("<document><id>"), F.col("doc_id").cast("string"), F.lit("</id>"), _infon("lang", F.col("lang")), _infon("source", F.col("source")), F.lit("<passage><infon key=\"section\">abstract</infon><offset>0</offset><text/></passage></document>"))
    rows = t(spark, sf_dir, "pages").select(F.lit("fulltext").alias("kind"), F.col("page_id").alias("pmid"), full.alias("body"))
    rows = rows.unionByName(t(spark, sf_dir, "documents").select(F.lit("abstract").alias("kind"), F.col("doc_id").alias("pmid"), short.alias("body")))
    ids = t(spark, sf_dir, "pages").select(F.col("page_id").alias("ord"), F.col("page_id").alias("pmid"))
    got, _ = retrieve.documents(ids, rows, "fulltext")
    part = lambda path: F.xpath("body", F.lit(path))
    return got.select("pmid", part("/document/infon/@key").alias("keys"), part("/document/infon/text()").alias("values"), F.length(F.xpath_string("body", F.lit("/document/passage/text"))).cast("bigint").alias("n_text"), F.size(part("/document/passage/offset/text()")).cast("bigint").alias("passages"))


# --- the first of each file, in a store


@query("""with d as (select source, lang, doc_id, text, doc_id // 3 as pmid, row_number() over (partition by source, doc_id // 3 order by doc_id) as rn from documents where doc_id >= 3),
b as (select source, doc_id, pmid, '<document><id>' || pmid || '</id><infon key="lang">' || lang || '</infon><passage><infon key="section">text</infon><offset>0</offset><text>' || replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</text></passage></document>' as body from d where rn = 1)
select pmid, (100000 + substr(source, 4)::int)::bigint as file_index, 7::bigint as updated, ('0x' || substr(sha256(body), 1, 10))::bigint as hash, length(body)::bigint as n from b""")
def save_first(spark, sf_dir):
    """Documents of each source as a file, three of them under one pmid: what a store has of them (pmid 0 is none)."""
    d = t(spark, sf_dir, "documents")
    passage = F.struct(F.create_map(F.lit("section"), F.lit("text")).alias("infons"), F.lit(0).cast("bigint").alias("offset"), "text")
    docs = d.select(F.col("source").alias("file"), F.lit(0).alias("block"), F.col("doc_id").alias("pos"), F.floor(F.col("doc_id") / 3).cast("string").alias("id"), F.create_map(F.lit("lang"), "lang").alias("infons"), F.array(passage).alias("passages"))
    at = scratch(spark)
    sinks.save_documents(docs, at, "abstract", 7, 100000 + F.substring("file", 4, 9).cast("int"))
    got = spark.read.parquet(at)
    return got.select("pmid", F.col("file_index").cast("bigint").alias("file_index"), "updated", "hash", F.length("body").cast("bigint").alias("n"))


# --- many stores, folded in order


_INPUTS = 7
_ORDERS = "select year(o_orderdate) % 7 as k, case when o_custkey % 2 = 0 then 'fulltext' else 'abstract' end as kind, o_custkey as pmid, max(o_orderkey) as o from orders group by all"
_VERSIONS = f"select x.*, o_orderstatus as body, ascii(o_orderstatus)::bigint as hash, floor(o_totalprice)::bigint as updated, case when kind = 'abstract' then month(o_orderdate)::bigint else -1 end as file_index from ({_ORDERS}) x join orders on o_orderkey = x.o"


def _folded(order: str, source: str, key: str = "kind, pmid") -> str:
    """SQL: the version of each key that stands after a fold in order."""
    return f"""with v as (select {key}, list({{'o': {order}, 't': case when kind = 'fulltext' then updated else file_index end, 'h': hash, 'body': body, 'updated': updated, 'file_index': file_index}} order by {order}) as l from ({source}) group by all),
f as (select {key}, list_reduce(list_transform(l, lambda x: [x]), lambda a, x: case when (x[1].t < a[1].t and x[1].h <> a[1].h) or (x[1].t > a[1].t and x[1].h = a[1].h) then a else x end) as w from v)
select kind, pmid, w[1].body as body, w[1].hash as hash, w[1].updated as updated, w[1].file_index as file_index from f""".replace("w[1].hash", "w[1].h")


def _order_versions(spark, sf_dir):
    o = t(spark, sf_dir, "orders")
    kind = F.when(F.col("o_custkey") % 2 == 0, "fulltext").otherwise("abstract")
    last = o.groupBy((F.year("o_orderdate") % 7).alias("k"), F.col("o_custkey").alias("pmid")).agg(F.max_by(F.struct("o_orderstatus", "o_totalprice", "o_orderdate", "o_custkey"), "o_orderkey").alias("x")).select("k", "pmid", "x.*")
    index = F.when(kind == "abstract", F.month("o_orderdate")).otherwise(-1).cast("bigint")
    return last.select("k", kind.alias("kind"), "pmid", F.col("o_orderstatus").alias("body"), F.ascii("o_orderstatus").cast("bigint").alias("hash"), F.floor("o_totalprice").cast("bigint").alias("updated"), index.alias("file_index"))


@query(_folded("k", _VERSIONS))
def fold_stores(spark, sf_dir):
    """Orders of each year (modulo 7) as a store of its own, folded into a bucketed one: times go up and down from year to year."""
    v, at = _order_versions(spark, sf_dir), scratch(spark)
    store.change(spark, at, [v.where(F.col("k") == k).drop("k") for k in range(3)], 8)
    store.change(spark, at, [v.where(F.col("k") == k).drop("k") for k in range(3, _INPUTS)])
    return store.rows(spark, at)


@query(_folded("k", _VERSIONS))
def stream_latest(spark, sf_dir):
    """The same as a stream: a file a year, each a batch, late ones among them; a second query goes on where the first stopped."""
    at = scratch(spark)
    _order_versions(spark, sf_dir).repartition("k").write.partitionBy("k").parquet(f"{at}/versions")
    v = spark.read.parquet(f"{at}/versions").select("k", "kind", "pmid", "body", "hash", "updated", "file_index")
    schema = v.schema
    for last in (2, _INPUTS - 1):
        for k in range(3 if last > 2 else 0, last + 1):
            v.where(F.col("k") == k).coalesce(1).write.mode("append").parquet(f"{at}/in")
        latest.ingest(spark, f"{at}/in", schema, f"{at}/store", f"{at}/check", lambda d: d.withColumn("ord", F.col("k").cast("string")).drop("k"), buckets=8)
    return store.rows(spark, f"{at}/store")


# --- annotated documents


@query(f"""with {_SQL_WORDS}, f as (select doc_id, source from documents)
select source as file, pmid, 'T' || row_number() over (partition by source order by pmid, s desc) as ann_id, 'c1;c2' as conceptid, (s + 5)::bigint as "offset", length(word)::bigint as length, word as text
from q join f on f.doc_id = q.pmid where word = one""")
def annotated_documents(spark, sf_dir):
    """Documents by source as files, each with its third word as a mention of two concepts."""
    d = t(spark, sf_dir, "documents")
    passage = lambda o, x: F.struct(F.map_from_arrays(F.array(F.lit("section")), F.array(F.lit("s"))).alias("infons"), F.lit(o).cast("bigint").alias("offset"), x.alias("text"))
    docs = d.select(F.col("source").alias("file"), F.floor(F.col("doc_id") / 100).alias("block"), F.col("doc_id").alias("pos"), F.col("doc_id").cast("string").alias("id"), F.create_map(F.lit("pmid"), F.col("doc_id").cast("string")).alias("infons"), F.array(passage(0, F.lit("-----")), passage(5, F.col("text"))).alias("passages"))
    m = _mentions(spark, sf_dir).where("one is not null").select("pmid", F.lit("W").alias("type"), F.explode(F.array(F.lit("c2"), F.lit("c1"))).alias("conceptid"), F.concat(F.lit(" |"), "one").alias("mentions"), F.lit("db").alias("database"))
    got = annotate.annotated(docs, m).select("file", F.col("pos").alias("pmid"), F.explode("passages").alias("p")).select("file", "pmid", F.explode("p.annotations").alias("a"))
    return got.select("file", "pmid", F.col("a.id").alias("ann_id"), F.col("a.infons")["conceptid"].alias("conceptid"), F.col("a.locations")[0]["offset"].alias("offset"), F.col("a.locations")[0]["length"].alias("length"), F.col("a.text").alias("text"))


# --- table functions


@query(f"""with {ORACLES['pmc_parse'].split('with ', 1)[1].split('k as (', 1)[0]}k as (select doc_id, i, text from c where text <> '')
select doc_id, cast(row_number() over w - 1 as int) as passage_idx, text, cast(coalesce(sum(length(text)) over (partition by doc_id order by i rows between unbounded preceding and 1 preceding), 0) as bigint) as "offset",
 case i when 0 then 'body/title' when 1 then 'body/sec/title' else 'body/sec/p' end as xml_path from k window w as (partition by doc_id order by i)""")
def chunks_sql(spark, sf_dir):
    """Passages of documents through SQL."""
    paragraphs = F.array_join(F.transform(F.split(_esc(F.col("text")), "\n"), lambda x: F.concat(F.lit("<p>"), x, F.lit("</p>"))), "")
    xml = F.concat(F.lit("<body><title>T</title><sec><title>2. Methods</title>"), paragraphs, F.lit("</sec></body>"))
    tables.register(spark)
    docs = t(spark, sf_dir, "documents").select("doc_id", xml.alias("xml"))
    return spark.sql("select d.doc_id, c.passage_idx, c.text, c.offset, c.xml_path from {docs} d, lateral text_chunks(d.xml) c", docs=docs)


@query("""with r as (select p_brand, p_partkey, row_number() over (partition by p_brand order by p_partkey) - 1 as k from part),
n as (select p_brand, unnest([0, 1]) as base, unnest(['table', 'table/tbody']) as path from (select distinct p_brand from part)
 union all select p_brand, 2 + 3 * k, 'table/tbody/tr' from r union all select p_brand, 3 + 3 * k, 'table/tbody/tr/td' from r union all select p_brand, 4 + 3 * k, 'table/tbody/tr/td/b' from r)
select p_brand as brand, base::int as id, path from n""")
def xml_paths(spark, sf_dir):
    """Paths of all elements of tables, from a table of nodes."""
    row = F.concat(F.lit("<tr><td>"), F.col("p_partkey").cast("string"), F.lit("<b>"), F.col("p_size").cast("string"), F.lit("</b></td></tr>"))
    rows = t(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("brand")).agg(F.array_sort(F.collect_list(F.struct("p_partkey", row.alias("r")))).alias("rs"))
    docs = rows.select("brand", F.concat(F.lit("<table><tbody>"), F.array_join("rs.r", ""), F.lit("</tbody></table>")).alias("xml"))
    tables.register(spark)
    return tables.node_paths(spark.sql("select d.brand, n.id, n.parent, n.tag from {docs} d, lateral xml_nodes(d.xml) n", docs=docs), "brand")


# --- dates of full texts


_SEASON = "['Jan-Feb', 'Spring', 'May', 'Oct-Nov'][1 + o_orderkey % 4]"
_SEASON_MONTH = "case o_orderkey % 4 when 0 then 1 when 2 then 5 when 3 then 10 end"


@query(f"""select o_orderkey::varchar as pmid, year(o_orderdate)::int as year,
 (case o_orderkey % 3 when 0 then {_SEASON_MONTH} when 1 then month(o_orderdate) else coalesce({_SEASON_MONTH}, month(o_orderdate)) end)::int as month,
 (case when o_orderkey % 3 = 1 then day(o_orderdate) end)::int as day from orders""")
def pmc_dates(spark, sf_dir):
    """The most complete of an article's dates, with seasons: of several equals the first."""
    y, m, d, k = F.year("o_orderdate"), F.month("o_orderdate"), F.dayofmonth("o_orderdate"), F.col("o_orderkey")
    s = F.element_at(F.array(*map(F.lit, ("Jan-Feb", "Spring", "May", "Oct-Nov"))), (k % 4 + 1).cast("int"))
    tag = lambda name, v: F.concat(F.lit(f"<{name}>"), v.cast("string"), F.lit(f"</{name}>"))
    date = lambda *parts: F.concat(F.lit("<pub-date>"), *parts, F.lit("</pub-date>"))
    seasonal = date(tag("year", y), tag("season", s))
    dates = F.when(k % 3 == 0, F.concat(date(tag("year", y)), seasonal)).when(k % 3 == 1, F.concat(seasonal, date(tag("year", y), tag("month", m), tag("day", d)))).otherwise(F.concat(seasonal, date(tag("year", y), tag("month", m))))
    xml = F.concat(F.lit('<article><front><article-meta><article-id pub-id-type="pmid">'), k.cast("string"), F.lit("</article-id>"), dates, F.lit("</article-meta></front></article>"))
    return articles.fulltexts(t(spark, sf_dir, "orders").select(xml.alias("xml")), strict_dates=True).select("pmid", "year", "month", "day")
