"""The query catalogue of the core operators: each query with its SQL oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import arrow, dates, metadata, spans, text
from ..operators import align, articles, grouping, retrieve, versions
from ..sources import sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder's path in the shared folder."""
    import tempfile
    import uuid

    at = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
        at = tempfile.mkdtemp(prefix="folio-scratch-")
    path = f"{at}/folio-{uuid.uuid4().hex}"
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _sql_chain(col: str, steps: list[tuple[str, str]]) -> str:
    for pattern, new in steps:
        col = f"regexp_replace({col}, {_q(pattern)}, {_q(new.replace('$1', chr(92) + '1'))}, 'g')"
    return col


#: The Java steps in RE2's syntax: only the control class differs.
SQL_CLEANUP = [(r"[\x00-\x08\x0a-\x1f\x7f-\x9f\p{Cf}\p{Co}]" if "&&" in p else p, n) for p, n in text.CLEANUP]
SPICED = "concat(substr(text, 1, 40), '( ; ) [ ] {} (Fig. 1) [ok] ', substr(text, 41))"


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = t(spark, sf_dir, "documents")
    return d.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("passage_idx", "line"))


@query(f"select doc_id, {_sql_chain('text', SQL_CLEANUP)} as cleaned from documents")
def cleanup_text(spark, sf_dir):
    return t(spark, sf_dir, "documents").select("doc_id", text.cleanup(F.col("text")).alias("cleaned"))


@query(f"select doc_id, {_sql_chain(SPICED, text.EMPTY_BRACKETS)} as stripped from documents")
def strip_empty_brackets(spark, sf_dir):
    return t(spark, sf_dir, "documents").select("doc_id", text.strip_empty_brackets(F.expr(SPICED)).alias("stripped"))


@query("select p_partkey, case when p_partkey % 2 = 0 then p_name || '.' else p_name end as title from part")
def title_brackets(spark, sf_dir):
    raw = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit(" ["), "p_name", F.lit("]. "))).otherwise(F.col("p_name"))
    return t(spark, sf_dir, "part").select("p_partkey", text.title_without_brackets(raw).alias("title"))


@query("select doc_id, array_to_string(list_transform(string_split(text, '.'), lambda x: x[1:40]), '.') as trimmed from documents")
def trim_sentences(spark, sf_dir):
    return t(spark, sf_dir, "documents").select("doc_id", text.trim_sentences(F.col("text"), 40).alias("trimmed"))


@query(f"""with l as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as passage_idx from documents),
c as (select doc_id, cast(passage_idx as int) as passage_idx, {_sql_chain('line', SQL_CLEANUP)} as text from l)
select doc_id, passage_idx, text, cast(coalesce(sum(length(text)) over (partition by doc_id order by passage_idx rows between unbounded preceding and 1 preceding), 0) as bigint) as "offset" from c""")
def passages_offsets(spark, sf_dir):
    d = t(spark, sf_dir, "documents")
    return articles.offsets_in_row(d.select("doc_id", F.transform(F.split("text", "\n", -1), lambda x: F.struct(text.cleanup(x).alias("text"))).alias("p")), "doc_id")


@query("select conv_id, string_agg(text || chr(10) || chr(10), '' order by turn) as text from conversations group by conv_id")
def txt_export(spark, sf_dir):
    return sinks.plain_text(t(spark, sf_dir, "conversations"), "conv_id", order="turn")


@query("""select conv_id, turn, last_value(case when role = 'user' then text end ignore nulls) over (partition by conv_id order by turn rows between unbounded preceding and current row) as subsection from conversations""")
def carry_section(spark, sf_dir):
    c = t(spark, sf_dir, "conversations").withColumn("header", F.when(F.col("role") == "user", F.col("text")))
    return articles.carry_subsection(c, "conv_id", order="turn").select("conv_id", "turn", "subsection")


_NAMES = ", ".join(_q(s) for s in text.SUBSECTIONS)


@query(f"""select doc_id, n, case when trim(lower(h), '0123456789. ') in ({_NAMES}) then trim(lower(h), '0123456789. ') end as subsection
from (select doc_id, doc_id % 5 as n, case doc_id % 5 when 0 then '2. Methods' when 1 then 'RESULTS' when 2 then ' 10 Discussion. ' when 3 then text else 'Methods!' end as h from documents)""")
def section_whitelist(spark, sf_dir):
    n = F.col("doc_id") % 5
    h = F.when(n == 0, "2. Methods").when(n == 1, "RESULTS").when(n == 2, " 10 Discussion. ").when(n == 3, F.col("text")).otherwise("Methods!")
    return t(spark, sf_dir, "documents").select("doc_id", n.alias("n"), text.subsection(h).alias("subsection"))


@query("select source, md5(text) as pmid, min(doc_id) as doc_id from documents group by 1, 2")
def first_wins_dedupe(spark, sf_dir):
    d = t(spark, sf_dir, "documents").select("source", F.md5("text").alias("pmid"), "doc_id")
    return versions.first_in_file(d, "source", "doc_id", "pmid")


@query("""with v as (select user_id, event_id, event_type, lag(event_type) over (partition by user_id order by event_id) as b from events),
s as (select *, last_value(case when b is null or b <> event_type then event_id end ignore nulls) over (partition by user_id order by event_id rows between unbounded preceding and current row) as stamp,
 row_number() over (partition by user_id order by event_id desc) as rn from v)
select user_id as pmid, event_type as hash, stamp as time from s where rn = 1""")
def version_merge_ordered(spark, sf_dir):
    e = t(spark, sf_dir, "events").select(F.col("user_id").alias("pmid"), F.col("event_id").alias("time"), F.col("event_type").alias("hash"), F.col("event_id").alias("input_ord"))
    return versions.merge_ordered(e)


@query("""with v as (select user_id as pmid, list({'o': md5(cast(event_id as varchar)), 't': event_id, 'h': event_type} order by md5(cast(event_id as varchar))) as l from events group by 1),
f as (select pmid, list_reduce(list_transform(l, lambda x: [x]), lambda a, x: case when (x[1].t < a[1].t and x[1].h <> a[1].h) or (x[1].t > a[1].t and x[1].h = a[1].h) then a else x end) as w from v)
select pmid, w[1].h as hash, w[1].t as time, w[1].o as input_ord from f""")
def version_merge_exact(spark, sf_dir):
    e = t(spark, sf_dir, "events").select(F.col("user_id").alias("pmid"), F.col("event_id").alias("time"), F.col("event_type").alias("hash"), F.md5(F.col("event_id").cast("string")).alias("input_ord"))
    return versions.merge_exact(e)


_OLD = "select o_custkey as pmid, max(o_orderkey) as updated, max(o_orderstatus) as hash from orders where o_orderkey % 2 = 0 group by 1"
_NEW = "select o_custkey as pmid, min(o_orderkey) as updated, max(o_orderstatus) as hash from orders where o_orderkey % 2 = 1 group by 1"


@query(f"""with c as ({_OLD}), i as ({_NEW}),
ok as (select * from i where not exists (select 1 from c where c.pmid = i.pmid and ((i.updated < c.updated and i.hash <> c.hash) or (i.updated > c.updated and i.hash = c.hash))))
select * from c where pmid not in (select pmid from ok) union all select * from ok""")
def upsert_two_stores(spark, sf_dir):
    o = t(spark, sf_dir, "orders")
    side = lambda odd, f: o.where(F.col("o_orderkey") % 2 == odd).groupBy(F.col("o_custkey").alias("pmid")).agg(f("o_orderkey").alias("updated"), F.max("o_orderstatus").alias("hash"))
    return versions.upsert(side(0, F.max), side(1, F.min))


@query("""select pmid, arg_max(body, (r, time)) as body, max(r) as kind_rank from (select doc_id as pmid, text as body, 0 as r, n_chars as time from documents
union all select page_id, url, 1, length(html) from pages) group by pmid""")
def latest_view(spark, sf_dir):
    a = t(spark, sf_dir, "documents").select(F.col("doc_id").alias("pmid"), F.col("text").alias("body"), F.lit(0).alias("kind_rank"), F.col("n_chars").cast("bigint").alias("time"))
    f = t(spark, sf_dir, "pages").select(F.col("page_id").alias("pmid"), F.col("url").alias("body"), F.lit(1).alias("kind_rank"), F.length("html").cast("bigint").alias("time"))
    return versions.latest_view(a.unionByName(f)).select("pmid", "body", "kind_rank")


def _stores(spark, sf_dir):
    a = t(spark, sf_dir, "documents").select(F.col("doc_id").alias("pmid"), F.col("text").alias("body"), F.lit(1).cast("bigint").alias("file_index"), F.col("n_chars").cast("bigint").alias("updated"), F.concat(F.lit("a "), "lang").alias("infons")).withColumn("hash", text.hash40(F.col("body")))
    f = t(spark, sf_dir, "pages").select((F.col("page_id") * 3).alias("pmid"), F.col("html").alias("body"), F.length("html").cast("bigint").alias("updated"), F.concat(F.lit("f "), "url").alias("infons")).withColumn("hash", text.hash40(F.col("body")))
    return a, f


_SQL_STORES = """a as (select doc_id as pmid, text as body, 1::bigint as file_index, n_chars as updated, 'a ' || lang as infons, ('0x' || substr(sha256(text), 1, 10))::bigint as hash from documents),
f as (select page_id * 3 as pmid, html as body, length(html)::bigint as updated, 'f ' || url as infons, ('0x' || substr(sha256(html), 1, 10))::bigint as hash from pages)"""


@query(f"with {_SQL_STORES} select 'abstract' as type, pmid, hash, updated, file_index from a union all select 'fulltext', pmid, hash, updated, -1 from f")
def list_store(spark, sf_dir):
    return retrieve.listing(*_stores(spark, sf_dir))


def _ids(spark, sf_dir):
    """Requested ids: every third, twice for some, some that don't exist."""
    d = t(spark, sf_dir, "documents")
    return d.where("doc_id % 3 = 0").select((F.col("doc_id") * 2).alias("ord"), F.col("doc_id").alias("pmid")).unionByName(d.where("doc_id % 30 = 0").select((F.col("doc_id") * 2 + 1).alias("ord"), F.when(F.col("doc_id") % 60 == 0, F.col("doc_id") + 10_000_000).otherwise(F.col("doc_id")).alias("pmid")))


_SQL_IDS = "ids as (select doc_id * 2 as ord, doc_id as pmid from documents where doc_id % 3 = 0 union all select doc_id * 2 + 1, case when doc_id % 60 = 0 then doc_id + 10000000 else doc_id end from documents where doc_id % 30 = 0)"
_FULL = "case when f.pmid is not null then {'kind': 'fulltext', 'body': f.body, 'infons': coalesce(a.infons, f.infons)} end"
_ABSTRACT = "case when a.pmid is not null then {'kind': 'abstract', 'body': a.body, 'infons': a.infons} end"


def _sql_retrieve(pick: str) -> str:
    return f"with {_SQL_STORES}, {_SQL_IDS}, r as (select ord, ids.pmid, {pick} as r from ids left join a on a.pmid = ids.pmid left join f on f.pmid = ids.pmid) select ord, pmid, r.kind as kind, r.body as body, r.infons as infons from r where r is not null"


@query(_sql_retrieve(f"coalesce({_FULL}, {_ABSTRACT})"))
def retrieve_all(spark, sf_dir):
    return retrieve.retrieve(_ids(spark, sf_dir), *_stores(spark, sf_dir), "all")[0]


@query(_sql_retrieve(_FULL))
def retrieve_fulltext(spark, sf_dir):
    return retrieve.retrieve(_ids(spark, sf_dir), *_stores(spark, sf_dir), "fulltext")[0]


@query(_sql_retrieve(_ABSTRACT))
def retrieve_abstracts(spark, sf_dir):
    return retrieve.retrieve(_ids(spark, sf_dir), *_stores(spark, sf_dir), "abstracts")[0]


@query(f"with {_SQL_STORES} select f.pmid, coalesce(a.infons, f.infons) as infons from f left join a on a.pmid = f.pmid")
def metadata_override(spark, sf_dir):
    a, f = _stores(spark, sf_dir)
    return retrieve.retrieve(f.select(F.col("pmid").alias("ord"), "pmid"), a, f, "fulltext")[0].select("pmid", "infons")


@query(f"with {_SQL_STORES}, {_SQL_IDS} select ord, pmid from ids where not exists (select 1 from a where a.pmid = ids.pmid) and not exists (select 1 from f where f.pmid = ids.pmid)")
def missing_ids(spark, sf_dir):
    return retrieve.retrieve(_ids(spark, sf_dir), *_stores(spark, sf_dir), "all")[1]


@query("select url from pages where page_id % 4 = 1 except select url from pages where page_id % 4 <> 1")
def unexpected_files(spark, sf_dir):
    p = t(spark, sf_dir, "pages")
    return retrieve.missing(p.where("page_id % 4 = 1").select("url").distinct(), p.where("page_id % 4 <> 1"), "url")


@query("select printf('%s_%02d', source, cast(floor((row_number() over (partition by source order by doc_id) - 1) / 20) as int)) as group_name, source as src, doc_id as member, doc_id as ord from documents")
def group_chunks(spark, sf_dir):
    d = t(spark, sf_dir, "documents").select(F.col("source").alias("src"), F.col("doc_id").alias("member"), F.col("doc_id").alias("ord"))
    return grouping.group_members(d, 20)


@query("select distinct source as src from documents where source not in (select source from documents where doc_id % 100 = 7)")
def incremental_groups(spark, sf_dir):
    d = t(spark, sf_dir, "documents").select(F.col("source").alias("src"), "doc_id")
    return grouping.not_yet_grouped(d.select("src").distinct(), d.where("doc_id % 100 = 7"))


@query("select distinct cast(l_orderkey as varchar) as pmid from lineitem order by 1")
def pmid_index(spark, sf_dir):
    return grouping.id_index(t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("pmid")))


@query("select doc_id, ('0x' || substr(sha256(text), 1, 10))::bigint as hash from documents")
def hash40(spark, sf_dir):
    return t(spark, sf_dir, "documents").select("doc_id", text.hash40(F.col("text")).alias("hash"))


@query("select doc_id, md5(text) as md5 from documents")
def md5_check(spark, sf_dir):
    d = t(spark, sf_dir, "documents")
    files = d.select(F.concat(F.lit("/in/"), F.col("doc_id").cast("string")).alias("path"), "doc_id", F.encode("text", "UTF-8").alias("content"))
    from ..sources.readers import checked

    sums = d.select(F.concat(F.lit("MD5("), F.col("doc_id").cast("string"), F.lit(")= "), F.md5("text")).alias("value"))
    return checked(files, sums).select("doc_id", F.md5("content").alias("md5"))


_MONTHS = "[" + ", ".join(_q(n) for n in dates.NAMES) + "]"
_NUMBERS = "map {" + ", ".join(f"{_q(n)}: {i}" for n, i in dates.NUMBER.items()) + "}"
_RANGE = "case o_orderkey % 4 when 0 then strftime(o_orderdate, '%Y %b') || '-' || strftime(o_orderdate + interval 1 month, '%b') when 1 then strftime(o_orderdate, '%B %Y') when 2 then 'Spring ' || strftime(o_orderdate, '%Y') else strftime(o_orderdate, '%b') || '-May 1699' end"


@query(f"""select o_orderkey, cast(nullif(regexp_extract(s, '((18|19|20)\\d\\d)', 1), '') as int) as y,
{_NUMBERS}[list_filter({_MONTHS}, lambda n: contains(s, n))[1]] as m from (select o_orderkey, {_RANGE} as s from orders)""")
def medline_date(spark, sf_dir):
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 4
    s = F.when(k == 0, F.concat(F.date_format(d, "yyyy MMM"), F.lit("-"), F.date_format(F.add_months(d, 1), "MMM"))).when(k == 1, F.date_format(d, "MMMM yyyy")).when(k == 2, F.concat(F.lit("Spring "), F.date_format(d, "yyyy"))).otherwise(F.concat(F.date_format(d, "MMM"), F.lit("-May 1699")))
    return t(spark, sf_dir, "orders").select("o_orderkey", dates.medline_date(s).alias("x")).select("o_orderkey", "x.y", "x.m")


@query("""with s as (select l_orderkey, min(l_shipdate) as d from lineitem group by 1),
x as (select o_orderkey, year(o_orderdate) as jy, case when o_orderkey % 3 > 0 then month(o_orderdate) end as jm, case when o_orderkey % 3 = 2 then day(o_orderdate) end as jd, year(d) as ey, month(d) as em, day(d) as ed from orders left join s on l_orderkey = o_orderkey),
y as (select *, (coalesce(jy, 9999), coalesce(jm, 9999), coalesce(jd, 9999)) < (coalesce(ey, 9999), coalesce(em, 9999), coalesce(ed, 9999)) as j from x)
select o_orderkey, cast(case when j then jy else ey end as int) as y, cast(case when j then jm else em end as int) as m, cast(case when j then jd else ed end as int) as d from y""")
def pub_date_pick(spark, sf_dir):
    o = t(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    s = t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min("l_shipdate").alias("d"))
    j, k = F.col("o_orderdate"), F.col("o_orderkey") % 3
    journal = dates.date(F.year(j), F.when(k > 0, F.month(j)), F.when(k == 2, F.day(j)))
    both = o.join(s, o["o_orderkey"] == s["l_orderkey"], "left").select("o_orderkey", dates.earliest(journal, dates.date(F.year("d"), F.month("d"), F.day("d"))).alias("x"))
    return both.select("o_orderkey", "x.*")


_STATUS = "case event_type when 'purchase' then 'pubmed' when 'signup' then 'entrez' when 'click' then 'medline' else event_type end"


@query(f"""with e as (select user_id, event_id, {_STATUS} as s, cast(strftime(ts, '%Y') as int) as y, month(ts) as m, day(ts) as d from events),
p as (select user_id, arg_max({{'y': y, 'm': m, 'd': d}}, event_id) filter (s = 'pubmed') as a, arg_max({{'y': y, 'm': m, 'd': d}}, event_id) filter (s = 'entrez') as b, arg_max({{'y': y, 'm': m, 'd': d}}, event_id) filter (s = 'medline') as c, arg_min(s, event_id) as f from e group by 1),
l as (select e.user_id, arg_max({{'y': y, 'm': m, 'd': d}}, event_id) as z from e join p on p.user_id = e.user_id and e.s = p.f group by 1),
r as (select p.user_id, coalesce(a, b, c, z) as r from p join l on l.user_id = p.user_id)
select user_id, cast(r.y as int) as y, cast(r.m as int) as m, cast(r.d as int) as d from r""")
def status_priority(spark, sf_dir):
    e = t(spark, sf_dir, "events")
    one = F.struct("event_id", F.expr(_STATUS).alias("status"), F.year("ts").alias("y"), F.month("ts").alias("m"), F.day("ts").alias("d"))
    per = e.groupBy("user_id").agg(F.array_sort(F.collect_list(one)).alias("h"))
    return per.select("user_id", dates.by_status(F.col("h")).alias("x")).select("user_id", "x.*")


@query("""select n_name, string_agg(case when c_custkey % 4 = 0 then c_name || ' ' || c_mktsegment when c_custkey % 4 = 1 then c_mktsegment when c_custkey % 4 = 2 then c_name else 'Group ' || c_custkey end, ', ' order by c_custkey) as authors
from customer join nation on c_nationkey = n_nationkey group by 1""")
def author_join(spark, sf_dir):
    c, k = t(spark, sf_dir, "customer"), F.col("c_custkey") % 4
    name = metadata.author_name(F.when(k.isin(0, 2), F.col("c_name")), F.when(k.isin(0, 1), F.col("c_mktsegment")), F.concat(F.lit("Group "), F.col("c_custkey").cast("string")))
    rows = c.join(t(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name").agg(F.array_sort(F.collect_list(F.struct("c_custkey", name.alias("name")))).alias("a"))
    return rows.select("n_name", F.array_join("a.name", ", ").alias("authors"))


def _mesh(spark, sf_dir):
    li, p = t(spark, sf_dir, "lineitem"), t(spark, sf_dir, "part")
    j = li.join(p, F.col("l_partkey") == F.col("p_partkey"))
    q = F.struct("l_linenumber", F.lit("Q").alias("ui"), F.col("l_returnflag").alias("major"), F.col("p_name").alias("name"))
    per = j.groupBy("l_orderkey", "l_linestatus").agg(F.array_sort(F.collect_list(q)).alias("qs"))
    heading = F.struct("l_linestatus", F.col("l_linestatus").alias("ui"), F.lit("Y").alias("major"), F.concat(F.lit("H"), "l_linestatus").alias("name"), F.transform("qs", lambda x: F.struct(x["ui"].alias("ui"), x["major"].alias("major"), x["name"].alias("name"))).alias("qualifiers"))
    return per.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(heading)).alias("mesh"))


_SQL_MESH = """with q as (select l_orderkey, l_linestatus, string_agg('Qualifier|Q|' || l_returnflag || '|' || p_name, '~' order by l_linenumber, l_returnflag, p_name) as q from lineitem join part on l_partkey = p_partkey group by 1, 2)
select l_orderkey, string_agg('Descriptor|' || l_linestatus || '|Y|H' || l_linestatus || '~' || q, chr(9) order by l_linestatus) as packed from q group by 1"""


@query(_SQL_MESH)
def mesh_encode(spark, sf_dir):
    return _mesh(spark, sf_dir).select("l_orderkey", metadata.encode_mesh(F.col("mesh")).alias("packed"))


@query("""select l_orderkey, l_linestatus as ui, 'H' || l_linestatus as name, count(*) as qualifiers, min(p_name) as first_name from lineitem join part on l_partkey = p_partkey group by 1, 2""")
def mesh_decode(spark, sf_dir):
    packed = _mesh(spark, sf_dir).select("l_orderkey", metadata.encode_mesh(F.col("mesh")).alias("packed"))
    return packed.select("l_orderkey", F.explode(metadata.decode_mesh(F.col("packed"))).alias("h")).select("l_orderkey", "h.ui", "h.name", F.size("h.qualifiers").cast("bigint").alias("qualifiers"), F.array_min("h.qualifiers.name").alias("first_name"))


_TYPES = "case p_size % 8 " + " ".join(f"when {k} then {_q(x)}" for k, x in enumerate(text.SKIPPED_TYPES)) + " else p_type end"
_SKIPPED = ", ".join(map(_q, text.SKIPPED_TYPES))


@query(f"""with x as (select p_brand, {_TYPES} as p_type from part) select p_brand, string_agg(distinct p_type, '|' order by p_type) filter (p_type not in ({_SKIPPED})) as types from x group by 1""")
def pubtype_filter(spark, sf_dir):
    size = F.col("p_size") % 8
    kind = F.coalesce(*[F.when(size == k, F.lit(x)) for k, x in enumerate(text.SKIPPED_TYPES)], F.col("p_type"))
    per = t(spark, sf_dir, "part").groupBy("p_brand").agg(F.array_sort(F.collect_set(kind)).alias("ts"))
    out = text.publication_types(F.col("ts"))
    return per.select("p_brand", F.when(F.size(out) > 0, F.array_join(out, "|")).alias("types"))


@query("""select page_id, list_filter(['10.' || page_id || '/' || url, '10.1/x/', 'x' || url, '10.5/ok'][1 + page_id % 3:], lambda d: regexp_matches(d, '^[0-9\\.]+/.+[^/]$'))[1] as doi from pages""")
def doi_filter(spark, sf_dir):
    every = F.array(F.concat(F.lit("10."), F.col("page_id").cast("string"), F.lit("/"), "url"), F.lit("10.1/x/"), F.concat(F.lit("x"), "url"), F.lit("10.5/ok"))
    return t(spark, sf_dir, "pages").select("page_id", text.first_doi(F.slice(every, (F.col("page_id") % 3 + 1).cast("int"), 4)).alias("doi"))


@query("select doc_id, cast(20 * 10000 + doc_id % 10000 as int) as file_index from documents")
def file_index(spark, sf_dir):
    return t(spark, sf_dir, "documents").select("doc_id", text.file_index(F.format_string("ftp://host/2/pubmed20n%04d.xml.gz", F.col("doc_id") % 10000)).alias("file_index"))


@query("""select page_id, regexp_replace(replace(html, '<article>', '<article lang="x" xlink:t="y">'), '<article ', '<article xmlns:xlink="http://www.w3.org/1999/xlink" ') as xml from pages""")
def xlink_fix(spark, sf_dir):
    return t(spark, sf_dir, "pages").select("page_id", text.xlink_fix(F.replace("html", F.lit("<article>"), F.lit('<article lang="x" xlink:t="y">'))).alias("xml"))


@query("select source, string_agg(distinct cast(doc_id as varchar), ',' order by cast(doc_id as varchar)) as pmids from documents group by 1")
def infon_grep(spark, sf_dir):
    one = F.concat(F.lit('<document><infon key="pmid">'), F.col("doc_id").cast("string"), F.lit("</infon></document>"))
    xml = t(spark, sf_dir, "documents").select("source", F.explode(text.infon_values(one)).alias("pmid"))
    return xml.groupBy("source").agg(F.array_join(F.array_sort(F.collect_set("pmid")), ",").alias("pmids"))


_W = r"[\p{L}\p{N}_]"


@query(rf"""select p_partkey, '(?<!{_W})' || replace(replace(regexp_replace(m, '([^\p{{L}}\p{{N}}_ ])', '\\\1', 'g'), 'alpha', '(alpha|α)'), ' ', '\s+') || '(?!{_W})' as pattern from (select p_partkey, 'TNF-alpha (' || p_brand || ') x' as m from part)""")
def mention_regex(spark, sf_dir):
    return t(spark, sf_dir, "part").select("p_partkey", spans.mention_pattern(F.concat(F.lit(" TNF-alpha  ("), "p_brand", F.lit(") x "))).alias("pattern"))


def _mentions(spark, sf_dir):
    """Per document its third word, and that with the next one, as mentions (null where there is none)."""

    def word(n: int):
        """The n-th word; a text is read no further than that."""
        return F.nullif(F.regexp_extract("text", rf"^[^\p{{L}}\p{{N}}_]*+(?:{_W}++[^\p{{L}}\p{{N}}_]++){{{n - 1}}}({_W}++)", 1), F.lit(""))

    d = t(spark, sf_dir, "documents").select("doc_id", "text", word(3).alias("third"), word(4).alias("fourth"))
    return d.select(F.col("doc_id").alias("pmid"), F.lit(0).alias("passage_idx"), F.lit(0).cast("bigint").alias("offset"), "text", F.col("third").alias("one"), F.concat("third", F.lit(" "), "fourth").alias("two"))


#: Words and what lies between them: a word's place is the summed length of both before it.
_SQL_WORDS = f"""d as (select doc_id as pmid, regexp_extract_all(text, '{_W}+') as w, string_split_regex(text, '{_W}+') as g from documents),
p as (select pmid, w[3] as one, unnest(w) as word, unnest(range(1, len(w) + 1)) as i, unnest(g[1:len(w)]) as gap from d),
q as (select *, sum(length(gap)) over (partition by pmid order by i) + coalesce(sum(length(word)) over (partition by pmid order by i rows between unbounded preceding and 1 preceding), 0) as s from p)"""


@query(f"with {_SQL_WORDS} select pmid, cast(s as int) as start, cast(s + length(word) as int) as \"end\" from q where word = one")
def align_spans(spark, sf_dir):
    m = _mentions(spark, sf_dir)
    got = m.select("pmid", F.explode(spans.find_spans(F.col("text"), spans.mention_pattern(F.col("one")))).alias("s"))
    return got.select("pmid", "s.start", "s.end")


@query(f"with {_SQL_WORDS} select pmid, cast(s as int) as start, cast(s + length(word) as int) as \"end\", row_number() over (order by pmid, s, s + length(word)) as ann_no from q where word = one")
def align_numbered(spark, sf_dir):
    return align.numbered(align_spans(spark, sf_dir), "pmid", "start", "end")


#: A pair of words is the longer mention, wherever its first word begins one: of pairs that share a word every other one counts. Single
#: words count outside of these.
@query(rf"""with {_SQL_WORDS}, n as (select q.*, d.w[4] as two, lead(word) over x as nw, lead(gap) over x as ng, lead(s) over x as ns from q join d on d.pmid = q.pmid window x as (partition by q.pmid order by i)),
c as (select pmid, i, s, ns + length(nw) - s as len, i - row_number() over (partition by pmid order by i) as g from n where word = one and nw = two and regexp_full_match(ng, '[ \t\n\x0B\f\r]+')),
k as (select pmid, i, s, len from (select *, row_number() over (partition by pmid, g order by i) as r from c) where r % 2 = 1),
a as (select pmid, s, len, 'c2' as conceptid from k union all select n.pmid, n.s, length(n.word), 'c1' from n left join k on k.pmid = n.pmid and k.i in (n.i, n.i - 1) where word = one and k.pmid is null)
select a.pmid, 0 as passage_idx, 'T1.' || row_number() over (partition by a.pmid order by s) as ann_id, 'W' as type, conceptid, substr(text, (s + 1)::bigint, len::bigint) as text, s::bigint as "offset", len::bigint as length from a join documents on doc_id = a.pmid""")
def align_nonoverlap(spark, sf_dir):
    m = _mentions(spark, sf_dir)
    table = m.select("pmid", F.lit("W").alias("type"), F.explode(F.array(F.struct(F.lit("c1").alias("c"), F.col("one").alias("m")), F.struct(F.lit("c2").alias("c"), F.col("two").alias("m")))).alias("x"))
    table = table.select("pmid", "type", F.col("x.c").alias("conceptid"), F.col("x.m").alias("mentions"), F.lit("db").alias("database"))
    return align.align(m.select("pmid", "passage_idx", "text", "offset"), table.where("mentions is not null"))


def _as_citations(spark, sf_dir):
    esc = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    xml = F.concat(F.lit("<PubmedArticle><MedlineCitation><PMID>"), F.col("doc_id").cast("string"), F.lit("</PMID><Article><Journal><JournalIssue><PubDate><Year>2001</Year><Month>Mar</Month></PubDate></JournalIssue><Title>"), "source", F.lit("</Title></Journal><ArticleTitle>[Title "), F.col("doc_id").cast("string"), F.lit("].</ArticleTitle><Abstract><AbstractText>"), esc(F.col("text")), F.lit("</AbstractText></Abstract></Article></MedlineCitation></PubmedArticle>"))
    return t(spark, sf_dir, "documents").select(xml.alias("xml"))


@query(f"select doc_id as pmid, 2001 as year, 3 as month, source as journal, 'Title ' || doc_id || '.' as title, {_sql_chain(_sql_chain('text', SQL_CLEANUP), text.EMPTY_BRACKETS)} as abstract from documents")
def pubmed_parse(spark, sf_dir):
    got = articles.citations(_as_citations(spark, sf_dir))
    return got.select("pmid", "year", "month", "journal", F.array_join("title", " ").alias("title"), F.array_join("abstract", " ").alias("abstract"))


_TWICE = _sql_chain(_sql_chain("trim(line, ' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11))", SQL_CLEANUP), SQL_CLEANUP)


@query(f"""with l as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as i from documents),
c as (select doc_id, i + 1 as i, 'article' as section, 'methods' as subsection, {_TWICE} as text from l
 union all select doc_id, 0, 'title', null, 'T' from documents union all select doc_id, 1, 'article', 'methods', '2. Methods' from documents),
k as (select * from c where text <> '')
select cast(doc_id as varchar) as pmid, cast(row_number() over w - 1 as int) as passage_idx, section, subsection, text,
 cast(coalesce(sum(length(text)) over (partition by doc_id order by i rows between unbounded preceding and 1 preceding), 0) as bigint) as "offset" from k window w as (partition by doc_id order by i)""")
def pmc_parse(spark, sf_dir):
    esc = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    paragraphs = F.array_join(F.transform(F.split(esc(F.col("text")), "\n"), lambda x: F.concat(F.lit("<p>"), x, F.lit("</p>"))), "")
    xml = F.concat(F.lit('<article><front><article-meta><article-id pub-id-type="pmid">'), F.col("doc_id").cast("string"), F.lit('</article-id><title-group><article-title>T</article-title></title-group><pub-date><year>1999</year><season>May-June</season></pub-date></article-meta></front><body><sec><title>2. Methods</title>'), paragraphs, F.lit("</sec></body></article>"))
    got = articles.fulltexts(t(spark, sf_dir, "documents").select(xml.alias("xml")))
    return articles.fulltext_passages(got).select("pmid", "passage_idx", "section", "subsection", "text", "offset")


@query(f"""select cast(doc_id as varchar) as id, 'Title ' || doc_id || '.' as title, '2001' as year, '3' as month, source as journal, 1 + cast(a <> '' as int) as passages, length('Title ' || doc_id || '.') as at, a as abstract
from (select doc_id, source, {_sql_chain(_sql_chain('text', SQL_CLEANUP), text.EMPTY_BRACKETS)} as a from documents)""")
def convert_documents(spark, sf_dir):
    docs = articles.citation_documents(articles.citations(_as_citations(spark, sf_dir)))
    last = F.element_at("passages", -1)
    return docs.select("id", *[F.col("infons")[k].alias(k) for k in ("title", "year", "month", "journal")], F.size("passages").alias("passages"), F.when(F.size("passages") > 1, last["offset"]).otherwise(F.length(F.col("infons")["title"])).alias("at"), F.when(F.size("passages") > 1, last["text"]).otherwise("").alias("abstract"))


@query("select p_brand, string_agg(cast(p_partkey as varchar) || chr(9) || cast(p_size as varchar), chr(9) order by p_partkey) as cells from part group by 1")
def table_cells(spark, sf_dir):
    row = F.concat(F.lit("<tr><td>"), F.col("p_partkey").cast("string"), F.lit("</td><td>"), F.col("p_size").cast("string"), F.lit("</td></tr>"))
    tables = t(spark, sf_dir, "part").groupBy("p_brand").agg(F.array_sort(F.collect_list(F.struct("p_partkey", row.alias("r")))).alias("rs"))
    xml = F.concat(F.lit("<article><body><table><tbody>"), F.array_join("rs.r", ""), F.lit("</tbody></table></body></article>"))
    got = articles.fulltexts(tables.select("p_brand", xml.alias("xml")), kept=["p_brand"])
    return got.select("p_brand", F.col("passages")[0]["text"].alias("cells"))


_BARE = "regexp_replace(x, '<[^>]*>|&[0-9A-Za-z_]+;|&', '', 'g')"
_LINKS = "list_aggregate(regexp_extract_all(replace(replace(replace(x, '&amp;', chr(1)), '&', ''), chr(1), '&'), '<a[^>]*>([^<]*)</a>', 1), 'string_agg', ' ')"


@query(f"""with h as (select page_id, unnest(regexp_extract_all(html, '(?s)<h1>(.*?)</h1>', 1)) as x from pages), u as (select page_id, unnest(regexp_extract_all(html, '(?s)<ul>.*?</ul>')) as x from pages),
c as (select page_id, {_sql_chain(_sql_chain(_BARE, SQL_CLEANUP), SQL_CLEANUP)} as text, 'body/title' as xml_path from h union all select page_id, {_sql_chain(_sql_chain(_LINKS, SQL_CLEANUP), SQL_CLEANUP)}, 'body/p' from u)
select page_id, text, xml_path from pages left join (select * from c where text <> '') using (page_id)""")
def html_chunks(spark, sf_dir):
    """All headings and lists of the pages, as articles."""
    heads = F.transform(F.regexp_extract_all("html", F.lit(r"(?s)<h1>(.*?)</h1>"), F.lit(1)), lambda x: F.concat(F.lit("<title>"), F.regexp_replace(x, r"<[^>]*>|&\w+;|&", ""), F.lit("</title>")))
    lists = F.transform(F.regexp_extract_all("html", F.lit(r"(?s)<ul>.*?</ul>"), F.lit(0)), lambda x: F.concat(F.lit("<p>"), F.regexp_replace(x, "&(?!amp;)", ""), F.lit("</p>")))
    xml = F.concat(F.lit("<article><body>"), F.array_join(F.concat(heads, lists), ""), F.lit("</body></article>"))
    got = articles.fulltexts(t(spark, sf_dir, "pages").select("page_id", xml.alias("xml")), kept=["page_id"], all_paths=True)
    return got.select("page_id", F.explode_outer("passages").alias("p")).select("page_id", "p.text", "p.xml_path")


@query("select doc_id, regexp_replace(left(text, 30), '[ \\n\\r\\f]+$', '') || '. ' || substr(text, 31) as text, 1 as n from documents")
def citation_strip(spark, sf_dir):
    name = F.lit("ANN_00000000-0000-0000-0000-000000000001")
    marked = F.concat(F.substring("text", 1, 30), F.lit(" ("), name, F.lit("). "), F.expr("substr(text, 31)"))
    got = t(spark, sf_dir, "documents").select("doc_id", arrow.strip_citations(marked, F.create_map(name, F.lit("7"))).alias("x"))
    return got.select("doc_id", "x.text", F.size("x.annotations").alias("n"))


@query("select doc_id, text || ' <b> &amp; é \"' as text from documents")
def html_unescape(spark, sf_dir):
    raw = F.concat(F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("e"), F.lit("&#101;")), F.lit(" &lt;b&gt; &amp;amp; &eacute; &quot;"))
    return t(spark, sf_dir, "documents").select("doc_id", arrow.unescape(raw).alias("text"))


@query("select doc_id, text, '1F8B' as magic from documents")
def gzip_roundtrip(spark, sf_dir):
    packed = arrow.gzip_text(F.col("text"))
    return t(spark, sf_dir, "documents").select("doc_id", arrow.gunzip_text(packed).alias("text"), F.hex(F.substring(packed, 1, 2)).alias("magic"))


@query(ORACLES["version_merge_ordered"])
def stream_ingest(spark, sf_dir):
    from ..streaming.ingest import ingest_versions

    at = scratch(spark)
    events = t(spark, sf_dir, "events")
    prepare = lambda b: b.select(F.col("user_id").alias("pmid"), F.col("event_id").alias("input_ord"), F.col("event_id").alias("time"), F.col("event_type").alias("hash"))
    return ingest_versions(spark, f"{sf_dir}/events.parquet*", events.schema, f"{at}/store", f"{at}/checkpoint", prepare).select("pmid", "hash", "time")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from . import catalogue_jobs  # noqa: F401  adds its own

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    from . import catalogue_jobs  # noqa: F401

    return dict(ORACLES)
