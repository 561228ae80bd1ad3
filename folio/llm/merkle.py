"""Operator 12: a Merkle manifest of a table, in an external-memory node store.

Leaves are digests of rows. They are sorted by group and key, numbered within their group, and kept in runs of 2**BAND leaves. A
tree grows band by band: BAND levels are made from each run of the level below in one pass over the store, and every level is a
partition of Parquet files, rows (level, g, first, nodes): the node numbers first, first + 1, ... of the group's level. Proofs come
back down, band by band: the rows of a band that lie over one run are merged by that coordinate, give the siblings of all nodes of
the run, and are joined with the one proof of the run's own top. No task holds more than a run and its levels."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written

#: Levels made in one pass, and so the (binary) logarithm of a run's length.
BAND = 10
#: The columns that a leaf covers, in order.
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the concatenation."""
    return F.sha2(F.concat(*parts), 256)


def field(c: Column) -> Column:
    """`-` for null, else the value's length in UTF-8 bytes, `:` and the value."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def group_key(c: Column) -> Column:
    """A key for a group's value that is never null and sorts as the values do, null first."""
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))


@dataclass
class Tree:
    """runs: (g, run, n, leaves), each a run of a group's leaves in order, structs of at least `leaf`; n: leaves of the group.
    store: tables of nodes, one a band. tops: (g, top, n)."""

    runs: DataFrame
    store: list[DataFrame]
    tops: DataFrame


def placed(rows: DataFrame, *order: str) -> DataFrame:
    """rows (with a column g) and pos, 0, 1, ... within each g by `order`, which has to tell all rows apart, and n, rows of the g.
    Ranges are sorted side by side; what goes over their borders are two numbers for each range and group."""
    sort = ("g", *order)
    sorted_ = written(rows.repartitionByRange(*sort).sortWithinPartitions(*sort).withColumn("at", F.monotonically_increasing_id()))
    sorted_ = sorted_.withColumn("range_", F.shiftright("at", 33))
    sizes = sorted_.groupBy("g", "range_").agg(F.min("at").alias("low_"), F.count("*").alias("size_"))
    w = Window.partitionBy("g").orderBy("range_").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = sizes.select("g", "range_", "low_", (F.sum("size_").over(w) - F.col("size_")).alias("before_"), F.sum("size_").over(Window.partitionBy("g")).alias("n"))
    got = sorted_.join(sizes, ["g", "range_"])
    return got.select(*rows.columns, (F.col("at") - F.col("low_") + F.col("before_")).alias("pos"), "n")


def _nodes_at(level: int) -> Column:
    """Nodes of a group of n leaves at a level."""
    return F.ceil(F.col("n") / F.lit(1 << level).cast("decimal(38,0)")).cast("bigint")


def _parents(nodes: Column) -> Column:
    pair = lambda i: digest(F.get(nodes, i * 2), F.coalesce(F.get(nodes, i * 2 + 1), F.lit("")))
    return F.transform(F.sequence(F.lit(0), ((F.size(nodes) - 1) / 2).cast("int")), pair)


def _levels(runs: DataFrame, base: int) -> DataFrame:
    """runs (g, run, n, l0), with levels l1 to l<BAND> above l0; null above a group's top."""
    for j in range(BAND):
        below = F.col(f"l{j}")
        runs = runs.withColumn(f"l{j + 1}", F.when(below.isNotNull() & (_nodes_at(base + j) > 1), _parents(below)))
    return runs


def build(leaves: DataFrame, *order: str) -> Tree:
    """A tree over each group of leaves: (g, leaf, ...), sorted by `order` within g (whatever g is the null-free key of). Two
    consecutive nodes become the digest of their concatenation, a last one without a neighbour the digest of itself, while a
    group has several nodes; a lone leaf is its group's top. Repeated rows are leaves of their own."""
    rest = [c for c in leaves.columns if c != "g"]
    # a number of its own tells equal rows apart, so that ranges can split them
    fixed = written(leaves.withColumn("u_", F.monotonically_increasing_id()))
    at = placed(fixed, *order, "u_")
    run = F.shiftright("pos", BAND).alias("run")
    runs = written(at.groupBy("g", run).agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("pos", *rest))).alias("leaves")))
    most = runs.agg(F.max("n")).first()[0] or 0
    store, base = [], 0
    below = runs.select("g", "run", "n", F.transform("leaves", lambda x: x["leaf"]).alias("l0"))
    while True:
        made = [F.struct(F.lit(base + j).alias("level"), (F.col("run") * (1 << (BAND - j))).alias("first"), F.col(f"l{j}").alias("nodes")) for j in range(base > 0, BAND + 1)]
        rows = _levels(below, base).select("g", "n", F.explode(F.array(*made)).alias("x")).select("g", "n", "x.*").where("nodes is not null")
        store.append(written(rows, "level"))
        base += BAND
        if most <= 1 << (base - 1):
            break
        last = store[-1].where(F.col("level") == base).select("g", "n", F.col("first").alias("pos"), F.get("nodes", F.lit(0)).alias("h"))
        below = last.groupBy("g", run).agg(F.first("n").alias("n"), F.transform(F.sort_array(F.collect_list(F.struct("pos", "h"))), lambda x: x["h"]).alias("l0"))
    tops = None
    for s in store:
        one = s.where("first = 0 and size(nodes) = 1").select("g", "n", "level", F.get("nodes", F.lit(0)).alias("top"))
        tops = one if tops is None else tops.unionByName(one)
    return Tree(runs, store, tops.groupBy("g").agg(F.max_by("top", "level").alias("top"), F.first("n").alias("n")))


def _of_level(level: int):
    return lambda x: x["level"] == level


_PROOF = "array<struct<l:string,r:string>>"


def proofs(tree: Tree, above: DataFrame | None = None) -> DataFrame:
    """(g, leaf's fields, proof) of all leaves: from the leaf up, what stands left and right of its node at each level (neither of
    a node that has no neighbour). above: (g, proof) of the groups' tops, which follows."""
    if above is None:
        above = tree.tops.select("g", F.array().cast(_PROOF).alias("proof"))
    ends = above.join(tree.tops.select("g", "n"), "g")
    parents = None
    for t in reversed(range(len(tree.store))):
        base = t * BAND
        here = ends.where((F.col("n") <= 1 << (base + BAND - 1)) & ((F.col("n") > 1 << (base - 1)) if base else F.lit(True))).select("g", F.lit(0).cast("bigint").alias("run"), "proof")
        parents = here if parents is None else here.unionByName(parents)
        bands = tree.store[t].where(F.col("level") < base + BAND)
        if t:
            bands = bands.unionByName(tree.store[t - 1].where(F.col("level") == base))
        coordinate = F.floor(F.col("first") / F.pow(F.lit(2.0), F.lit(base + BAND) - F.col("level"))).cast("bigint").alias("run")
        merged = bands.groupBy("g", coordinate).agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("level", "first", "nodes"))).alias("rows"))
        for j in range(BAND):
            merged = merged.withColumn(f"l{j}", F.flatten(F.transform(F.filter("rows", _of_level(base + j)), lambda x: x["nodes"])))
        depth = sum(((_nodes_at(base + j) > 1).cast("int") for j in range(BAND)), F.lit(0))

        def siblings(i: Column) -> Column:
            each = []
            for j in range(BAND):
                at, nodes = F.shiftright(i, j), F.col(f"l{j}")
                right = at % 2 == 1
                each.append(F.struct(F.when(right, F.get(nodes, at - 1)).otherwise("").alias("l"), F.when(right, "").otherwise(F.coalesce(F.get(nodes, at + 1), F.lit(""))).alias("r")))
            return F.array(*each)

        own = F.transform(F.sequence(F.lit(0), F.size("l0") - 1), lambda i: F.slice(siblings(i), 1, F.col("depth")))
        merged = merged.withColumn("depth", depth).select("g", "run", own.alias("own")).join(parents, ["g", "run"])
        full = F.transform("own", lambda p: F.concat(p, F.col("proof")))
        if t:
            parents = merged.select("g", F.posexplode(full).alias("k", "proof"), "run").select("g", (F.col("run") * (1 << BAND) + F.col("k")).alias("run"), "proof")
        else:
            zipped = tree.runs.select("g", "run", "leaves").join(merged.select("g", "run", full.alias("p")), ["g", "run"])
            return zipped.select("g", F.explode(F.arrays_zip(F.col("leaves").alias("x"), F.col("p").alias("p"))).alias("z")).select("g", "z.x.*", F.col("z.p").alias("proof"))


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(proof, leaf, lambda h, s: digest(s["l"], h, s["r"]))


def manifest(leaves: DataFrame, *order: str) -> tuple[Tree, DataFrame, str | None]:
    """The tree over each group, (g, top, proof) of the groups in the tree over all tops, by g, and that tree's root (None: no
    leaves)."""
    tree = build(leaves, *order)
    tops = written(tree.tops)
    tree.tops = tops
    upper = build(tops.select(F.lit("").alias("g"), F.col("g").alias("name"), F.col("top").alias("leaf")), "name")
    root = upper.tops.first()
    groups = proofs(upper).select(F.col("name").alias("g"), F.col("leaf").alias("top"), "proof")
    return tree, groups, root and root["top"]


def audited(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of each row.

    A leaf covers COLUMNS; other columns aren't read. Groups are the values of lang, null being one. Within a group leaves
    ascend by doc_id, null first, then by digest. Where 7 divides the CRC-32 of doc_id (null: never), n_chars is tampered
    with: folded_root is then what a leaf of n_chars + 1 gives with the original siblings. An empty table gives no rows."""
    leaf = lambda **new: digest(*[field(new.get(c, F.col(c))) for c in COLUMNS])
    bad = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    more = leaf(n_chars=F.col("n_chars").cast("decimal(38,0)") + 1)
    rows = docs.select(group_key(F.col("lang")).alias("g"), "doc_id", leaf().alias("leaf"), F.when(bad, more).alias("other"))
    tree, groups, root = manifest(rows, "doc_id", "leaf")
    got = proofs(tree, groups.select("g", "proof")).join(groups.select("g", F.col("top").alias("subroot")), "g")
    top = F.lit(root).cast("string")
    siblings = F.array_join(F.transform("proof", lambda s: F.concat(s["l"], s["r"])), "")
    out = got.select("doc_id", "leaf", "subroot", top.alias("root"), F.sha2(siblings, 256).alias("proof_sha256"), folded(F.coalesce("other", "leaf"), F.col("proof")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audited(table(spark, sf_dir, "documents"))


_F = "coalesce(strlen({0}::varchar)::varchar || ':' || {0}::varchar, '-')"
_LEAF = " || ".join(_F.format(c) for c in COLUMNS)
#: CRC-32 of the id's decimal digits: bytes in turn, eight steps each.
_CRC = "xor(list_reduce(list_concat([4294967295::bigint], list_transform(string_split(doc_id::varchar, ''), lambda x: ascii(x)::bigint)), lambda c, b: list_reduce(list_concat([xor(c, b)], [0::bigint, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"
_GROW = "select g, lev + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' order by pos)) from {0} where n > 1 group by g, lev, pos // 2, n"
OP12_SQL = f"""with recursive rows as (select doc_id, coalesce('=' || lang, '') as g, sha256({_LEAF}) as leaf,
 case when {_CRC} % 7 = 0 then sha256({_LEAF.replace('n_chars::varchar', '(n_chars + 1)::varchar')}) end as other from documents),
leaves as (select *, row_number() over (partition by g order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by g) as n from rows),
tree(g, lev, pos, n, h) as (select g, 0::bigint, pos, n, leaf from leaves union all {_GROW.format('tree')}),
subs as (select '' as g, g as name, h, row_number() over (order by g) - 1 as pos, count(*) over () as n from tree where n = 1),
upper_(g, lev, pos, n, h) as (select g, 0::bigint, pos, n, h from subs union all {_GROW.format('upper_')}),
low as (select l.doc_id, l.g, l.pos, t.lev, list({{'l': case when (l.pos >> t.lev) & 1 = 1 then t.h else '' end, 'r': case when (l.pos >> t.lev) & 1 = 0 then t.h else '' end}}) as s
 from leaves l join tree t on t.g = l.g and t.n > 1 and t.pos // 2 = (l.pos >> t.lev) // 2 and (t.pos <> (l.pos >> t.lev) or t.pos = t.n - 1 and t.pos % 2 = 0)
 group by l.doc_id, l.g, l.pos, t.lev, t.pos <> (l.pos >> t.lev), t.h, t.pos),
fixed as (select doc_id, g, pos, lev, case when s[1].l <> '' or s[1].r <> '' then s[1] end as s from low),
lone as (select l.g, l.pos, t.lev from leaves l join tree t on t.g = l.g and t.n > 1 and t.pos = (l.pos >> t.lev) and t.pos = t.n - 1 and t.pos % 2 = 0),
low_proof as (select f.g, f.pos, list(case when o.g is null then f.s else {{'l': '', 'r': ''}} end order by f.lev) as p from fixed f left join lone o on o.g = f.g and o.pos = f.pos and o.lev = f.lev group by 1, 2),
up as (select s.name, t.lev, case when t.pos = (s.pos >> t.lev) then {{'l': '', 'r': ''}} when t.pos % 2 = 0 then {{'l': t.h, 'r': ''}} else {{'l': '', 'r': t.h}} end as s
 from subs s join upper_ t on t.n > 1 and t.pos // 2 = (s.pos >> t.lev) // 2 and (t.pos <> (s.pos >> t.lev) or t.pos = t.n - 1 and t.pos % 2 = 0)),
up_proof as (select name, list(s order by lev) as p from up group by 1),
full_ as (select l.doc_id, l.leaf, coalesce(l.other, l.leaf) as used, s.h as subroot, (select h from upper_ where n = 1) as root, list_concat(coalesce(a.p, []), coalesce(b.p, [])) as p
 from leaves l join subs s on s.name = l.g left join low_proof a on a.g = l.g and a.pos = l.pos left join up_proof b on b.name = l.g),
done as (select *, list_reduce(list_concat([{{'l': used, 'r': ''}}], p), lambda a, s: {{'l': sha256(s.l || a.l || s.r), 'r': ''}}).l as folded_root from full_)
select doc_id, leaf, subroot, root, sha256(coalesce(array_to_string(list_transform(p, lambda s: s.l || s.r), ''), '')) as proof_sha256, folded_root, folded_root = root as verified from done"""
