"""Chat formatting: collapse of cumulative snapshots, then rendering. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written

#: Turns of a block of the rolling hash, and of a rendered part.
BLOCK = 1024
#: A conversation's name without nulls: joins and windows then share one partitioning.
CONV = ("id_", "null_")


def blocks(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row for each conversation and block of turn numbers: id_, null_, block, n, ts (its distinct turns by turn, role and
    text) and cs (64 bits, twice, of each). Texts cross once, equal turns collapse before; it is written, and the rest
    reads the columns that it needs."""
    t = turns.select(F.coalesce(F.col("conv_id").cast("bigint"), F.lit(0)).alias("id_"), F.col("conv_id").isNull().alias("null_"), F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    t = t.withColumn("block", F.floor(F.coalesce("turn", F.lit(-1)) / block))
    per = t.groupBy(*CONV, "block").agg(F.array_sort(F.collect_set(F.struct("turn", "role", "text"))).alias("ts"))
    hashed = F.transform("ts", lambda x: F.struct(F.xxhash64(x["role"], x["text"]).alias("c1"), F.xxhash64(F.lit(7), x["text"], x["role"]).alias("c2")))
    return written(per.select(*CONV, "block", F.size("ts").cast("bigint").alias("n"), "ts", hashed.alias("cs")))


def placed(held: DataFrame) -> DataFrame:
    """id_, null_, block, skip (turns of the conversation in blocks before) and length (of the whole conversation)."""
    before = Window.partitionBy(*CONV).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*CONV)
    return held.select(*CONV, "block", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("skip"), F.sum("n").over(whole).cast("long").alias("length"))


def rolling(held: DataFrame, places: DataFrame) -> DataFrame:
    """Per turn: id_, null_, length, pos (from 1, by turn, role, text) and h1, h2: 128 bits of hash of all turns up to it.

    The hash of a prefix is the xor of its turns' hashes, each taken with its position, so it rolls as a running
    aggregate: within blocks of turn numbers and then over blocks, so that a conversation with very many turns is spread
    over tasks. No text is read."""
    t = held.select(*CONV, "block", F.posexplode("cs").alias("i", "c")).join(places, [*CONV, "block"])
    t = t.select(*CONV, "block", "length", (F.col("skip") + F.col("i") + 1).alias("pos"), "c")
    t = t.select(*CONV, "block", "length", "pos", F.xxhash64(F.lit(1), "pos", "c.c1", "c.c2").alias("x1"), F.xxhash64(F.lit(2), "pos", "c.c2", "c.c1").alias("x2"))
    run = Window.partitionBy(*CONV, "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*CONV).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = t.groupBy(*CONV, "block").agg(F.bit_xor("x1").alias("y1"), F.bit_xor("x2").alias("y2"))
    sums = sums.select(*CONV, "block", *[F.coalesce(F.bit_xor(y).over(before), F.lit(0).cast("long")).alias(y) for y in ("y1", "y2")])
    t = t.withColumn("r1", F.bit_xor("x1").over(run)).withColumn("r2", F.bit_xor("x2").over(run)).join(sums, [*CONV, "block"])
    return t.select(*CONV, "length", "pos", F.col("r1").bitwiseXOR(F.col("y1")).alias("h1"), F.col("r2").bitwiseXOR(F.col("y2")).alias("h2"))


def maximal(rolled: DataFrame) -> DataFrame:
    """id_, null_ of the conversations that are a prefix of no longer one; of equal ones the least conv_id (null only if all are)."""
    ends = rolled.where("pos = length").groupBy("pos", "h1", "h2").agg(F.min(F.struct("null_", "id_")).alias("least"))
    inner = rolled.where("pos < length").select("pos", "h1", "h2").distinct()
    kept = ends.join(inner, ["pos", "h1", "h2"], "left_anti")
    return kept.select("least.id_", "least.null_")


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), text, F.lit("<|im_end|>\n"))


def collapse(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """Renders the maximal conversations: conv_id, part (from 0), n_turns, text; a part has at most `block` turns.

    Null role or text counts as empty; a turn given twice alike counts once; turns are ordered by turn (null first), role
    and text. A null conv_id is a conversation of its own. An empty table gives no rows. Other columns are ignored. Turns of
    one number (or of none) of one conversation are one row of blocks(), and so one task's."""
    held = blocks(turns, block)
    places = placed(held)
    kept = written(maximal(rolling(held, places)))
    mine = places.join(kept, [*CONV]).drop("length")
    lines = held.select(*CONV, "block", "n", "ts").join(mine, [*CONV, "block"])
    # a block of turn numbers lies in one part, or in two if the numbers don't begin at 0 or have gaps
    lines = lines.withColumn("part", F.explode(F.sequence(F.floor(F.col("skip") / block), F.floor((F.col("skip") + F.col("n") - 1) / block))))
    start = F.greatest(F.col("part") * block - F.col("skip"), F.lit(0))
    stop = F.least((F.col("part") + 1) * block - F.col("skip"), F.col("n"))
    piece = F.slice("ts", (start + 1).cast("int"), (stop - start).cast("int"))
    text = F.array_join(F.transform(piece, lambda x: rendered(x["role"], x["text"])), "")
    pieces = lines.select(F.when(~F.col("null_"), F.col("id_")).alias("conv_id"), "part", "skip", (stop - start).alias("m"), text.alias("piece"))
    return pieces.groupBy("conv_id", "part").agg(F.sum("m").cast("long").alias("n_turns"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("skip", "piece"))), lambda x: x["piece"]), "").alias("text"))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collapse(table(spark, sf_dir, "conversations"))


OP8_SQL = """
with d as (select distinct conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations),
t as (select conv_id, role, text, row_number() over (partition by conv_id order by turn nulls first, role, text) as pos from d),
c as (select conv_id, pos, role, text, md5(string_agg(length(role) || ':' || role || length(text) || ':' || text, '') over (partition by conv_id order by pos)) as h from t),
e as (select conv_id, max(pos) as length from c group by conv_id),
f as (select min(c.conv_id) as conv_id, c.pos, c.h from c join e on c.conv_id is not distinct from e.conv_id and c.pos = e.length group by c.pos, c.h),
i as (select distinct c.pos, c.h from c join e on c.conv_id is not distinct from e.conv_id where c.pos < e.length),
m as (select f.conv_id from f where not exists (select 1 from i where i.pos = f.pos and i.h = f.h))
select c.conv_id, cast((c.pos - 1) // 1024 as bigint) as part, count(*) as n_turns,
  string_agg('<|im_start|>' || c.role || chr(10) || c.text || '<|im_end|>' || chr(10), '' order by c.pos) as text
from c join m on c.conv_id is not distinct from m.conv_id group by 1, 2
"""
