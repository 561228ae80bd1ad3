"""Benchmark decontamination by spaced seeds. DataFrame functions only."""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, written

#: Each mask takes the token pairs at its two offsets and ignores the tokens between: 11011 and 1100011.
MASKS = {0: 3, 1: 5}
#: Items of fewer tokens have masks of their own, which ignore every choice of as many tokens as may differ: they lose nothing.
SHORT = 8
#: Tokens looked at before and after a seed's first one, the longest window compared, and the share that must agree.
REACH, WINDOW, SHARE = 24, 20, 0.8
#: Bits of the filter for each test seed, and the least and greatest binary logarithm of its size: 32 MB at most. A seed sets
#: two bits, so that one other position in 16,000 passes by chance. Fuller, it lets more through to the join, and loses none.
BITS_A_SEED, LEAST_BITS, MOST_BITS = 256, 18, 28


def _tokens(text: str) -> str:
    return f"filter(split(lower(coalesce({text}, '')), '[^\\\\p{{L}}\\\\p{{N}}]+'), w -> w <> '')"


def short_masks(n: int, share: float = SHARE) -> list[tuple[int, ...]]:
    """The offsets that each mask of an item of n tokens keeps: all but as many as may differ."""
    keep = max(1, math.ceil(n * share))
    return [c for c in combinations(range(n), keep)]


def _hashed(df: DataFrame, text: str) -> DataFrame:
    """df plus h_, the hashes of its tokens."""
    return df.withColumn("h_", F.expr(f"transform({_tokens(text)}, w -> xxhash64(w))"))


def _seeded(df: DataFrame) -> DataFrame:
    """df plus, for each mask of long items, s<mask>_ (a seed for each position)."""
    out = df.withColumn("p_", F.expr("if(size(h_) < 2, array(), zip_with(slice(h_, 1, size(h_) - 1), slice(h_, 2, size(h_) - 1), (x, y) -> xxhash64(x, y)))"))
    for m, gap in MASKS.items():
        out = out.withColumn(f"s{m}_", F.expr(f"if(size(p_) <= {gap}, array(), zip_with(slice(p_, 1, size(p_) - {gap}), slice(p_, {gap + 1}, size(p_) - {gap}), (x, y) -> xxhash64({m}, x, y)))"))
    return out.drop("p_")


def _shape(offsets: tuple[int, ...]) -> tuple[int, ...]:
    """Offsets from the first one: masks of one shape are one mask."""
    return tuple(o - offsets[0] for o in offsets)


def _seed(shape: tuple[int, ...], at: str) -> str:
    return f"xxhash64({100 + sum(1 << o for o in shape)}, " + ", ".join(f"get(h_, {at} + {o})" for o in shape) + ")"


def _around(at: str) -> str:
    """The token hashes from REACH before 0-based position `at` to REACH after, null outside of the text."""
    n = 2 * REACH + 1
    return f"concat(array_repeat(cast(null as bigint), greatest({REACH} - {at}, 0)), slice(h_, greatest({at} - {REACH}, 0) + 1, {n} - greatest({REACH} - {at}, 0)), array_repeat(cast(null as bigint), greatest({at} + {REACH + 1} - size(h_), 0)))"


def test_seeds(benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """(seed, item_id, item_len, item_around) of all positions of all items, and of short items under their own masks."""
    b = _hashed(benchmark.select("item_id", "text"), "text")
    long = _seeded(b.where(f"size(h_) >= {SHORT}"))
    every = None
    for m in MASKS:
        one = long.selectExpr("item_id", "h_", f"posexplode_outer(s{m}_) as (at, seed)").where("seed is not null")
        every = one if every is None else every.unionByName(one)
    short = b.where(f"size(h_) between 1 and {SHORT - 1}")
    cases = [f"when {n} then array(" + ", ".join(f"named_struct('at', {o[0]}, 'seed', {_seed(_shape(o), str(o[0]))})" for o in short_masks(n, share)) + ")" for n in range(1, SHORT)]
    every = every.unionByName(short.selectExpr("item_id", "h_", f"inline(case size(h_) {' '.join(cases)} end)"))
    return every.selectExpr("seed", "item_id", "size(h_) as item_len", f"{_around('at')} as item_around").distinct()


def _places(words: int) -> list[tuple[str, str]]:
    """SQL of the two places (word, bit) of a seed, from bits of it that don't overlap."""
    return [(f"cast(shiftrightunsigned(seed, {64 - words}) as int)", "cast(seed & 63 as int)"), (f"cast(shiftrightunsigned(seed, 6) & {(1 << words) - 1} as int)", "cast(shiftrightunsigned(seed, 28) & 63 as int)")]


def _bitmap(seeds: DataFrame, count: int) -> tuple[Column, int]:
    """The seeds' bits as one array of 64-bit words, and the binary logarithm of its length."""
    spark = seeds.sparkSession
    words = min(MOST_BITS, max(LEAST_BITS, (count * BITS_A_SEED).bit_length())) - 6
    both = seeds.selectExpr("inline(array(" + ", ".join(f"struct({w} as word, {b} as bit)" for w, b in _places(words)) + "))")
    masks = both.groupBy("word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("mask"))
    dense = spark.range(1 << words).join(masks, F.col("id") == F.col("word"), "left").selectExpr("id div 4096 as hi", "id % 4096 as lo", "coalesce(mask, 0L) as mask")
    pages = dense.groupBy("hi").agg(F.expr("transform(array_sort(collect_list(struct(lo, mask))), x -> x.mask) as page"))
    return pages.agg(F.expr("flatten(transform(array_sort(collect_list(struct(hi, page))), x -> x.page)) as bits")).scalar(), words


def overlaps(docs: DataFrame, benchmark: DataFrame, share: float = SHARE, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_key, item_id, matched, of): documents that hold a run of `of` tokens aligned with an item's, `of` being
    the lesser of the item's length and `window`, of which at least `share` agree; matched is the best count.

    Tokens are lower-cased runs of letters and digits. Every position of every whole text is seeded; a filter of the test
    seeds' bits, sized by their number, picks positions in place, which carry the tokens around them to the join with the
    seeds' table; Spark broadcasts that table if its written size allows, else both sides are shuffled and a frequent seed is
    split. Hits are verified on their tokens. Items of under SHORT tokens are seeded by masks that lose nothing; items and
    texts without tokens match nothing. Repeated rows give one row, null doc_ids theirs; other columns are ignored."""
    seeds = written(test_seeds(benchmark, share))
    lengths = [r[0] for r in seeds.where(f"item_len < {SHORT}").select("item_len").distinct().collect()]
    count = seeds.count()
    if not count:
        return docs.selectExpr("doc_id", "xxhash64(text) as text_key", "cast(0 as bigint) as item_id", "0 as matched", "0 as of").limit(0)
    bits, words = _bitmap(seeds.select("seed"), count)
    d = _seeded(_hashed(docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text"), "text").drop("text"))
    arrays = [f"s{m}_" for m in MASKS]
    for k, shape in enumerate(sorted({_shape(o) for n in lengths for o in short_masks(n, share)})):
        arrays.append(f"t{k}_")
        d = d.withColumn(arrays[-1], F.expr(f"if(size(h_) <= {shape[-1]}, array(), transform(sequence(0, size(h_) - {shape[-1] + 1}), i -> {_seed(shape, 'i')}))"))

    # one row for each position and mask; a row whose seed's bit isn't set ends there, before anything is copied
    d = d.withColumn("c_", F.concat(*arrays))
    starts = ["0"]
    for name in arrays:
        starts.append(f"{starts[-1]} + size({name})" if starts[-1] != "0" else f"size({name})")
    ends = [f"n{k}_" for k in range(len(arrays))]
    for name, start in zip(ends, starts[1:]):
        d = d.withColumn(name, F.expr(start))
    at = "case " + " ".join(f"when i < {e} then i - {b}" for b, e in zip(["0", *ends], ends)) + " end"
    known = [F.call_function("shiftright", F.get(bits, F.expr(w)), F.expr(b)).bitwiseAND(F.lit(1)) == 1 for w, b in _places(words)]
    # outer: else a filter on the arrays would be pushed below them and compute them anew
    hits = d.selectExpr("doc_id", "text_key", "h_", *ends, "posexplode_outer(c_) as (i, seed)").where(known[0] & known[1])
    hits = hits.selectExpr("doc_id", "text_key", "h_", "seed", f"{at} as at").selectExpr("doc_id", "text_key", "seed", f"{_around('at')} as around")
    pairs = hits.join(seeds, "seed").selectExpr("doc_id", "text_key", "item_id", f"least(item_len, {window}) as of", "zip_with(around, item_around, (x, y) -> if(x = y, 1, 0)) as eq")
    best = "array_max(transform(sequence(0, size(eq) - of), s -> aggregate(slice(eq, s + 1, of), 0, (a, x) -> a + x)))"
    return pairs.withColumn("matched", F.expr(best)).where(F.col("matched") >= F.ceil(F.col("of") * F.lit(share))).groupBy("doc_id", "text_key", "item_id").agg(F.max("matched").alias("matched"), F.max("of").alias("of"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the contaminated ones, other columns as they are. Null and empty texts stay."""
    # written, so that Spark knows its size and leaves docs where they are if it is small
    bad = written(overlaps(docs, benchmark).select(F.col("doc_id").alias("bad_id_"), F.col("text_key").alias("bad_key_")).distinct())
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["bad_id_"]) & (F.xxhash64(docs["text"]) == bad["bad_key_"]), "left_anti")


def op7_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_key")


#: By the definition: every alignment of every item in which enough tokens agree, and its best window.
OP7_SQL = """
with d as (select doc_id, md5(text) as k, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda w: w <> '') as t from documents),
b as (select item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda w: w <> '') as t from benchmark),
dt as (select doc_id, k, unnest(t) as w, unnest(range(len(t))) as p from d),
bt as (select item_id, least(len(t), 20) as n, unnest(t) as w, unnest(range(len(t))) as p from b),
a as (select doc_id, k, item_id, any_value(n) as n, dt.p - bt.p as diagonal, list(bt.p) as ps from dt join bt on dt.w = bt.w group by doc_id, k, item_id, diagonal having count(*) >= ceil(any_value(n) * 0.8)),
m as (select doc_id, k, item_id, n, list_max(list_transform(ps, lambda s: len(list_filter(ps, lambda p: p >= s and p < s + n)))) as matched from a)
select doc_id, item_id, cast(max(matched) as int) as matched, cast(max(n) as int) as "of" from m where matched >= ceil(n * 0.8) group by doc_id, k, item_id
"""
