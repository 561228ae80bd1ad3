"""Mention patterns, match spans and their greedy choice, as Catalyst expressions."""

from __future__ import annotations

from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import let, sums_before
from .arrow import small_batches
from .text import WORD

_SPANS = "array<struct<start:int,end:int>>"

#: Names of letters that also match the letter (fixed values).
GREEK = {"alpha": "α", "beta": "β", "gamma": "γ", "delta": "δ"}


def _signs(s: Column) -> Column:
    for name, sign in GREEK.items():
        s = F.replace(s, F.lit(name), F.lit(sign))
    return s


def words_of(text: Column) -> Column:
    """Hashes of the distinct words of a text, names of Greek letters as signs: what first_word is looked up among."""
    return F.array_distinct(F.transform(F.regexp_extract_all(_signs(text), F.lit(f"{WORD}+"), F.lit(0)), lambda w: F.xxhash64(w)))


def first_word(mention: Column) -> Column:
    """The hash of a mention's first word, which is a whole word of every text that the mention's pattern matches; that of '' if it has
    none."""
    return F.xxhash64(_signs(F.regexp_extract(mention, f"{WORD}+", 0)))


def mention_pattern(mention: Column) -> Column:
    """A regular expression for a mention: literal, any white space between words, Greek letters by name or sign, and no
    word character on either side (after an edge that is no word character: one has to be there)."""
    m = F.regexp_replace(F.trim(mention), r"\s+", " ")
    body = F.regexp_replace(m, r"([^\p{L}\p{N}_ ])", r"\\$1")
    for name, sign in GREEK.items():
        body = F.replace(body, F.lit(name), F.lit(f"({name}|{sign})"))
    body = F.replace(body, F.lit(" "), F.lit(r"\s+"))
    left = F.when(m.rlike(f"^{WORD}"), F.lit(f"(?<!{WORD})")).otherwise(F.lit(f"(?<={WORD})"))
    right = F.when(m.rlike(f"{WORD}$"), F.lit(f"(?!{WORD})")).otherwise(F.lit(f"(?={WORD})"))
    return F.concat(left, body, right)


def find_spans(text: Column, pattern: Column) -> Column:
    """All matches, left to right: array of (start, end), 0-based, in code points.

    A text is matched once; a match begins after all gaps and matches before it, and the gap in front of it."""
    hits = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), lambda x: F.length(x))
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))

    def spans(b: Column) -> Column:
        steps = F.zip_with(b["hits"], F.slice(b["gaps"], 1, F.size(b["hits"])), lambda h, g: F.struct(h.alias("hit"), g.alias("gap"), (h + g).cast("bigint").alias("step")))
        return let(steps, lambda x: F.zip_with(x, sums_before(x["step"]), lambda p, at: F.struct((at + p["gap"]).cast("int").alias("start"), (at + p["step"]).cast("int").alias("end"))))

    return F.coalesce(let(F.struct(hits.alias("hits"), gaps.alias("gaps")), spans), F.array().cast(_SPANS))


def _greedy(spans: list[dict]) -> list[tuple[int, int, int]]:
    """(length, start, end) of chosen spans, in order of choice. They are held by their starts: one that overlaps a chosen span
    overlaps a neighbour."""
    starts, ends, got = [], [], []
    for n, s, e in sorted({(x["end"] - x["start"], x["start"], x["end"]) for x in spans}, reverse=True):
        k = bisect_left(starts, s)
        if not (k and ends[k - 1] >= s or k < len(starts) and starts[k] <= e):
            starts.insert(k, s)
            ends.insert(k, e)
            got.append((n, s, e))
    return got


@F.arrow_udf(T.ArrayType(T.StructType().add("len", T.IntegerType()).add("start", T.IntegerType()).add("end", T.IntegerType())))
def _chosen(spans: pa.Array) -> pa.Array:
    kind = pa.list_(pa.struct([("len", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
    return pa.array([row if row is None else [{"len": n, "start": s, "end": e} for n, s, e in _greedy(row)] for row in spans.to_pylist()], kind)


@F.arrow_udf(T.ArrayType(T.BooleanType()))
def _taken(spans: pa.Array) -> pa.Array:
    rows = []
    for row in spans.to_pylist():
        best = {x[1:] for x in _greedy(row or [])}
        rows.append([(x["start"], x["end"]) in best for x in row or []])
    return pa.array(rows, pa.list_(pa.bool_()))


def choose_spans(spans: Column) -> Column:
    """Greedy choice among (start, end): longest first, larger start first among equals; touching spans overlap."""
    small_batches()
    return _chosen(_bounds(spans))


def chosen_only(hits: Column) -> Column:
    """The hits, structs of start, end and more, whose spans the greedy choice takes."""
    small_batches()
    return F.transform(F.filter(F.arrays_zip(hits.alias("h"), _taken(_bounds(hits)).alias("t")), lambda x: x["t"]), lambda x: x["h"])


def _bounds(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].cast("int").alias("start"), s["end"].cast("int").alias("end")))


def concept_list(concept: Column) -> Column:
    """An aggregate: distinct concept ids, sorted, joined by ';'."""
    return F.array_join(F.array_sort(F.collect_set(concept)), ";")
