"""Sums along arrays, as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import functions as F


def let(value, f):
    """f of a value that is computed once, however often f uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def sums_before(numbers, block: int = 128):
    """For each number of an array the sum of those before it. Sums of blocks come first, so that an element costs a part of a
    block, not all that lies before it."""

    def part(xs, first, n):
        return F.aggregate(F.slice(xs, (first + 1).cast("int"), n), F.lit(0).cast("bigint"), lambda a, x: a + x)

    def placed(xs):
        blocks = F.transform(F.sequence(F.lit(0), F.floor(F.size(xs) / block).cast("int")), lambda k: part(xs, k * block, F.lit(block)))
        return let(blocks, lambda sums: let(F.transform(sums, lambda _, k: part(sums, F.lit(0), k)), lambda bases: F.transform(xs, lambda _, i: F.get(bases, F.floor(i / block).cast("int")) + part(xs, i - i % block, i % block))))

    return let(numbers, placed)
