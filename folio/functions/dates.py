"""Publication dates as Catalyst expressions; a date is a struct (y, m, d) of ints."""

from __future__ import annotations

import calendar

from pyspark.sql import Column
from pyspark.sql import functions as F

FULL = list(calendar.month_name)[1:]
SHORT = list(calendar.month_abbr)[1:]
#: Calendar order, full names before short ones: the first of these that a text contains gives its month.
NAMES = FULL + [s for s in SHORT if s not in FULL]
NUMBER = {n: i + 1 for names in (FULL, SHORT) for i, n in enumerate(names)}


def month_numbers() -> Column:
    return F.create_map(*[x for n, i in NUMBER.items() for x in (F.lit(n), F.lit(i))])


def month_in(text: Column) -> Column:
    found = F.filter(F.array(*map(F.lit, NAMES)), lambda n: F.contains(text, n))
    return F.try_element_at(month_numbers(), F.get(found, F.lit(0)))


def date(y: Column, m: Column, d: Column) -> Column:
    return F.struct(y.cast("int").alias("y"), m.cast("int").alias("m"), d.cast("int").alias("d"))


def medline_date(text: Column) -> Column:
    year = F.regexp_extract(text, r"((18|19|20)\d\d)", 1)
    return date(F.when(year != "", year), month_in(text), F.lit(None))


def structured_date(year: Column, month: Column, day: Column) -> Column:
    """A month is a name or a number; a year outside 1701-2099 is null."""
    y = year.try_cast("int")
    return date(F.when(y.between(1701, 2099), y), F.coalesce(F.try_element_at(month_numbers(), month), month.try_cast("int")), day.try_cast("int"))


def _filled(x: Column) -> Column:
    return F.struct(*[F.coalesce(x[k], F.lit(9999)) for k in "ymd"])


def earliest(journal: Column, entry: Column) -> Column:
    """The journal's date if it is strictly earlier, missing parts counting as late; else the entry's."""
    return F.when(_filled(journal) < _filled(entry), journal).otherwise(entry)


#: Statuses by priority (fixed values); else the first one given.
PRIORITY = ["pubmed", "entrez", "medline"]


def by_status(dates: Column) -> Column:
    """dates: array of (status, y, m, d) in order. Of a status given twice the last date counts, at the first's place."""
    known = F.filter(dates, lambda x: x["y"].between(1701, 2099))
    last = lambda s: F.get(F.reverse(F.filter(known, lambda x: x["status"] == s)), F.lit(0))
    first = F.get(known, F.lit(0))["status"]
    pick = F.coalesce(*[last(F.lit(p)) for p in PRIORITY], last(first))
    return F.when(pick.isNotNull(), date(pick["y"], pick["m"], pick["d"]))


def most_complete(dates: Column, strict: bool = False) -> Column:
    """dates: array of (year, season, month, day) strings in order. The first date with the most parts; parts carry over
    from one element to the next unless strict. All-empty gives nulls."""
    start = F.struct(*[F.lit(None).cast("int").alias(k) for k in ("y", "m", "d", "by", "bm", "bd")], F.lit(0).alias("n"))

    def step(acc, x):
        carry = lambda k: F.lit(None).cast("int") if strict else acc[k]
        y = F.coalesce(x["year"].try_cast("int"), carry("y"))
        m = F.coalesce(x["month"].try_cast("int"), month_in(x["month"]), month_in(x["season"]), carry("m"))
        d = F.coalesce(x["day"].try_cast("int"), carry("d"))
        n = sum((v.isNotNull().cast("int") for v in (y, m, d)), F.lit(0))
        better = n > acc["n"]
        pick = lambda new, old: F.when(better, new).otherwise(acc[old])
        return F.struct(y.alias("y"), m.alias("m"), d.alias("d"), pick(y, "by").alias("by"), pick(m, "bm").alias("bm"), pick(d, "bd").alias("bd"), F.greatest(n, acc["n"]).alias("n"))

    return F.aggregate(dates, start, step, lambda a: date(a["by"], a["bm"], a["bd"]))
