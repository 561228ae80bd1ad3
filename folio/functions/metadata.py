"""Packed metadata strings and their structured forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def author_name(fore: Column, last: Column, collective: Column) -> Column:
    """'fore last', else last, else fore, else the collective; an author without any raises."""
    both = F.when(fore.isNotNull() & last.isNotNull(), F.concat_ws(" ", fore, last))
    return F.coalesce(both, last, fore, collective, F.raise_error(F.lit("author without a name")).cast("string"))


def _plain(x: Column) -> Column:
    return F.when(x.rlike(r"[|~]"), F.raise_error(F.concat(F.lit("delimiter in "), x)).cast("string")).otherwise(x)


def encode_mesh(mesh: Column) -> Column:
    """array<struct<ui, major, name, qualifiers: array<struct<ui, major, name>>>> to its packed string."""
    one = lambda kind, x: F.concat(F.lit(f"{kind}|"), _plain(x["ui"]), F.lit("|"), _plain(x["major"]), F.lit("|"), _plain(x["name"]))
    return F.array_join(F.transform(mesh, lambda h: F.array_join(F.concat(F.array(one("Descriptor", h)), F.transform(h["qualifiers"], lambda q: one("Qualifier", q))), "~")), "\t")


def decode_mesh(packed: Column) -> Column:
    def fields(x):
        p = F.split(x, r"\|")
        return [p[1].alias("ui"), p[2].alias("major"), p[3].alias("name")]

    def heading(x):
        parts = F.split(x, "~")
        return F.struct(*fields(parts[0]), F.transform(F.slice(parts, 2, F.size(parts)), lambda q: F.struct(*fields(q))).alias("qualifiers"))

    return F.transform(F.filter(F.split(packed, "\t"), lambda x: x != ""), heading)


def encode_fields(items: Column, *names: str) -> Column:
    """Structs as name|name TAB name|name (chemicals: ui, name; supplementary: ui, type, name)."""
    return F.array_join(F.transform(items, lambda x: F.concat_ws("|", *[x[n] for n in names])), "\t")


def decode_fields(packed: Column, *names: str) -> Column:
    return F.transform(F.filter(F.split(packed, "\t"), lambda x: x != ""), lambda x: F.struct(*[F.get(F.split(x, r"\|"), F.lit(i)).alias(n) for i, n in enumerate(names)]))
