"""Text columns: pure Catalyst expressions, without Python."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A word character in every engine: Java, Python and RE2 disagree on \\w.
WORD = r"[\p{L}\p{N}_]"
NO_WORD = r"[^\p{L}\p{N}_\t]*"

#: The names of subsections that are recognised (fixed values).
SUBSECTIONS = [
    "abbreviations",
    "additional information",
    "analysis",
    "author contributions",
    "authors' contributions",
    "authors’ contributions",
    "background",
    "case report",
    "competing interests",
    "conclusion",
    "conclusions",
    "conflict of interest",
    "conflicts of interest",
    "consent",
    "data analysis",
    "data collection",
    "discussion",
    "ethics statement",
    "funding",
    "introduction",
    "limitations",
    "material and methods",
    "materials",
    "materials and methods",
    "measures",
    "method",
    "methods",
    "participants",
    "patients and methods",
    "pre-publication history",
    "related literature",
    "results",
    "results and discussion",
    "statistical analyses",
    "statistical analysis",
    "statistical methods",
    "statistics",
    "study design",
    "summary",
    "supplementary data",
    "supplementary information",
    "supplementary material",
    "supporting information",
]

EMPTY_BRACKETS = [(rf"\({NO_WORD}\)", ""), (rf"\[{NO_WORD}\]", ""), (rf"\{{{NO_WORD}\}}", "")]

#: Steps of cleanup, in order (fixed behaviour; operators.xmltext takes them from here). Java syntax; after the third only space and TAB are left of all white space.
CLEANUP = [
    (r"[\x{2028}\x{2029}]", " "),
    (r"[\p{C}&&[^\t]]", ""),
    (r"\p{Z}", " "),
    (r",( *,)*", ","),
    (r"(, *)*\.", "."),
    *EMPTY_BRACKETS,
    (r"\( *([^)]*[^\s)]) *\)", r"($1)"),
    (r" +\.(\s|$)", r".$1"),
    (r" *([,;]) +", r"$1 "),
    (r"(^|\t) +", r"$1"),
    (r" +(\t|$)", r"$1"),
    (r" {2,}", " "),
]


def _chain(col: Column, steps: list[tuple[str, str]]) -> Column:
    for pattern, new in steps:
        col = F.regexp_replace(col, pattern, new)
    return col


def strip_empty_brackets(col: Column) -> Column:
    """Removes brackets without a word character or TAB inside; one pass reaches the fixed point."""
    return _chain(col, EMPTY_BRACKETS)


def cleanup(col: Column) -> Column:
    """Newlines are deleted, other separators become spaces; commas, brackets and spaces are tidied."""
    return _chain(col, CLEANUP)


def title_without_brackets(col: Column) -> Column:
    """'[Title].' becomes 'Title.'; a blank title becomes ''."""
    t = F.trim(col)
    return F.when(t.startswith("[") & t.endswith("]."), F.concat(t.substr(F.lit(2), F.length(t) - 3), F.lit("."))).otherwise(t)


def trim_sentences(col: Column, most: int = 90_000) -> Column:
    """Each part between full stops is cut to `most` characters."""
    return F.array_join(F.transform(F.split(col, r"\.", -1), lambda x: F.substring(x, 1, most)), ".")


def one_line(col: Column) -> Column:
    return F.replace(F.trim(col), F.lit("\n"), F.lit(" "))


def subsection(col: Column) -> Column:
    """The recognised name of a header, else null."""
    name = F.btrim(F.lower(col), F.lit("0123456789. "))
    return F.when(name.isin(SUBSECTIONS), name)


def hash40(col: Column) -> Column:
    """The first ten hexadecimal digits of SHA-256 as a number."""
    return F.conv(F.substring(F.sha2(col, 256), 1, 10), 16, 10).cast("bigint")


def infon_values(xml: Column, key: str = "pmid") -> Column:
    return F.regexp_extract_all(xml, F.lit(rf"<infon key=.{key}.>(\d+)</infon>"), F.lit(1))


def xlink_fix(xml: Column) -> Column:
    """Declares the xlink namespace on the first <article ...> that uses it undeclared."""
    tag = F.regexp_extract(xml, r"(<article[^\n]*?>)", 1)
    at = F.locate("<article ", xml)
    fixed = F.concat(F.substring(xml, 1, 0), xml.substr(F.lit(1), at - 1), F.lit('<article xmlns:xlink="http://www.w3.org/1999/xlink" '), xml.substr(at + 9, F.length(xml)))
    return F.when(xml.contains("xlink") & (tag != "") & ~tag.contains("xmlns:xlink=") & (at > 0), fixed).otherwise(xml)


def first_doi(dois: Column) -> Column:
    return F.get(F.filter(dois, lambda d: d.rlike(r"^[0-9\.]+\/.+[^\/]$")), F.lit(0))


#: Publication types that say nothing of the kind of article (fixed values).
SKIPPED_TYPES = [
    "Research Support, N.I.H., Intramural",
    "Research Support, Non-U.S. Gov't",
    "Research Support, U.S. Gov't, P.H.S.",
    "Research Support, N.I.H., Extramural",
    "Research Support, U.S. Gov't, Non-P.H.S.",
    "English Abstract",
]


def publication_types(types: Column, skipped: list[str] | None = None) -> Column:
    return F.filter(types, lambda t: ~t.isin(SKIPPED_TYPES if skipped is None else skipped))


def file_index(name: Column) -> Column:
    """The six digits of a file's base name; anything else raises."""
    digits = F.regexp_replace(F.substring_index(name, "/", -1), r"\D", "")
    return F.when(F.length(digits) == 6, digits.cast("int")).otherwise(F.raise_error(F.concat(F.lit("not six digits: "), name)).cast("int"))


def output_name(url: Column) -> Column:
    """The name of a converted file, by the folder and base name of its address."""
    base = F.regexp_replace(F.substring_index(url, "/", -1), r"\.(xml\.gz|tar\.gz)$", "")
    return F.concat(F.element_at(F.split(url, "/"), -2), F.lit("_"), base, F.lit(".bioc.xml"))


def listed_names(listing: Column, pattern: str) -> Column:
    return F.array_sort(F.array_distinct(F.regexp_extract_all(listing, F.lit(pattern), F.lit(0))))


def listing_timestamp(html: Column, name: str) -> Column:
    """Epoch seconds of the first date on the line of `name` in an HTML listing."""
    return F.unix_timestamp(F.regexp_extract(html, rf"{name}[^\n]*?(\d{{4}}-\d{{2}}-\d{{2}} \d{{2}}:\d{{2}})", 1), "yyyy-MM-dd HH:mm")
