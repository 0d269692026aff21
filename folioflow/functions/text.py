"""Column expressions over text. All JVM-side; none of them is a UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space of Unicode, and the four separators that Python's str.strip
# and str.split also take. Spelled out: a property class is slower to match.
_WHITE = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# What a class is cut with is tried first: two ranges rule a letter out, not all of these.
SPACE = rf"[\x00-\x20\x7f-\uffff&&[{_WHITE}]]+"
_EDGES = rf"\A[{_WHITE}]+|[{_WHITE}]+\z"


def strip(text: Column) -> Column:
    """Text without white space at either end, in the Unicode sense."""
    return F.regexp_replace(text, _EDGES, "")


def is_blank(text: Column) -> Column:
    """True for NULL, empty and white-space-only text."""
    return F.coalesce(~text.rlike(f"[^{_WHITE}]"), F.lit(True))


def words(text: Column) -> Column:
    """The words of a text, split at white space, without empty ones."""
    return F.array_remove(F.split(text, SPACE), "")


def suffix(path: Column) -> Column:
    """Lower-cased suffix of the last path part, with its dot; else ''.

    A leading dot does not start a suffix and a trailing dot does not make one.
    """
    return F.lower(F.regexp_extract(last_part(path), r"^.+(\.[^./]+)$", 1))


def last_part(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)/*$", 1)


def join_parts(parts: Column, separator: str = "\n\n") -> Column:
    """Parts stripped, blank ones dropped, the rest joined."""
    return F.array_join(
        F.filter(F.transform(parts, strip), lambda p: p.isNotNull() & (p != "")), separator
    )


def ordered_text(order: Column, text: Column, separator: str) -> Column:
    """Aggregate: the texts of one group in ``order``, joined.

    For groups whose result is itself one cell (the pages of one document, five
    passages of one answer), so the group is never larger than the row it makes.
    """
    rows = F.sort_array(F.collect_list(F.struct(order.alias("o"), text.alias("t"))))
    return F.array_join(F.transform(rows, lambda r: r["t"]), separator)
