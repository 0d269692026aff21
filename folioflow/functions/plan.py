"""Keeping a costly value from being computed more than once per row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, value: Column, fields: Callable[[Column], dict[str, Column]]) -> DataFrame:
    """Add (or replace) columns made from one costly ``value``.

    The optimizer pushes filters through projections and copies the expressions
    they use, so a column that takes ten patterns to make can end up being made
    ten times. Here the value is bound to a lambda's variable and the columns
    come out of a generator of exactly one row, which filters are not pushed
    through. Column order is kept; new columns go last.
    """
    made: list[str] = []

    def build(bound: Column) -> Column:
        named = fields(bound)
        made[:] = list(named)
        return F.struct(*[column.alias(name) for name, column in named.items()])

    rows = F.transform(F.array(value), build)
    kept = [c for c in df.columns if c not in made]
    order = [*df.columns, *[c for c in made if c not in df.columns]]
    return df.select(*kept, F.inline_outer(rows)).select(*order)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a costly value that is worked out once, wherever it is used.

    For expressions with lambdas, where a value from outside is made anew for each
    element that looks at it.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))
