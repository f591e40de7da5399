"""Names of columns: what an operator keeps, replaces and uses in between."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def column(name: str) -> Column:
    """A column by its exact name, whatever characters that has."""
    return F.col("`" + name.replace("`", "``") + "`")


def others(df: DataFrame, *replaced: str) -> list[Column]:
    """All columns but those that get new values; Spark takes names as equal in any case."""
    gone = {name.lower() for name in replaced}
    return [column(c) for c in df.columns if c.lower() not in gone]


def unused(df: DataFrame, name: str) -> str:
    """``name``, or the first longer one that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
