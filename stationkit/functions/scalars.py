"""Whole-table statistics as one scalar subquery.

``source.agg(struct(...)).scalar()`` is planned as a subquery that runs once
and is inlined as a value: no join and no broadcast of a table.  It is
attached to the target frame as ONE struct column, and callers read its
fields from that column.  Referencing the subquery expression once per
field would put one copy of the subquery plan into the plan per field.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALARS = "_sk_scalars"


def attach_scalars(target: DataFrame, source: DataFrame, aggs: dict[str, Column],
                   name: str = SCALARS) -> tuple[DataFrame, dict[str, Column]]:
    """Add column ``name`` = struct of ``aggs`` computed over ``source``;
    return the frame and a Column per aggregate (fields of that struct).
    Drop ``name`` when done."""
    packed = source.agg(F.struct(*[a.alias(n) for n, a in aggs.items()]).alias("s")).scalar()
    out = target.withColumn(name, packed)
    return out, {n: F.col(name).getField(n) for n in aggs}


def with_scalars(df: DataFrame, aggs: dict[str, Column],
                 name: str = SCALARS) -> tuple[DataFrame, dict[str, Column]]:
    """``attach_scalars`` with the statistics taken over ``df`` itself."""
    return attach_scalars(df, df, aggs, name)


def free_prefix(df: DataFrame, lead: str = "_sk_") -> str:
    """A prefix that no column of ``df`` begins with, for helper columns."""
    while any(c.startswith(lead) for c in df.columns):
        lead += "_"
    return lead
