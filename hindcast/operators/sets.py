"""Bags of rows: unions by name and containment that respects multiplicity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_by_name(*tables: DataFrame) -> DataFrame:
    """All rows of all tables; a column a table lacks is null."""
    whole = tables[0]
    for table in tables[1:]:
        whole = whole.unionByName(table, allowMissingColumns=True)
    return whole


def excess(rows: DataFrame, held: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows that occur more often in ``rows`` than in ``held``, with the difference.

    One grouping over the signed union: copies collapse before the shuffle, and nulls compare
    as equal.
    """
    columns = list(columns or rows.columns)
    signed = rows.select(*columns, F.lit(1).alias("_n")).unionByName(
        held.select(*columns, F.lit(-1).alias("_n"))
    )
    return signed.groupBy(*columns).agg(F.sum("_n").alias("surplus")).where("surplus > 0")
