"""Joins in which one key may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

HOT_ROWS = 1_000_000
HOT_KEYS = 20_000


def skew_join(rows: DataFrame, table: DataFrame, on: list[str], how: str = "inner", hot_rows: int = HOT_ROWS) -> DataFrame:
    """``rows`` joined with ``table``, in which each value of ``on`` occurs once; ``rows`` is read twice.

    A key with more than ``hot_rows`` rows, and more than one in ``HOT_KEYS`` of all rows, is hot. So at most ``HOT_KEYS`` keys
    are; their rows of ``table`` are broadcast, and the rows that look for them stay where they are. All others meet in a shuffle.
    """
    sizes = rows.groupBy(*on).count()
    total = rows.count()
    hot = sizes.where(F.col("count") > max(hot_rows, total // HOT_KEYS)).select(*on)
    if total <= hot_rows or hot.isEmpty():
        return rows.join(table, on, how)
    few = F.broadcast(hot)
    crowded = rows.join(few, on, "left_semi").join(F.broadcast(table.join(few, on, "left_semi")), on, how)
    return crowded.unionByName(rows.join(few, on, "left_anti").join(table, on, how))
