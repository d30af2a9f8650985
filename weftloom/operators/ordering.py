"""Row numbers and running maxima that never sort a whole group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from weftloom.session import materialize

HOT_GROUP_ROWS = 2_000_000


def _null_safe(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


def number_rows(
    df: DataFrame,
    group: list[str],
    order: list[Column],
    name: str,
    hot_rows: int = HOT_GROUP_ROWS,
) -> DataFrame:
    """Add ``name``: 1, 2, … within ``group`` by ``order`` (which must be unique per group).

    A plain window is used while the largest group is at most ``hot_rows``. Beyond that the
    rows are range-partitioned by group and order, so that a hot group spreads over many tasks;
    each slice is numbered on its own and shifted by the rows in earlier slices.
    """
    largest = df.groupBy(*group).count().agg(F.max("count")).first()[0] or 0
    if largest <= hot_rows:
        return df.withColumn(name, F.row_number().over(W.partitionBy(*group).orderBy(*order)))

    sliced = materialize(
        df.repartitionByRange(*[F.col(g) for g in group], *order).withColumn("_slice", F.spark_partition_id())
    )
    sizes = sliced.groupBy(*group, "_slice").count()
    before = W.partitionBy(*group).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    shifts = sizes.select(*group, "_slice", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_shift"))
    joined = sliced.join(shifts, _null_safe(sliced, shifts, [*group, "_slice"]))
    return joined.select(
        *[sliced[c] for c in df.columns],
        (F.row_number().over(W.partitionBy(*[sliced[g] for g in group], sliced["_slice"]).orderBy(*order))
         + shifts["_shift"]).cast("int").alias(name),
    )


def running_max(df: DataFrame, group: list[str], order: str, value: str, name: str, slice_rows: int = 100_000) -> DataFrame:
    """Add ``name``: the largest ``value`` so far within ``group``; ``order`` is a dense row number."""
    sliced = df.withColumn("_slice", F.floor(F.col(order) / slice_rows))
    tops = sliced.groupBy(*group, "_slice").agg(F.max(value).alias("_top"))
    before = W.partitionBy(*group).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    earlier = tops.select(*group, "_slice", F.max("_top").over(before).alias("_earlier"))
    inside = W.partitionBy(*group, "_slice").orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return (
        sliced.join(earlier, [*group, "_slice"])
        .withColumn(name, F.greatest("_earlier", F.max(value).over(inside)))
        .drop("_slice", "_earlier")
    )
