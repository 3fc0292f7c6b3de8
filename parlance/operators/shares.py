"""Percentages of a total and of a group."""
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole as a double, NULL for an empty whole."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * 100


def share_of_total(counts: DataFrame, count: str = "count", out: str = "percentage") -> DataFrame:
    """Add each row's percentage of the column total.

    The total is a scalar subquery over the same aggregate, so Spark reuses the
    shuffle of ``counts`` and sums it in parallel; an unpartitioned window would pull
    every group into one task.
    """
    total = counts.agg(F.sum(count)).scalar()
    return counts.withColumn(out, percent(F.col(count), total))


def share_within(counts: DataFrame, group, count: str = "count",
                 out: str = "percentage", drop_null_group: bool = False) -> DataFrame:
    """Add each row's percentage of its group.

    Meant for frames already counted per (group, something of small range), so that a
    window partition holds a handful of rows. ``drop_null_group`` leaves out rows
    whose group is NULL, as an equi join against per-group totals would.
    """
    keys = [group] if isinstance(group, str) else list(group)
    if drop_null_group:
        for key in keys:
            counts = counts.filter(F.col(key).isNotNull())
    return counts.withColumn(
        out, percent(F.col(count), F.sum(count).over(Window.partitionBy(*keys))))


def running_share(counts: DataFrame, share: str = "percentage",
                  out: str = "cumulative_percentage") -> DataFrame:
    """Running total of a share, largest first; equal shares get the same total.

    The window is global, so it is for short report tables (one row per country).
    """
    return counts.withColumn(out, F.sum(share).over(Window.orderBy(F.desc(share))))
