"""Top rows overall and per group, arg-max, key restriction, pivots."""
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_rows(counts: DataFrame, k: int, by: str = "count", ties: list[str] = ()) -> DataFrame:
    """The k largest rows; the tie columns make the choice repeatable."""
    return counts.orderBy(F.desc(by), *[F.asc(t) for t in ties]).limit(k)


def top_rows_per_group(counts: DataFrame, group, k: int, by: str = "count",
                       ties: list[str] = ()) -> DataFrame:
    """k rows of each group, numbered in ``rank``."""
    keys = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*keys).orderBy(F.desc(by), *[F.asc(t) for t in ties])
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def top_ranks_per_group(counts: DataFrame, group: str, k: int, by: str = "count") -> DataFrame:
    """Rows of rank 1..k in each group; all rows of a tie come along."""
    w = Window.partitionBy(group).orderBy(F.desc(by))
    return counts.withColumn("rank", F.rank().over(w)).filter(F.col("rank") <= k)


def largest_per_group(counts: DataFrame, group: str, by: str = "count") -> DataFrame:
    """The row or rows with the group's maximum; a NULL group has none."""
    return top_ranks_per_group(counts.filter(F.col(group).isNotNull()), group, 1, by).drop("rank")


def restrict_to(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key occurs in ``keys``; the key list never passes the driver."""
    return df.join(keys.select(on), on, "left_semi")


def pivot_counts(counts: DataFrame, rows: str, column: str, values: list[str],
                 count: str = "count") -> DataFrame:
    """Long counts to one column per listed value; absent cells stay NULL."""
    return counts.groupBy(rows).pivot(column, values).agg(F.sum(count))


def row_with_first(df: DataFrame, predicate: Column) -> DataFrame:
    """Some row that satisfies the predicate, at most one."""
    return df.filter(predicate).limit(1)
