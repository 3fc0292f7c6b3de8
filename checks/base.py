"""Shared pieces of the registered queries."""
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class Check:
    """A registered query and, where SQL can say it, the same in DuckDB's SQL."""
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def r6(name: str) -> Column:
    """A double rounded for comparison."""
    return F.round(F.col(name).cast("double"), 6).alias(name)


def big(name: str) -> Column:
    return F.col(name).cast("long").alias(name)


def known(name: str) -> Column:
    """A whole number, -1 for NULL."""
    return F.coalesce(F.col(name).cast("long"), F.lit(-1).cast("long")).alias(name)


def sum_big(expression: str) -> str:
    return f"CAST(sum({expression}) AS BIGINT)"


def normal_sql(z: str) -> str:
    """The normal distribution function in DuckDB's SQL, by its power series; 0 or 1 beyond 8."""
    steps = "list_transform(range(120, 0, -1), lambda k: CAST(2 * k + 1 AS DOUBLE))"
    series = f"list_reduce(list_prepend(CAST(1 AS DOUBLE), {steps}), lambda acc, m: 1 + ({z}) * ({z}) / m * acc)"
    return (f"(CASE WHEN {z} > 8 THEN 1.0 WHEN {z} < -8 THEN 0.0 "
            f"ELSE 0.5 + exp(-({z}) * ({z}) / 2) / sqrt(2 * pi()) * ({z}) * {series} END)")
