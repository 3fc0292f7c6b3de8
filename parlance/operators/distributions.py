"""Histograms, quantile bins and quantiles."""
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.labels import bin_index, top_coded
from .lineage import settled
from .shares import percent

# Relative error of the quantile sketch is 1 / QUANTILE_ACCURACY; below that many
# rows it is exact.
QUANTILE_ACCURACY = 10000
# Distinct values that are ordered in one place at most.
RANGE_ROWS = 100_000


def quantile(value, probability) -> Column:
    """Approximate quantile: an element of the data, NULLs skipped."""
    return F.percentile_approx(value, probability, QUANTILE_ACCURACY)


def in_ranges(rows: DataFrame, *order, out: str = "_range") -> DataFrame:
    """Store ``rows`` in consecutive ranges of ``order``, numbered by ``out``.

    Spark samples the limits of the ranges. They are made narrower until none holds more
    than ``RANGE_ROWS`` rows, so ``order`` must tell rows apart. Rows that fit into one range
    are not moved.
    """
    n = rows.count()
    if n <= RANGE_ROWS:
        return rows.withColumn(out, F.lit(0))
    parts = 2 * n // RANGE_ROWS
    while True:
        ranged = settled(rows.repartitionByRange(parts, *order).withColumn(out, F.spark_partition_id()))
        if ranged.groupBy(out).count().agg(F.max("count")).first()[0] <= RANGE_ROWS:
            return ranged
        parts *= 2


def with_counts_below(counts: DataFrame, measures: list[str]) -> DataFrame:
    """Add ``<measure>_below``: the sum of the measure over all smaller values.

    ``counts`` is a stored table with one row per ``value``. Sums run inside ranges of values
    and are carried from range to range, so no task orders more than ``RANGE_ROWS`` values
    and one row per range, however many values there are.
    """
    if counts.count() <= RANGE_ROWS:
        smaller = Window.partitionBy(F.lit(0)).orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
        return counts.withColumns({f"{m}_below": F.coalesce(F.sum(m).over(smaller), F.lit(0)) for m in measures})
    ranged = in_ranges(counts, "value")
    inside = (
        Window.partitionBy("_range").orderBy("value")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("_range").agg(*[F.sum(m).alias(m) for m in measures]).select(
        F.col("_range").alias("_at"),
        *[F.coalesce(F.sum(m).over(earlier), F.lit(0)).alias(f"_start_{m}") for m in measures])
    out = ranged.join(F.broadcast(starts), F.col("_range") == F.col("_at"))
    for m in measures:
        out = out.withColumn(
            f"{m}_below", F.col(f"_start_{m}") + F.coalesce(F.sum(m).over(inside), F.lit(0)))
    return out.drop("_range", "_at", *[f"_start_{m}" for m in measures])


def interpolated_quantiles(df: DataFrame, value: str, grid: list[float]) -> Column:
    """Exact quantiles with linear interpolation, as a scalar subquery of an array.

    Each lies between the values of two neighbouring ranks; these few values are looked
    up in the running counts, so that no task sees more than one range of values.
    """
    counts = settled(
        df.filter(F.col(value).isNotNull())
        .groupBy(F.col(value).cast("double").alias("value")).agg(F.count("*").alias("n")))
    total = counts.agg(F.sum("n").alias("n")).scalar()
    places = F.array(*[F.lit(p) for p in grid])
    wanted = F.flatten(F.transform(places, lambda p: F.array(
        F.floor(p * (F.col("_total") - 1)), F.ceil(p * (F.col("_total") - 1)))))
    held = F.filter("_wanted", lambda r: (r >= F.col("n_below")) & (r < F.col("n_below") + F.col("n")))
    found = (
        with_counts_below(counts, ["n"]).withColumn("_total", total)
        .withColumn("_wanted", F.array_distinct(wanted))
        .select("value", "_total", F.explode(held).alias("_rank"))
        .agg(F.map_from_entries(F.collect_list(F.struct("_rank", "value"))).alias("m"), F.max("_total").alias("n"))
    )

    def between(p):
        at = p * (F.col("n") - 1)
        low, high = [F.try_element_at("m", f(at)) for f in (F.floor, F.ceil)]
        return low + (at - F.floor(at)) * (high - low)

    return found.select(F.transform(places, between).alias("edges")).scalar()


def capped_histogram(df: DataFrame, value: str, ceiling: int, out: str, weight: str,
                     by: list[str] = ()) -> DataFrame:
    """Rows per top-coded value (and group)."""
    return (
        df.groupBy(*by, top_coded(value, ceiling).alias(out))
        .agg(F.count("*").alias(weight))
    )


def equal_width_histogram(spark: SparkSession, df: DataFrame, value: str, bins: int) -> DataFrame:
    """Counts in ``bins`` equal-width bins between minimum and maximum.

    Empty bins are listed with 0. The top edge belongs to the last bin. If all values
    are equal the range is widened by a half on both sides.
    """
    values = (
        df.filter(F.col(value).isNotNull())
        .groupBy(F.col(value).cast("double").alias("v")).count()
    )
    # Reading the counts here too keeps this aggregate equal to the one below, so
    # that Spark runs it once.
    range_ = values.agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.sum("count").alias("rows"))
    flat = F.col("lo") == F.col("hi")
    range_ = range_.select(F.struct(
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"), "rows").alias("r"))
    lo, hi = range_.scalar()["lo"], range_.scalar()["hi"]
    counted = (
        values.groupBy(F.least(F.floor((F.col("v") - lo) / (hi - lo) * bins),
                         F.lit(bins - 1)).cast("long").alias("bin"))
        .agg(F.sum("count").alias("n"))
    )
    return (
        spark.range(bins).withColumnRenamed("id", "bin")
        .join(counted, "bin", "left")
        .select(
            "bin",
            (lo + F.col("bin") * (hi - lo) / bins).alias("low"),
            (lo + (F.col("bin") + 1) * (hi - lo) / bins).alias("high"),
            F.coalesce("n", F.lit(0)).alias("count"))
    )


def quantile_bin_histogram(df: DataFrame, value: str, bins: int = 10,
                           exact: bool = False) -> DataFrame:
    """Rows per quantile bin with the bin's edges and its percentage.

    Cut points are elements of the data, or interpolated when ``exact``; exact ones are
    read from running counts of the distinct values.
    """
    grid = [i / bins for i in range(bins + 1)]
    if exact:
        edges = interpolated_quantiles(df, value, grid)
    else:
        edges = df.agg(quantile(value, grid).alias("edges")).scalar()
    counts = (
        df.filter(F.col(value).isNotNull())
        .groupBy(bin_index(value, edges, bins).alias("bin")).count()
    )
    total = F.sum("count").over(Window.partitionBy())
    return counts.select(
        "bin",
        F.get(edges, F.col("bin")).alias("low"),
        F.get(edges, F.col("bin") + 1).alias("high"),
        "count",
        percent(F.col("count"), total).alias("percentage"))
