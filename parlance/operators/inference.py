"""Rank and distribution tests on counted values.

Samples are reduced to (value, count) before anything is ordered. Cumulative counts
are formed inside value ranges and carried from range to range, so no task sees more
than one range of distinct values. The counts are stored once: the log is read a
single time per test.
"""
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import tails
from ..functions.labels import effect_label
from ..functions.numeric import normal_cdf
from .distributions import quantile, with_counts_below
from .lineage import settled


def two_sample_counts(df: DataFrame, value: str, group: str, first, second,
                      weight: str | None = None) -> DataFrame:
    """(value, n1, n2): how often each value occurs in the two groups.

    ``weight`` names a count column when the rows are counted already.
    """
    n = F.lit(1).cast("long") if weight is None else F.col(weight)

    def rows_of(g):
        return F.sum(F.when(F.col(group) == F.lit(g), n).otherwise(0))

    return (
        df.filter(F.col(value).isNotNull() & F.col(group).isin([first, second]))
        .groupBy(F.col(value).cast("double").alias("value"))
        .agg(rows_of(first).alias("n1"), rows_of(second).alias("n2"))
    )


def _exact_u(*columns) -> Column:
    """The exact p-value and its normal deviate where the exact distribution applies."""
    def exact(n1: pd.Series, n2: pd.Series, u: pd.Series, tied: pd.Series) -> pd.DataFrame:
        out = []
        for a, b, value, t in zip(n1, n2, u, tied):
            p = z = None
            if pd.notna(value) and tails.uses_exact_u(int(a), int(b), bool(t)):
                p = tails.exact_u_tail(a, b, value)
                z = max(0.0, -NormalDist().inv_cdf(p / 2))
            out.append((p, z))
        return pd.DataFrame(out, columns=["p", "z"], dtype=float)

    kind = T.StructType([T.StructField("p", T.DoubleType()), T.StructField("z", T.DoubleType())])
    return F.pandas_udf(exact, kind)(*columns)


def mann_whitney(df: DataFrame, value: str, group: str, first, second,
                 weight: str | None = None, exact: bool = True) -> DataFrame:
    """Two-sided Mann-Whitney U test, one row.

    ``u`` counts the pairs in which the first sample's value is larger, ties as half. The
    p-value is exact if no values are equal and one sample is small (see
    ``functions.tails``); otherwise, or without ``exact``, it is the normal approximation
    with tie and continuity correction. ``z`` is the normal deviate of the p-value and
    ``effect_size`` is |z| / sqrt(n1 + n2).
    """
    counts = settled(two_sample_counts(df, value, group, first, second, weight))
    table = with_counts_below(counts, ["n2"])
    ties = (F.col("n1") + F.col("n2")).cast("double")
    sums = table.agg(
        F.sum("n1").alias("n1"), F.sum("n2").alias("n2"),
        F.sum(F.col("n1") * (F.col("n2_below") + F.col("n2") / 2)).alias("u"),
        F.sum(ties * ties * ties - ties).alias("_ties"))
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    n = n1 + n2
    variance = n1 * n2 / 12 * ((n + 1) - F.try_divide(F.col("_ties"), n * (n - 1)))
    larger = F.greatest(F.col("u"), n1 * n2 - F.col("u"))
    z = F.greatest(F.try_divide(larger - n1 * n2 / 2 - 0.5, F.sqrt(variance)), F.lit(0.0))
    out = sums.withColumn("z", z).withColumn("p_value", F.least(F.lit(1.0), 2 * normal_cdf(-F.col("z"))))
    if exact:
        found = _exact_u(F.coalesce("n1", F.lit(0)), F.coalesce("n2", F.lit(0)), F.col("u"), F.coalesce(F.col("_ties") > 0, F.lit(True)))
        out = out.withColumn("_exact", found).withColumns({
            "z": F.coalesce("_exact.z", "z"), "p_value": F.coalesce("_exact.p", "p_value")}).drop("_exact")
    return (
        out.withColumn("effect_size", F.try_divide(F.col("z"), F.sqrt(n)))
        .withColumn("interpretation", effect_label("effect_size"))
        .drop("_ties")
    )


def _kolmogorov_p(n: str, distance: str) -> Column:
    """P-value of the largest distance, exact for small samples."""
    def tail(rows: pd.Series, distances: pd.Series) -> pd.Series:
        return pd.Series([None if pd.isna(r) or pd.isna(d) else tails.kolmogorov_tail(int(r), float(d))
                          for r, d in zip(rows, distances)], dtype=float)

    return F.pandas_udf(tail, T.DoubleType())(n, distance)


def ks_against_fitted_normal(df: DataFrame, value: str, weight: str | None = None) -> DataFrame:
    """Kolmogorov-Smirnov distance to the normal with the sample's mean and deviation.

    One row: n, mean, std, statistic, p_value. The p-value is that of a fully given
    distribution: exact for samples of up to 10,000 rows, the limiting one beyond.
    """
    counts = settled(
        df.filter(F.col(value).isNotNull())
        .groupBy(F.col(value).cast("double").alias("value"))
        .agg((F.count("*") if weight is None else F.sum(weight)).alias("n"))
    )
    n, v = F.col("n").cast("double"), F.col("value")
    centre = counts.agg(F.struct(
        F.sum("n").alias("n"), (F.sum(n * v) / F.sum(n)).alias("mean")).alias("c")).scalar()
    fit = (
        counts.withColumn("c", centre)
        .agg(F.max("c").alias("c"), F.sum(n * F.pow(v - F.col("c.mean"), 2)).alias("squares"))
        .select(F.struct(
            "c.n", "c.mean",
            F.sqrt(F.try_divide(F.col("squares"), F.col("c.n") - 1)).alias("std")).alias("fit"))
        .scalar()
    )
    fitted = with_counts_below(counts, ["n"]).withColumn("_fit", fit)
    total = F.col("_fit.n").cast("double")
    z = F.try_divide(F.col("value") - F.col("_fit.mean"), F.col("_fit.std"))
    steps = fitted.select(
        "_fit", normal_cdf(z).alias("_cdf"), (F.col("n_below") / total).alias("_below"),
        ((F.col("n_below") + F.col("n")) / total).alias("_upto"))
    gap = F.greatest(F.col("_upto") - F.col("_cdf"), F.col("_cdf") - F.col("_below"))
    return (
        steps.agg(F.max("_fit").alias("_fit"), F.max(gap).alias("statistic"))
        .select("_fit.n", "_fit.mean", "_fit.std", "statistic")
        .withColumn("p_value", _kolmogorov_p("n", "statistic"))
    )


def bootstrap_median_difference(spark: SparkSession, df: DataFrame, value: str, group: str,
                                first, second, replicates: int = 9999,
                                confidence: float = 0.95, seed: int = 42, method: str = "bca") -> DataFrame:
    """Bootstrap interval of the difference of medians, one row: replicates, low, high.

    The median of a resample of n rows is its middle order statistic, whose place in
    the sample is the place of a Beta variate (two joint ones for even n). Drawing
    that place gives the bootstrap distribution of the median itself without drawing
    n rows per replicate: the work is one lookup per replicate and group in the
    cumulative counts.

    ``method`` is ``bca`` (bias-corrected and accelerated) or ``percentile``. The
    acceleration needs the median with one row left out, which takes at most three values
    and is read from the rows around the middle. Without rows in a group, low and high
    are NULL.
    """
    if method not in ("bca", "percentile"):
        raise ValueError(f"unknown method {method}")
    counts = settled(two_sample_counts(df, value, group, first, second))
    parts = with_counts_below(counts, ["n1", "n2"])
    pieces = F.explode(F.array(
        F.struct(F.lit(1).alias("part"), F.col("n1").alias("n"), F.col("n1_below").alias("below")),
        F.struct(F.lit(2).alias("part"), F.col("n2").alias("n"), F.col("n2_below").alias("below"))))
    steps = parts.select("value", pieces.alias("p")).select("value", "p.*").filter(F.col("n") > 0)
    sizes = counts.agg(F.struct(F.sum("n1").alias("n1"), F.sum("n2").alias("n2")).alias("s")).scalar()

    # The place of a middle order statistic deviates from the middle by sqrt(n) / 2. Ranks
    # beyond twenty times that do not occur; inside, slices of sqrt(n) / 16 ranks are short
    # against the spread of the draws, so no slice gathers many draws and many values.
    size = F.when(F.col("part") == 1, sizes["n1"]).otherwise(sizes["n2"])
    width = F.greatest(F.ceil(F.sqrt(size) / 16), F.lit(1))
    lowest = F.greatest(F.floor(size / 2 - 10 * F.sqrt(size)), F.lit(0))
    highest = F.least(F.ceil(size / 2 + 10 * F.sqrt(size)), size - 1)
    central = settled(steps.filter((F.col("below") <= highest) & (F.col("below") + F.col("n") > lowest)))
    steps = central.withColumn(
        "slice", F.explode(F.sequence(
            F.floor(F.greatest(F.col("below"), lowest) / width),
            F.floor(F.least(F.col("below") + F.col("n") - 1, highest) / width))))
    block = 1000  # replicates that share a generator

    @F.pandas_udf(T.ArrayType(T.ArrayType(T.DoubleType())))
    def middle_places(number: pd.Series, wanted: pd.Series, n: pd.Series, part: pd.Series) -> pd.Series:
        """Places in [0, 1) of the middle order statistic(s) of n uniform draws, per replicate."""
        out = []
        for r, count, m, p in zip(number, wanted, n, part):
            rng = np.random.default_rng([seed, int(r), int(p)])
            k = (int(m) + 1) // 2
            low = rng.beta(k, m - k + 1, int(count))
            high = low if m % 2 else 1 - (1 - low) * rng.beta(m - k, 1, int(count))
            out.append(np.stack([low, high], axis=1).tolist())
        return pd.Series(out)

    wanted = F.least(F.lit(block), F.lit(replicates) - F.col("id") * block).cast("int")
    places = (
        spark.range(-(-replicates // block)).withColumn("part", F.explode(F.array(F.lit(1), F.lit(2))))
        .withColumn("size", size).filter(F.col("size") > 0)
        .select("id", "part", "size", F.posexplode(middle_places("id", wanted, "size", "part")).alias("at", "places"))
    )
    draws = (
        places.select((F.col("id") * block + F.col("at")).alias("replicate"), "part", "size", F.explode("places").alias("place"))
        .withColumn("rank", F.greatest(lowest, F.least(F.floor(F.col("place") * F.col("size")), highest)))
        .withColumn("slice", F.floor(F.col("rank") / width))
    )
    medians = (
        draws.join(steps, ["part", "slice"])
        .filter((F.col("rank") >= F.col("below")) & (F.col("rank") < F.col("below") + F.col("n")))
        .groupBy("replicate")
        .agg((F.avg(F.when(F.col("part") == 1, F.col("value")))
              - F.avg(F.when(F.col("part") == 2, F.col("value")))).alias("difference"))
    )
    # The rows around the middle of each sample, at most three.
    around = F.array(*[F.struct(
        F.lit(o).alias("offset"), F.greatest(F.lit(0), F.least(F.floor(F.col("size") / 2) + o, F.col("size") - 1)).alias("rank"))
        for o in (-1, 0, 1)])
    middle = (
        central.withColumn("size", size).select("part", "value", "size", "below", "n", F.inline(around))
        .filter((F.col("rank") >= F.col("below")) & (F.col("rank") < F.col("below") + F.col("n")))
        .agg(F.collect_list(F.struct("part", "offset", "size", "value")).alias("middle")).scalar()
    )
    gathered = medians.agg(F.sort_array(F.collect_list("difference")).alias("differences")).withColumn("middle", middle)

    def finish(frames):
        for pdf in frames:
            for differences, rows in zip(pdf["differences"], pdf["middle"]):
                found, leave_one_out, medians_ = {}, [], []
                for r in rows:
                    found.setdefault(r["part"], {})[r["offset"]] = (r["value"], int(r["size"]))
                for part in sorted(found):
                    (a, n), (b, _), (c, _) = (found[part][o] for o in (-1, 0, 1))
                    sign = 1 if part == 1 else -1
                    low, mid, high = (a, None, b) if n % 2 == 0 else (a, b, c)
                    medians_.append(sign * ((a + b) / 2 if n % 2 == 0 else b))
                    leave_one_out.append([(sign * v, w) for v, w in tails.middle_without_one(low, mid, high, n)])
                accelerated = tails.acceleration(leave_one_out) if method == "bca" else None
                low, high = tails.bootstrap_interval(differences, sum(medians_), accelerated, confidence)
                yield pd.DataFrame({"replicates": [len(differences)], "low": [None if low != low else low],
                                    "high": [None if high != high else high]})

    return gathered.mapInPandas(finish, "replicates long, low double, high double")


def descriptives(df: DataFrame, value: str, group: str) -> DataFrame:
    """Count, mean, deviation, quartiles and interquartile range per group."""
    return (
        df.groupBy(group)
        .agg(F.count(value).alias("count"), F.avg(value).alias("mean"),
             F.stddev(value).alias("std_dev"), quantile(value, [0.25, 0.5, 0.75]).alias("_q"))
        .select(group, "count", "mean", "std_dev",
                F.get("_q", F.lit(0)).alias("q1"), F.get("_q", F.lit(1)).alias("median"),
                F.get("_q", F.lit(2)).alias("q3"),
                (F.get("_q", F.lit(2)) - F.get("_q", F.lit(0))).alias("iqr"))
    )


def moments(df: DataFrame, value: str, group: str) -> DataFrame:
    """Count, mean, deviation, skewness and kurtosis per group."""
    return df.groupBy(group).agg(
        F.count(value).alias("count"), F.avg(value).alias("mean"),
        F.stddev(value).alias("std"), F.skewness(value).alias("skewness"),
        F.kurtosis(value).alias("kurtosis"))


def normal_quantile_table(df: DataFrame, value: str, points: int = 99) -> DataFrame:
    """Sample quantiles beside standard normal ones, the data of a Q-Q plot."""
    grid = [(i + 1) / (points + 1) for i in range(points)]
    rows = F.array(*[
        F.struct(F.lit(p).alias("probability"), F.lit(NormalDist().inv_cdf(p)).alias("normal"))
        for p in grid])
    return (
        df.agg(quantile(F.col(value).cast("double"), grid).alias("q"))
        .select(F.explode(F.arrays_zip(rows.alias("n"), F.col("q"))).alias("r"))
        .select("r.n.probability", "r.n.normal", F.col("r.q").alias("sample"))
    )
