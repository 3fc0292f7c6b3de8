"""Mobile and desktop use."""
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.labels import device_type, indicator
from ..operators.inference import (
    bootstrap_median_difference, descriptives, mann_whitney, moments, normal_quantile_table,
)
from ..operators.sampling import equal_size_sample
from ..operators.shares import percent
from ..sources.dimensions import with_continent


def with_device(conversations: DataFrame, separate_unknown: bool = False) -> DataFrame:
    """Add ``device_type``."""
    return conversations.withColumn("device_type", device_type(separate_unknown=separate_unknown))


def device_counts(devices: DataFrame) -> DataFrame:
    return devices.groupBy("device_type").count()


def devices_by_country(devices: DataFrame) -> DataFrame:
    """Mobile and desktop conversations per country, total and percentages."""
    return (
        devices.groupBy("country").pivot("device_type", ["mobile", "desktop"]).count()
        .fillna(0, ["mobile", "desktop"])
        .withColumn("total_devices", F.expr("mobile + desktop"))
        .withColumn("mobile_percentage", percent(F.col("mobile"), F.col("total_devices")))
        .withColumn("desktop_percentage", 100 - F.col("mobile_percentage"))
    )


def large_countries(per_country: DataFrame, more_than: int = 2000) -> DataFrame:
    """Rows of ``devices_by_country`` whose country has enough conversations, a number it holds."""
    return per_country.filter(F.col("total_devices") > more_than)


def devices_by_continent(devices: DataFrame, continents: DataFrame) -> DataFrame:
    """Mobile and desktop conversations per continent, with percentages."""
    return (
        with_continent(devices_by_country(devices), continents)
        .filter(F.col("total_devices") > 0)
        .groupBy("continent")
        .agg(F.sum("mobile").alias("total_mobile"), F.sum("desktop").alias("total_desktop"),
             F.sum("total_devices").alias("total_devices"))
        .withColumn("mobile_percentage", percent(F.col("total_mobile"), F.col("total_devices")))
        .withColumn("desktop_percentage", percent(F.col("total_desktop"), F.col("total_devices")))
    )


def toxic_rate_by_device(devices: DataFrame) -> DataFrame:
    """Share of toxic conversations per device; an unknown verdict counts as not toxic."""
    return devices.groupBy("device_type").agg(F.avg(indicator("toxic")).alias("avg_toxicity"))


def messages_by_device(devices: DataFrame) -> DataFrame:
    """Mean number of messages per conversation (NULL arrays left out)."""
    n = F.when(F.col("conversation.role").isNotNull(), F.size("conversation.role"))
    return devices.groupBy("device_type").agg(F.avg(n).alias("avg_messages"))


def message_length_by_device(devices: DataFrame) -> DataFrame:
    """Mean characters per message: all characters over all messages of the device."""
    lengths = F.transform(F.col("conversation.content"), F.length)
    known = F.filter(lengths, lambda n: n.isNotNull())
    total = F.aggregate(known, F.lit(0).cast("long"), lambda a, n: a + n)
    return devices.groupBy("device_type").agg(
        F.try_divide(F.sum(total), F.sum(F.greatest(F.size(known), F.lit(0)))).alias("avg_message_length"))


def with_device_percentages(devices: DataFrame) -> DataFrame:
    """Per row: 100 or 0 for mobile, the complement for desktop."""
    mobile = indicator(F.col("device_type") == "mobile")
    desktop = indicator(F.col("device_type") == "desktop")
    return (
        devices.withColumn("total_devices", mobile + desktop)
        .withColumn("mobile_percentage", percent(mobile, F.col("total_devices")))
        .withColumn("desktop_percentage", 100 - F.col("mobile_percentage"))
    )


def turns_by_device(devices: DataFrame) -> DataFrame:
    """Mean and deviation of turns, count and share per device, beside the overall mean."""
    everything = Window.partitionBy()  # two or three rows
    overall = F.sum("_sum").over(everything) / F.sum("_known").over(everything)
    return (
        devices.groupBy("device_type").agg(
            F.avg("turn").alias("avg_turns"), F.stddev("turn").alias("std_turns"),
            F.count("*").alias("count"), F.sum("turn").alias("_sum"), F.count("turn").alias("_known"))
        .withColumn("percentage", percent(F.col("count"), F.sum("count").over(everything)))
        .withColumn("avg_turns_all", overall)
        .drop("_sum", "_known")
    )


def turn_moments_by_device(devices: DataFrame) -> DataFrame:
    """Count, mean, deviation, skewness and kurtosis of turns per device."""
    return moments(devices, "turn", "device_type")


def turn_descriptives_by_device(devices: DataFrame) -> DataFrame:
    """Quartiles and the like of turns per device."""
    return descriptives(devices, "turn", "device_type")


def turn_normality_table(devices: DataFrame, device: str, points: int = 99) -> DataFrame:
    """Quantiles of one device's turns beside normal quantiles."""
    return normal_quantile_table(devices.filter(F.col("device_type") == device), "turn", points)


def compare_devices(devices: DataFrame, keys=(), size: int | None = None, seed: int = 42) -> DataFrame:
    """Mann-Whitney test of turns, desktop against mobile.

    All rows are tested, which the counted form makes affordable; ``size`` asks for
    samples of equal size instead, drawn by the hash of ``keys``.
    """
    if size is not None:
        devices = equal_size_sample(devices, "device_type", ["desktop", "mobile"], size, keys, seed)
    return mann_whitney(devices, "turn", "device_type", "desktop", "mobile")


def median_turn_difference(spark: SparkSession, devices: DataFrame, replicates: int = 9999,
                           confidence: float = 0.95, seed: int = 42, method: str = "bca") -> DataFrame:
    """Bootstrap interval of the desktop minus mobile median turn, ``bca`` or ``percentile``."""
    return bootstrap_median_difference(
        spark, devices, "turn", "device_type", "desktop", "mobile", replicates, confidence, seed, method)
