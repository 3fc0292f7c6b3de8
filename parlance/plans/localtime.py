"""Activity by local hour, weekday, month, country and continent."""
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clock import month_start, shifted_by_offset, shifted_by_zone
from ..functions.labels import model_family
from ..operators.ranking import largest_per_group, top_ranks_per_group, top_rows
from ..operators.shares import percent, running_share, share_of_total, share_within
from ..sources.dimensions import with_continent


def with_local_time(conversations: DataFrame, locations: DataFrame,
                    by_zone: bool = False, require_country: bool = True) -> DataFrame:
    """Add timezone, gmt_offset and ``offseted_timestamp``, hour and weekday.

    Rows match on country and on state, a NULL state matching a NULL state. Unmatched
    rows keep NULL local times. ``by_zone`` shifts by zone name instead of the stored
    offset. The location table is small; Spark broadcasts it when its size allows and
    otherwise splits hot countries in a skew join.
    """
    if require_country:
        conversations = conversations.filter(F.col("country").isNotNull())
    joined = conversations.join(
        locations,
        (F.col("country") == F.col("ccountry")) & F.col("state").eqNullSafe(F.col("sstate")),
        "left").drop("ccountry", "sstate")
    shifted = shifted_by_zone() if by_zone else shifted_by_offset()
    return (
        joined.withColumn("offseted_timestamp", shifted)
        .withColumn("hour_bin_offseted", F.hour("offseted_timestamp"))
        .withColumn("day_of_week", F.dayofweek("offseted_timestamp"))
    )


def unmatched_locations(local: DataFrame) -> DataFrame:
    """Number of conversations without a time zone, one row."""
    return local.agg(F.count_if(F.col("timezone").isNull()).alias("unmatched"))


def peak_hours_by_country(local: DataFrame, k: int = 5) -> DataFrame:
    """The busiest local hours of each country as a list, busiest first.

    Hours of rank k or better; a tie at the end lengthens the list. Rows without a
    local time take part in the ranking but not in the list.
    """
    counts = local.filter(F.col("country").isNotNull()).groupBy("country", "hour_bin_offseted").count()
    top = top_ranks_per_group(counts, "country", k)
    entry = F.struct((-F.col("count")).alias("n"), F.col("hour_bin_offseted").alias("h"))
    hours = F.transform(F.sort_array(F.collect_list(entry)), lambda e: e["h"])
    return top.groupBy("country").agg(
        F.filter(hours, lambda h: h.isNotNull()).alias("offseted_peak_hours"))


def hourly_share(local: DataFrame) -> DataFrame:
    """Conversations per local hour, percent of all; unmatched rows form a NULL hour."""
    return share_of_total(local.groupBy("hour_bin_offseted").count())


def hourly_share_by_day(local: DataFrame) -> DataFrame:
    """Conversations per weekday and hour, percent of the weekday."""
    grid = local.groupBy("day_of_week", "hour_bin_offseted").count()
    return share_within(grid, "day_of_week", drop_null_group=True)


def busiest_hour_by_day(local: DataFrame) -> DataFrame:
    """The hour with most conversations on each weekday, ties kept."""
    return largest_per_group(hourly_share_by_day(local), "day_of_week").select(
        "day_of_week", "hour_bin_offseted", "percentage")


def share_by_continent(conversations: DataFrame, continents: DataFrame) -> DataFrame:
    """Conversations per continent, percent of all."""
    per_country = conversations.groupBy("country").agg(F.count("*").alias("n"))
    counts = (
        with_continent(per_country, continents)
        .groupBy("continent").agg(F.sum("n").alias("count"))
    )
    return share_of_total(counts)


def weekday_hours_by_continent(local: DataFrame, continents: DataFrame,
                               weekday_total: bool = False) -> DataFrame:
    """Monday-to-Friday conversations per continent and hour, percent of the continent.

    The percentage is of all the continent's conversations, weekends included, unless
    ``weekday_total`` asks for weekdays only.
    """
    weekday = F.col("day_of_week").between(2, 6)
    per_country = local.groupBy("country", "hour_bin_offseted").agg(
        F.count("*").alias("all_days"), F.count_if(weekday).alias("weekdays"))
    counts = (
        with_continent(per_country, continents)
        .filter(F.col("continent").isNotNull())
        .groupBy("continent", "hour_bin_offseted")
        .agg(F.sum("weekdays").alias("count"), F.sum("all_days").alias("_all_days"))
    )
    base = "count" if weekday_total else "_all_days"
    whole = F.sum(base).over(Window.partitionBy("continent"))
    return (
        counts.withColumn("percentage", percent(F.col("count"), whole))
        .filter(F.col("count") > 0)
        .select("continent", "hour_bin_offseted", "count", "percentage")
    )


def busiest_hour_by_continent(local: DataFrame, continents: DataFrame) -> DataFrame:
    """The weekday hour with most conversations on each continent, ties kept."""
    return largest_per_group(weekday_hours_by_continent(local, continents), "continent").select(
        "continent", "hour_bin_offseted", "percentage")


def share_by_country(conversations: DataFrame) -> DataFrame:
    """Conversations per country, percent and running percent, largest first."""
    return running_share(share_of_total(conversations.groupBy("country").count()))


def daily_share(conversations: DataFrame, timestamp: str = "timestamp") -> DataFrame:
    """Conversations per weekday, percent of all."""
    return share_of_total(conversations.groupBy(F.dayofweek(timestamp).alias("day_of_week")).count())


def time_range(local: DataFrame, timestamp: str = "offseted_timestamp") -> DataFrame:
    """First and last time with their months and years, one row."""
    first, last = F.min(timestamp), F.max(timestamp)
    return local.agg(
        first.alias("earliest"), last.alias("latest"),
        F.year(first).alias("earliest_year"), F.month(first).alias("earliest_month"),
        F.year(last).alias("latest_year"), F.month(last).alias("latest_month"))


def _by_month(df: DataFrame, timestamp: str, *keys):
    return df.groupBy(*keys, F.year(timestamp).alias("year"), F.month(timestamp).alias("month"))


def monthly_counts(local: DataFrame, timestamp: str = "offseted_timestamp") -> DataFrame:
    """Conversations per month, in order."""
    return (
        _by_month(local, timestamp).count()
        .withColumn("month_year_timestamp", month_start("year", "month"))
        .orderBy("month_year_timestamp")
    )


def daily_counts(local: DataFrame, timestamp: str = "offseted_timestamp") -> DataFrame:
    """Conversations per calendar day, in order."""
    return local.groupBy(F.to_date(timestamp).alias("date")).count().orderBy("date")


def peak_days(local: DataFrame, k: int = 5, timestamp: str = "offseted_timestamp") -> DataFrame:
    """The k days with most conversations."""
    return top_rows(local.groupBy(F.to_date(timestamp).alias("date")).count(), k, ties=["date"])


def monthly_turns(local: DataFrame, timestamp: str = "offseted_timestamp") -> DataFrame:
    """Mean turns per month, in order."""
    return (
        _by_month(local, timestamp).agg(F.avg("turn").alias("avg_turns"))
        .withColumn("month_year_timestamp", month_start("year", "month"))
        .orderBy("month_year_timestamp")
    )


def monthly_turns_by_family(local: DataFrame, timestamp: str = "offseted_timestamp") -> DataFrame:
    """Mean turns per model family and month, in order."""
    return (
        _by_month(local, timestamp, model_family().alias("model_family"))
        .agg(F.avg("turn").alias("avg_turns"))
        .withColumn("month_year_timestamp", month_start("year", "month"))
        .orderBy("year", "month", "model_family")
    )


def hourly_turns(local: DataFrame) -> DataFrame:
    """Mean turns per local hour, in order."""
    return (
        local.groupBy("hour_bin_offseted").agg(F.avg("turn").alias("avg_turns"))
        .orderBy("hour_bin_offseted")
    )
