"""Repeat use, engagement and time gaps per user."""
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import model_family, top_coded
from ..operators.distributions import capped_histogram, quantile, quantile_bin_histogram
from ..operators.lineage import settled
from ..operators.ordering import gap_statistics
from ..operators.ranking import restrict_to, top_rows
from ..operators.shares import percent, share_of_total, share_within


def identity_candidates(conversations: DataFrame, user: str = "hashed_ip") -> DataFrame:
    """Users under three definitions, one row: address, with agent, with language.

    A NULL part counts as a value of its own.
    """
    agent, language = F.col("header.user-agent"), F.col("header.accept-language")
    # Distinct combinations first: counting several things apart multiplies the rows it reads.
    users = conversations.groupBy(F.col(user), agent.alias("agent"), language.alias("language")).agg(F.lit(1))
    agent, language = F.col("agent"), F.col("language")
    return users.agg(
        F.count_distinct(F.struct(user)).alias("by_ip"),
        F.count_distinct(F.struct(F.col(user), agent)).alias("by_ip_and_agent"),
        F.count_distinct(F.struct(F.col(user), language)).alias("by_ip_and_language"))


def conversations_per_user(conversations: DataFrame, user: str = "hashed_ip",
                           conversation: str = "conversation_hash") -> DataFrame:
    """Number of conversations of each user."""
    return conversations.groupBy(user).agg(F.count(conversation).alias("conversation_count"))


def repeat_share(conversations: DataFrame, more_than: int = 1, user: str = "hashed_ip",
                 conversation: str = "conversation_hash") -> DataFrame:
    """Users, users with more conversations than the limit, and their percentage."""
    many = F.count_if(F.col("conversation_count") > more_than)
    return conversations_per_user(conversations, user, conversation).agg(
        F.count("*").alias("total_users"), many.alias("repeat_users"),
        percent(many, F.count("*")).alias("percentage"))


def conversation_count_histogram(conversations: DataFrame, ceiling: int = 15,
                                 user: str = "hashed_ip",
                                 conversation: str = "conversation_hash") -> DataFrame:
    """Users per number of conversations, top-coded, with percentages."""
    per_user = conversations_per_user(conversations, user, conversation)
    return share_of_total(
        capped_histogram(per_user, "conversation_count", ceiling, "conversation_count",
                         "user_count"), "user_count")


def conversation_count_histogram_by_model(conversations: DataFrame, ceiling: int = 10,
                                          user: str = "hashed_ip") -> DataFrame:
    """The same per model, percentages within the model."""
    per_user = conversations.groupBy(user, "model").agg(F.count("*").alias("n"))
    return share_within(
        capped_histogram(per_user, "n", ceiling, "conversation_count", "user_count", ["model"]),
        "model", "user_count")


def share_by_model(conversations: DataFrame) -> DataFrame:
    """Conversations and percentage per model."""
    return share_of_total(conversations.groupBy("model").count())


def share_by_family(conversations: DataFrame) -> DataFrame:
    """Conversations and percentage per model family."""
    return share_of_total(
        conversations.groupBy(model_family().alias("model_family")).count())


def mean_turns_by_model(conversations: DataFrame) -> DataFrame:
    return conversations.groupBy("model").agg(F.avg("turn").alias("avg_turns"))


def mean_turns_by_family(conversations: DataFrame) -> DataFrame:
    return conversations.groupBy(model_family().alias("model_family")).agg(
        F.avg("turn").alias("avg_turns"))


def turn_distribution(conversations: DataFrame, by_family: bool = True,
                      ceiling: int = 10) -> DataFrame:
    """Conversations per top-coded turn and their percentage of the family or model."""
    key = "model_family" if by_family else "model"
    keyed = conversations.withColumn("model_family", model_family()) if by_family else conversations
    counts = keyed.groupBy(key, top_coded("turn", ceiling).alias("turn")).count()
    return share_within(counts, key, drop_null_group=True)


def activity_profile(conversations: DataFrame, user: str = "hashed_ip",
                     timestamp: str = "timestamp", per_day: float = 2) -> DataFrame:
    """One row per user: count, first and last time, days, conversations per day.

    ``avg_conv_per_day`` is NULL for users active on a single calendar day, which
    leaves them outside ``repeat_user`` and outside every percentile cut. One
    aggregation with map-side combine yields all of it, ``avg_turns`` included. For
    several analyses of one profile, settle it first (``operators.lineage``).
    """
    return _with_daily_rate(
        conversations.filter(F.col(user).isNotNull())
        .groupBy(user)
        .agg(F.count("*").alias("conv_count"),
             F.min(timestamp).alias("earliest_date"),
             F.max(timestamp).alias("latest_date"),
             F.avg("turn").alias("avg_turns")), per_day)


def _with_daily_rate(totals: DataFrame, per_day: float) -> DataFrame:
    return (
        totals.withColumn("num_days", F.datediff("latest_date", "earliest_date"))
        .withColumn("avg_conv_per_day", F.try_divide(F.col("conv_count"), F.col("num_days")))
        .withColumn("repeat_user", F.when(F.col("avg_conv_per_day") > per_day, 1).otherwise(0))
    )


def repeat_class_sizes(profile: DataFrame) -> DataFrame:
    """Users per repeat class."""
    return profile.groupBy("repeat_user").count()


def without_heaviest(profile: DataFrame, probability: float = 0.9) -> DataFrame:
    """Users up to the given quantile of conversations per day."""
    cut = profile.agg(quantile("avg_conv_per_day", probability)).scalar()
    return profile.filter(F.col("avg_conv_per_day") <= cut)


def conversation_counts_by_class(profile: DataFrame) -> DataFrame:
    """Users per conversation count within each repeat class, with percentages."""
    return share_within(profile.groupBy("repeat_user", "conv_count").count(), "repeat_user")


def turns_by_class(profile: DataFrame) -> DataFrame:
    """Mean and median of users' mean turns per repeat class and over all users.

    ``user_class`` is repeat, other or all.
    """
    label = (
        F.when(F.grouping("repeat_user") == 1, "all")
        .when(F.col("repeat_user") == 1, "repeat").otherwise("other")
    )
    return (
        profile.rollup("repeat_user")
        .agg(label.alias("user_class"), F.count("*").alias("users"),
             F.avg("avg_turns").alias("mean_turns"), quantile("avg_turns", 0.5).alias("median_turns"))
        .drop("repeat_user")
    )


def turn_decile_histogram(profile: DataFrame, exact: bool = False) -> DataFrame:
    """Decile-bin histogram of users' mean turns, bins cut per repeat class."""
    def of_class(flag):
        rows = profile.filter(F.col("repeat_user") == flag)
        return quantile_bin_histogram(rows, "avg_turns", 10, exact).withColumn(
            "repeat_user", F.lit(flag))
    return of_class(1).unionByName(of_class(0))


def user_time_gaps(conversations: DataFrame, user: str = "hashed_ip",
                   timestamp: str = "timestamp", more_than: int = 3) -> DataFrame:
    """Mean and median seconds between a user's consecutive conversations.

    ``repeat_user`` is 1 above ``more_than`` conversations. Gaps are NULL for users
    with fewer than two dated conversations.
    """
    dated = conversations.select(user, F.unix_timestamp(timestamp).alias("_at"))
    return (
        gap_statistics(dated, user, "_at", 0.5)
        .withColumnsRenamed({"rows": "conv_count", "mean_gap": "avg_time_gap",
                             "quantile_gap": "median_time_gap"})
        .withColumn("repeat_user", F.when(F.col("conv_count") > more_than, 1).otherwise(0))
    )


def time_gaps_by_class(gaps: DataFrame) -> DataFrame:
    """Per repeat class: mean of means, median of medians, mean of medians."""
    return gaps.groupBy("repeat_user").agg(
        F.avg("avg_time_gap").alias("mean_of_mean_gap"),
        quantile("median_time_gap", 0.5).alias("median_of_median_gap"),
        F.avg("median_time_gap").alias("mean_of_median_gap"))


def repeat_share_by_country(conversations: DataFrame, countries: int = 7, user: str = "hashed_ip",
                            timestamp: str = "timestamp", per_day: float = 2) -> DataFrame:
    """Conversations of repeat users in the largest countries, percent of the country.

    Everything is derived from one stored table of counts per (user, country), so the
    log is read once and the join with the user profile never meets a hot user's rows.
    """
    cells = settled(
        conversations.groupBy(user, "country")
        .agg(F.count("*").alias("n"), F.min(timestamp).alias("first"), F.max(timestamp).alias("last")))
    sizes = cells.groupBy("country").agg(F.sum("n").alias("count"))
    largest = top_rows(sizes, countries, ties=["country"])
    profile = _with_daily_rate(
        cells.filter(F.col(user).isNotNull()).groupBy(user)
        .agg(F.sum("n").alias("conv_count"), F.min("first").alias("earliest_date"),
             F.max("last").alias("latest_date")), per_day)
    classes = profile.select(user, "repeat_user")
    counts = (
        restrict_to(cells, largest, "country")
        .join(classes, user)
        .groupBy("country", "repeat_user")
        .agg(F.sum("n").alias("conversations"))
    )
    total = share_within(counts, "country", "conversations")
    return total.filter(F.col("repeat_user") == 1).drop("repeat_user")


def repeat_share_of_users(profile: DataFrame) -> DataFrame:
    """Percentage of users that are repeat users, one row."""
    n = F.sum("repeat_user")
    return profile.agg(F.count("*").alias("total_users"), n.alias("repeat_users"),
                       percent(n, F.count("*")).alias("percentage"))


def trimmed_repeat_users(conversations: DataFrame, per_day: float = 2,
                         probability: float = 0.9, user: str = "hashed_ip") -> DataFrame:
    """Repeat users below the given quantile of repeat users' conversations per day.

    The profile of the repeat users is stored, as the quantile and the result both
    need it.
    """
    repeat = settled(activity_profile(conversations, user, per_day=per_day).filter("repeat_user = 1"))
    cut = repeat.agg(quantile("avg_conv_per_day", probability)).scalar()
    return repeat.filter(F.col("avg_conv_per_day") < cut)


def conversations_of(conversations: DataFrame, users: DataFrame, user: str = "hashed_ip") -> DataFrame:
    """Conversations of the given users; a hot user is split by Spark's skew join."""
    return restrict_to(conversations, users, user)
