"""Flagged conversations and messages by time, model, category and country."""
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clock import in_hour_bands
from ..functions.labels import indicator, model_family, model_tag
from ..functions.moderation import (
    any_key, category_keys, first_flagged_index, is_harmful, key_groups, zipped_messages,
)
from ..operators.ranking import top_rows
from ..operators.shares import percent

# The five labels of the message table and their category fields.
MESSAGE_LABELS = {
    "harassment": "harassment",
    "hate": "hate",
    "self_harm": "self-harm",
    "sexual": "sexual",
    "violence": "violence",
}


def with_harm(conversations: DataFrame) -> DataFrame:
    """Add ``is_harmful`` and ``harmful_message_index``."""
    return (
        conversations.withColumn("is_harmful", is_harmful())
        .withColumn("harmful_message_index", first_flagged_index())
    )


def first_flag_distribution(conversations: DataFrame) -> DataFrame:
    """Harmful conversations by index of the first flagged message, in order."""
    return (
        with_harm(conversations).filter("is_harmful")
        .groupBy("harmful_message_index").count().orderBy("harmful_message_index")
    )


def turns_by_harm(conversations: DataFrame) -> DataFrame:
    """Mean, deviation and median of turns: harmful, other and all conversations.

    Conversations of unknown verdict are only in ``all``. The log is counted per verdict and
    turn once; the three groups, two of which share rows, are put together from the counts.
    The median is the lower one of an even number of rows.
    """
    counts = conversations.groupBy(is_harmful().alias("is_harmful"), "turn").agg(F.count("*").alias("n"))
    label = F.when(F.col("is_harmful"), "harmful").when(~F.col("is_harmful"), "other")
    groups = F.explode(F.array_compact(F.array(F.lit("all"), label))).alias("conversations")
    cells = counts.select(groups, F.col("turn").cast("double").alias("t"), "n").groupBy("conversations", "t").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy("conversations")
    known = F.when(F.col("t").isNotNull(), F.col("n"))
    mean = F.try_divide(F.sum(F.col("n") * F.col("t")).over(whole), F.sum(known).over(whole))
    upto = F.sum(known).over(whole.orderBy(F.col("t").asc_nulls_last()))
    cells = cells.select("conversations", "t", "n", mean.alias("mean"), upto.alias("upto"), F.sum(known).over(whole).alias("rows"))
    squares = F.sum(F.col("n") * F.pow(F.col("t") - F.col("mean"), 2))
    return cells.groupBy("conversations").agg(
        F.max("mean").alias("avg_turns"), F.sqrt(F.try_divide(squares, F.max("rows") - 1)).alias("std_turns"),
        F.min(F.when(F.col("upto") * 2 >= F.col("rows"), F.col("t"))).alias("median_turns"))


def _harm_counts(conversations: DataFrame, *keys) -> DataFrame:
    return conversations.groupBy(*keys).agg(
        F.count_if(is_harmful()).alias("num_harm"), F.count("*").alias("total"))


def harm_by_hour(local: DataFrame) -> DataFrame:
    """Harmful conversations per local hour: percent of the hour and of all harm.

    Hours without harm, and the unknown hour, are left out; the latter still counts
    in the total harm.
    """
    counts = _harm_counts(local, F.col("hour_bin_offseted").alias("hour_bin"))
    # At most 25 rows here: the hours and the unknown one.
    all_harm = F.sum("num_harm").over(Window.partitionBy())
    return (
        counts.withColumn("harm_percentage", percent(F.col("num_harm"), all_harm))
        .filter(F.col("hour_bin").isNotNull() & (F.col("num_harm") > 0))
        .withColumn("percentage", percent(F.col("num_harm"), F.col("total")))
        .orderBy("hour_bin")
    )


def harm_by_day_and_hour(local: DataFrame) -> DataFrame:
    """Harmful conversations per weekday and hour, percent of that hour's conversations."""
    counts = _harm_counts(local, "day_of_week", F.col("hour_bin_offseted").alias("hour_bin"))
    return (
        counts.filter(F.col("hour_bin").isNotNull() & (F.col("num_harm") > 0))
        .withColumn("percentage", percent(F.col("num_harm"), F.col("total")))
        .orderBy("day_of_week", "hour_bin")
    )


def harm_by_family(conversations: DataFrame) -> DataFrame:
    """Harmful conversations per model family, percent of the family."""
    return (
        _harm_counts(conversations, model_family().alias("model_family"))
        .filter(F.col("num_harm") > 0)
        .withColumn("percentage", percent(F.col("num_harm"), F.col("total")))
    )


def harm_overall(conversations: DataFrame) -> DataFrame:
    """Harmful conversations, percent of all, one row."""
    n = F.count_if(is_harmful())
    return conversations.agg(n.alias("num_harm"), F.count("*").alias("total"),
                             percent(n, F.count("*")).alias("percentage"))


def _some_verdict_has(fields: list[str]):
    return F.exists(F.col("openai_moderation.categories"), lambda c: any_key(c, fields))


def _quoted(names) -> list[str]:
    return [f"`{n}`" for n in names]


def categories_in_hours(local: DataFrame, bands=((20, 23), (0, 7)), canonical: bool = False) -> DataFrame:
    """Harmful conversations per category inside hour bands, percent of those harmful.

    A conversation counts once per category that any of its verdicts has. All
    categories are counted in one pass as columns and turned into rows at the end, so
    nothing is exploded or shuffled per category.
    """
    groups = key_groups(category_keys(local), canonical)
    harmful = local.filter(is_harmful() & in_hour_bands("hour_bin_offseted", bands))
    counts = harmful.agg(
        F.count("*").alias("_all"),
        *[F.count_if(_some_verdict_has(fields)).alias(name) for name, fields in groups.items()])
    return (
        counts.unpivot("_all", _quoted(groups), "harmful_flag", "count")
        .filter(F.col("count") > 0)
        .select("harmful_flag", "count", percent(F.col("count"), F.col("_all")).alias("percentage"))
        .orderBy(F.desc("count"), "harmful_flag")
    )


def _assistant_messages(conversations: DataFrame, *keep) -> DataFrame:
    """One row per assistant message with its verdict's flag and categories.

    Conversations without a moderation array contribute nothing.
    """
    message = F.explode(F.arrays_zip(
        F.col("conversation.role").alias("role"),
        F.col("openai_moderation.flagged").alias("flagged"),
        F.col("openai_moderation.categories").alias("categories")))
    return (
        conversations.select(*keep, message.alias("message"))
        .filter(F.col("message.role") == "assistant")
    )


def assistant_harm_by_model(conversations: DataFrame, by_family: bool = False) -> DataFrame:
    """Assistant messages and flagged ones per model or family, with the percentage.

    Models whose conversations have messages but none by the assistant appear with 0
    messages and a NULL percentage.
    """
    key = model_family().alias("model_family") if by_family else F.col("model")
    name = "model_family" if by_family else "model"
    message = F.explode(F.arrays_zip(
        F.col("conversation.role").alias("role"), F.col("openai_moderation.flagged").alias("flagged")))
    by_assistant = F.col("message.role") == "assistant"
    return (
        conversations.select(key, message.alias("message"))
        .groupBy(name)
        .agg(F.count_if(by_assistant).alias("total_model_messages"),
             F.count_if(by_assistant & F.col("message.flagged")).alias("harmful_model_messages"))
        .withColumn("harmful_percentage",
                    percent(F.col("harmful_model_messages"), F.col("total_model_messages")))
        .orderBy(F.desc("harmful_percentage"))
    )


def assistant_harm_overall(by_model: DataFrame) -> DataFrame:
    """Flagged assistant messages over all assistant messages, percent, one row."""
    return by_model.agg(percent(
        F.sum("harmful_model_messages"), F.sum("total_model_messages")).alias("percentage"))


def categories_by_family(conversations: DataFrame, canonical: bool = False) -> DataFrame:
    """Assistant messages per model family and category, percent of the family's messages."""
    groups = key_groups(category_keys(conversations), canonical)
    messages = _assistant_messages(conversations, model_family().alias("model_family"))
    counts = messages.groupBy("model_family").agg(
        F.count("*").alias("total"),
        *[F.count_if(any_key(F.col("message.categories"), fields)).alias(name)
          for name, fields in groups.items()])
    return (
        counts.unpivot(["model_family", "total"], _quoted(groups), "harmful_flag", "num_harm")
        .filter(F.col("num_harm") > 0)
        .withColumn("percentage", percent(F.col("num_harm"), F.col("total")))
        .orderBy("model_family", F.desc("percentage"), "harmful_flag")
    )


def message_table(conversations: DataFrame, language: str | None = "English", keep=()) -> DataFrame:
    """One row per message: model tag, country, content, toxic, redacted, five 0/1 labels."""
    if language is not None:
        conversations = conversations.filter(F.col("language") == language)
    rows = conversations.select(
        *keep, model_tag().alias("model_tag"), "country",
        F.posexplode(zipped_messages(conversations, ["content", "toxic", "redacted"]))
        .alias("position", "m"))
    labels = [
        indicator(F.col("m.categories").getField(field)).alias(name)
        for name, field in MESSAGE_LABELS.items()
    ]
    return rows.select(
        *keep, "model_tag", "country", "position", "m.content", "m.toxic", "m.redacted", *labels)


def _ratio_by_country(messages: DataFrame, flag: str, count: str, ratio: str, k: int) -> DataFrame:
    hits = F.count_if(F.col(flag))
    per_country = messages.groupBy("country").agg(
        F.when(hits > 0, hits).alias(count), F.count("*").alias("total_count"))
    return (
        top_rows(per_country, k, "total_count", ["country"])
        .withColumn(count, F.when(F.col("country").isNotNull(), F.col(count)))
        .withColumn(ratio, F.col(count) / F.col("total_count"))
        .orderBy(F.desc(ratio), "country")
    )


def toxic_ratio_by_country(messages: DataFrame, k: int = 10) -> DataFrame:
    """Toxic messages in the countries with most messages; NULL where there is none."""
    return _ratio_by_country(messages, "toxic", "toxic_count", "toxic_ratio", k)


def redacted_ratio_by_country(messages: DataFrame, k: int = 10) -> DataFrame:
    """Messages with personal data in the countries with most messages."""
    return _ratio_by_country(messages, "redacted", "pii_count", "pii_ratio", k)
