"""Turns, duration and message length.

Two shapes of input: nested (one row per conversation with a message array) and flat
(one row per message). Nested inputs are worked on inside the array, without a
shuffle per message.
"""
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions._columns import fields_of
from ..operators.distributions import equal_width_histogram
from ..operators.ordering import expand_ranges, ordinal_within


def duplicate_ids(conversations: DataFrame, identifier: str) -> DataFrame:
    """Identifiers that occur more than once, with their counts."""
    return conversations.groupBy(identifier).count().filter(F.col("count") > 1)


def conversations_longer_than(conversations: DataFrame, messages: int = 2) -> DataFrame:
    """Conversations with more than the given number of messages."""
    return conversations.filter(F.size("conversation.role") > messages)


def turns_per_conversation(conversations: DataFrame,
                           identifier: str = "conversation_identifier",
                           turn: str = "turn") -> DataFrame:
    """Largest turn number of each conversation, ``num_turns``."""
    return conversations.groupBy(identifier).agg(F.max(turn).alias("num_turns"))


def largest_turn(conversations: DataFrame) -> DataFrame:
    """Largest turn number of all conversations, one row."""
    return conversations.agg(F.max("turn").alias("max_turn"))


def turn_histogram(spark: SparkSession, turns: DataFrame, bins: int = 30) -> DataFrame:
    """Equal-width histogram of ``num_turns``."""
    return equal_width_histogram(spark, turns, "num_turns", bins)


def conversation_spans(conversations: DataFrame,
                       identifier: str = "conversation_identifier") -> DataFrame:
    """First and last message time, ``duration`` in seconds and message count.

    Strings that are not timestamps count as missing. The duration is NULL when no
    message of the conversation has a time.
    """
    times = F.col("conversation.timestamp")
    if conversations.select(times).schema[0].dataType.simpleString() == "array<string>":
        times = F.transform(times, lambda t: F.try_to_timestamp(t))
    per_row = conversations.select(
        identifier, F.array_min(times).alias("_start"), F.array_max(times).alias("_end"),
        F.greatest(F.size("conversation.timestamp"), F.lit(0)).alias("_messages"))
    return (
        per_row.groupBy(identifier)
        .agg(F.min("_start").alias("start_time"), F.max("_end").alias("end_time"),
             F.sum("_messages").alias("messages"))
        .filter(F.col("messages") > 0)
        .withColumn("duration", F.unix_timestamp("end_time") - F.unix_timestamp("start_time"))
    )


def conversation_durations(spans: DataFrame,
                           identifier: str = "conversation_identifier") -> DataFrame:
    """Conversations whose duration is known."""
    return spans.filter(F.col("duration").isNotNull()).select(identifier, "duration")


def missing_duration_share(spans: DataFrame) -> DataFrame:
    """Share of messages that belong to conversations of unknown duration, one row."""
    missing = F.sum(F.when(F.col("duration").isNull(), F.col("messages")).otherwise(0))
    return spans.agg(F.try_divide(missing, F.sum("messages")).alias("proportion"))


def _lengths_by_role(conversations: DataFrame, role: str, keep: list[str]) -> DataFrame:
    """One row per message of a role: turn_number within the role, content_length."""
    lengths = F.transform(
        F.filter(fields_of("conversation", "role", "content"), lambda m: m["role"] == role),
        lambda m: F.length(m["content"]))
    return (
        conversations.select(*keep, F.posexplode(lengths).alias("_at", "content_length"))
        .withColumn("turn_number", F.col("_at") + 1).drop("_at")
    )


def _up_to(rows: DataFrame, last_turn: int | None) -> DataFrame:
    """Rows up to a turn number; all rows if it is None."""
    return rows if last_turn is None else rows.filter(F.col("turn_number") <= last_turn)


def user_length_by_turn(conversations: DataFrame, last_turn: int | None = None) -> DataFrame:
    """Mean user-message length by the message's number among the user's messages."""
    return (
        _up_to(_lengths_by_role(conversations, "user", []), last_turn)
        .groupBy("turn_number").agg(F.avg("content_length").alias("avg_content_length"))
    )


def assistant_length_by_turn(conversations: DataFrame, last_turn: int | None = None) -> DataFrame:
    """Mean assistant-message length by number among the replies, and model."""
    return (
        _up_to(_lengths_by_role(conversations, "assistant", ["model"]), last_turn)
        .groupBy("turn_number", "model").agg(F.avg("content_length").alias("avg_content_length"))
    )


def assistant_length_by_position(conversations: DataFrame, last_turn: int | None = None) -> DataFrame:
    """Mean assistant-message length by position among all messages (from 0), and model."""
    messages = F.posexplode(fields_of("conversation", "role", "content"))
    return (
        _up_to(conversations.select("model", messages.alias("turn_number", "m")), last_turn)
        .filter(F.col("m.role") == "assistant")
        .groupBy("turn_number", "model")
        .agg(F.avg(F.length("m.content")).alias("avg_content_length"))
    )


def model_count(conversations: DataFrame) -> DataFrame:
    """Number of different models, one row."""
    return conversations.agg(F.count_distinct("model").alias("models"))


def length_by_turn_flat(messages: DataFrame, role: str, key: str, position: str,
                        content: str, by: list[str] = (), last_turn: int | None = None) -> DataFrame:
    """``user_length_by_turn`` / ``assistant_length_by_turn`` for a flat message table.

    The numbering is safe for a conversation that holds a large part of all messages.
    """
    spoken = (
        messages.filter(F.col("role") == role)
        .select(key, position, *by, F.length(content).alias("content_length"))
    )
    return (
        _up_to(ordinal_within(spoken, key, position, "turn_number"), last_turn)
        .groupBy("turn_number", *by).agg(F.avg("content_length").alias("avg_content_length"))
    )


def toxicity_by_turn_index(conversations: DataFrame, identifier: str = "conversation_hash",
                           turn: str = "turn") -> DataFrame:
    """Mean toxicity of the first message by the row's number among rows of its id.

    Rows of one id are numbered by turn; equal turns, for which no order is given, by
    score. Copies (same id, turn and score) are counted first and take a range of
    numbers together, so an id with very many copies is still one row. Scores are ordered
    inside a turn, and a second window carries the numbers on over one row per turn, so
    the rows of one id are not sorted in one place.
    """
    score = F.get("detoxify_moderation.toxicity", F.lit(0))
    copies = (
        conversations.select(identifier, F.col(turn).alias("_turn"), score.alias("_score"))
        .groupBy(identifier, "_turn", "_score").agg(F.count("*").alias("_n"))
    )
    earlier = (Window.unboundedPreceding, -1)
    inside = Window.partitionBy(identifier, "_turn").orderBy("_score").rowsBetween(*earlier)
    before = Window.partitionBy("_id").orderBy("_t").rowsBetween(*earlier)
    turns = copies.groupBy(F.col(identifier).alias("_id"), F.col("_turn").alias("_t")).agg(F.sum("_n").alias("_sum"))
    starts = turns.select("_id", "_t", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_turn_start"))
    numbered = (
        copies.withColumn("_within", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
        .join(starts, F.col(identifier).eqNullSafe(F.col("_id")) & F.col("_turn").eqNullSafe(F.col("_t")))
        .withColumn("_start", F.col("_turn_start") + F.col("_within"))
    )
    single = numbered.filter(F.col("_n") == 1).select(
        (F.col("_start") + 1).alias("turn_index"), "_score")
    repeated = expand_ranges(
        numbered.filter(F.col("_n") > 1).select("_start", "_n", "_score"),
        "_start", "_n", "turn_index").select("turn_index", "_score")
    return (
        single.union(repeated)
        .groupBy("turn_index").agg(F.avg("_score").alias("avg_toxicity"))
        .orderBy("turn_index")
    )


def toxicity_by_position(conversations: DataFrame) -> DataFrame:
    """Mean toxicity by position of the message in its conversation, from 1."""
    return (
        conversations
        .select(F.posexplode("detoxify_moderation.toxicity").alias("_at", "_score"))
        .groupBy((F.col("_at") + 1).alias("turn_index"))
        .agg(F.avg("_score").alias("avg_toxicity"))
        .orderBy("turn_index")
    )
