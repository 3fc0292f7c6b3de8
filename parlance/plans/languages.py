"""Languages by corpus, model and country, and switches between question and answer."""
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions._columns import fields_of
from ..functions.labels import kept_or_others, model_tag
from ..operators.inference import ks_against_fitted_normal, mann_whitney
from ..operators.lineage import settled
from ..operators.ranking import pivot_counts, restrict_to, top_rows, top_rows_per_group

# Languages shown by name in the country table.
NAMED_LANGUAGES = [
    "English", "Chinese", "Russian", "French", "Spanish", "German", "Dutch", "Japanese",
    "Portuguese",
]


def top_languages(first: DataFrame, second: DataFrame, k: int = 5) -> DataFrame:
    """The most frequent conversation languages of two corpora together."""
    both = first.select("language").unionByName(second.select("language"))
    return top_rows(both.groupBy("language").count(), k, ties=["language"])


def top_languages_by_tag(conversations: DataFrame, k: int = 5) -> DataFrame:
    """The k most frequent languages per model tag."""
    counts = conversations.groupBy(model_tag().alias("model_tag"), "language").count()
    return top_rows_per_group(counts, "model_tag", k, ties=["language"])


def languages_by_tag_wide(top: DataFrame, languages: list[str]) -> DataFrame:
    """The same with one column per language."""
    return pivot_counts(top, "model_tag", "language", languages)


def top_countries(conversations: DataFrame, k: int = 20) -> DataFrame:
    """The countries with most conversations."""
    return top_rows(conversations.groupBy("country").count(), k, ties=["country"])


def top_languages_by_country(conversations: DataFrame, countries: DataFrame | list[str] | int, k: int = 5,
                             named: list[str] = tuple(NAMED_LANGUAGES)) -> DataFrame:
    """The k most frequent languages of the given countries, unnamed ones as others.

    A number stands for that many countries with most conversations. These are found in the
    counts per country and language, so the log is read once.
    """
    language = kept_or_others("language", list(named)).alias("language")
    counts = conversations.groupBy("country", language).count()
    if isinstance(countries, int):
        counts = settled(counts)
        totals = counts.groupBy("country").agg(F.sum("count").alias("count"))
        countries = top_rows(totals, countries, ties=["country"])
    if isinstance(countries, DataFrame):
        counts = restrict_to(counts, countries, "country")
    else:
        counts = counts.filter(F.col("country").isin(countries))
    return top_rows_per_group(counts, "country", k, ties=["language"])


def languages_by_country_wide(top: DataFrame, named: list[str] = tuple(NAMED_LANGUAGES)) -> DataFrame:
    """The same with one column per language."""
    return pivot_counts(top, "country", "language", [*named, "others"])


def message_languages(conversations: DataFrame, keep=()) -> DataFrame:
    """One row per message: model tag, turn identifier, position, role, language."""
    return conversations.select(
        *keep, model_tag().alias("model_tag"),
        F.posexplode(fields_of("conversation", "turn_identifier", "role", "language"))
        .alias("position", "m"),
    ).select(
        *keep, "model_tag", "position", "m.turn_identifier", "m.role", "m.language")


def _in_turn_order() -> Column:
    """User and assistant messages of a conversation by turn, user before reply, position."""
    messages = F.transform(fields_of("conversation", "turn_identifier", "role", "language"), lambda m, i: F.struct(
        m["turn_identifier"].alias("turn"), (m["role"] == "assistant").alias("reply"), i.alias("position"),
        m["language"].alias("language"), m["role"].alias("role")))
    return F.array_sort(F.filter(messages, lambda m: m["role"].isin("user", "assistant")))


def turn_switches(conversations: DataFrame, keep=()) -> DataFrame:
    """One row per assistant message: turn identifier, user's language, own language, switch 0/1.

    A turn identifier names a turn of its conversation; NULL is one turn. Nothing moves
    between rows: with the messages of a conversation in order of turn, user before reply,
    the only message that can follow another role is the first reply of a turn, and what it
    follows is the turn's last user message. So each message looks at the one before it,
    and replies after the first of a turn never switch.
    """
    def judged(m, i):
        before = F.get("_spoken", i - 1)
        asked = F.when(before["turn"].eqNullSafe(m["turn"]) & ~before["reply"], before["language"])
        return F.struct(
            m["turn"].alias("turn"), asked.alias("prev_language"), m["language"].alias("language"),
            F.when(asked != m["language"], 1).otherwise(0).alias("language_switch"), m["reply"].alias("reply"))

    # The ordered messages are a column of their own, so that they are put in order once.
    spoken = conversations.select(*keep, model_tag().alias("model_tag"), _in_turn_order().alias("_spoken"))
    replies = F.filter(F.transform("_spoken", judged), lambda r: r["reply"])
    return spoken.select(*keep, "model_tag", F.explode(replies).alias("r")).select(
        *keep, "model_tag", F.col("r.turn").alias("turn_identifier"), "r.prev_language", "r.language", "r.language_switch")


def switch_table(conversations: DataFrame) -> DataFrame:
    """Replies and turns per model tag, user's language and switch 0/1; the log is read once.

    The small table that all questions on switches are answered from. ``replies`` counts
    assistant messages, ``turns`` those with a turn identifier.
    """
    return turn_switches(conversations).groupBy("model_tag", "prev_language", "language_switch").agg(
        F.count("*").alias("replies"), F.count("turn_identifier").alias("turns"))


def switch_rates(switches: DataFrame) -> DataFrame:
    """Language switches, replies and their ratio per model tag, from the switch table."""
    return (
        switches.groupBy("model_tag")
        .agg(F.sum(F.col("language_switch") * F.col("replies")).alias("language_switches"), F.sum("turns").alias("total_turns"))
        .withColumn("switch_rate", F.try_divide(F.col("language_switches"), F.col("total_turns")))
    )


def switch_totals(rates: DataFrame) -> DataFrame:
    """Switches, replies and ratio over all model tags, one row."""
    return rates.agg(
        F.sum("language_switches").alias("total_language_switches"),
        F.sum("total_turns").alias("total_turns"),
        F.try_divide(F.sum("language_switches"), F.sum("total_turns")).alias("total_switch_rate"))


def switch_sources(switches: DataFrame, k: int = 5) -> DataFrame:
    """User languages that most often lead to a switch, per model tag, from the switch table."""
    counts = switches.filter(F.col("language_switch") == 1).select("model_tag", "prev_language", F.col("replies").alias("count"))
    return top_rows_per_group(counts, "model_tag", k, ties=["prev_language"])


def switch_counts(switches: DataFrame) -> DataFrame:
    """Assistant messages per model tag and switch indicator, ``weight``."""
    return switches.groupBy("model_tag", "language_switch").agg(F.sum("replies").alias("weight"))


def switch_test(switches: DataFrame, first: str = "gpt-3.5", second: str = "gpt-4") -> DataFrame:
    """Mann-Whitney test of the switch indicator between two model tags."""
    return mann_whitney(
        switch_counts(switches), "language_switch", "model_tag", first, second, weight="weight")


def switch_normality(switches: DataFrame, tag: str) -> DataFrame:
    """Kolmogorov-Smirnov distance of one tag's switch indicator to a fitted normal."""
    of_tag = switch_counts(switches).filter(F.col("model_tag") == tag)
    return ks_against_fitted_normal(of_tag, "language_switch", weight="weight")
