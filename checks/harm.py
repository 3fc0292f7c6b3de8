"""Registered queries on moderation."""
from parlance.functions.moderation import category_keys, true_keys, true_keys_of_all
from parlance.plans import harm as hm
from parlance.plans.localtime import with_local_time
from pyspark.sql import functions as F

from .adapters import (
    CATEGORY_COLUMNS, HARM, MESSAGES, VENDORS, chat_log, local_sql, locations, vendor_log,
)
from .base import Check, big, r6

LOCAL = f"{HARM}, {local_sql('harm')}"


def local(spark, sf):
    return with_local_time(chat_log(spark, sf), locations(spark, sf))


def flags(spark, sf):
    return hm.with_harm(chat_log(spark, sf)).select(
        "conversation_hash", "is_harmful", F.coalesce(big("harmful_message_index"), F.lit(-1)).alias("harmful_message_index"))


def first_flags(spark, sf):
    return hm.first_flag_distribution(chat_log(spark, sf)).select(big("harmful_message_index"), "count")


def turns(spark, sf):
    return hm.turns_by_harm(chat_log(spark, sf)).select(
        "conversations", r6("avg_turns"), r6("std_turns"), big("median_turns"))


def by_hour(spark, sf):
    return hm.harm_by_hour(local(spark, sf)).select(
        big("hour_bin"), "num_harm", "total", r6("percentage"), r6("harm_percentage"))


def by_day(spark, sf):
    return hm.harm_by_day_and_hour(local(spark, sf)).select(
        big("day_of_week"), big("hour_bin"), "num_harm", "total", r6("percentage"))


def categories_in_hours(canonical):
    def run(spark, sf):
        return hm.categories_in_hours(local(spark, sf), canonical=canonical).select(
            "harmful_flag", "count", r6("percentage"))
    return run


def by_family(spark, sf):
    return hm.harm_by_family(chat_log(spark, sf)).select("model_family", "num_harm", "total", r6("percentage"))


def overall(spark, sf):
    return hm.harm_overall(chat_log(spark, sf)).select("num_harm", "total", r6("percentage"))


def assistant_family(spark, sf):
    return hm.assistant_harm_by_model(chat_log(spark, sf), by_family=True).select(
        "model_family", "total_model_messages", "harmful_model_messages", r6("harmful_percentage"))


def assistant_model(spark, sf):
    return hm.assistant_harm_by_model(vendor_log(spark, sf)).select(
        "model", "total_model_messages", "harmful_model_messages", r6("harmful_percentage"))


def assistant_overall(spark, sf):
    return hm.assistant_harm_overall(hm.assistant_harm_by_model(vendor_log(spark, sf))).select(r6("percentage"))


def categories_family(canonical):
    def run(spark, sf):
        return hm.categories_by_family(chat_log(spark, sf), canonical).select(
            "model_family", "harmful_flag", "num_harm", "total", r6("percentage"))
    return run


def flag_lists(spark, sf):
    chats = chat_log(spark, sf)
    keys = category_keys(chats)
    return chats.select(
        "conversation_hash",
        F.concat_ws(",", F.array_sort(true_keys_of_all("openai_moderation", keys))).alias("harmful_flags"),
        F.concat_ws(",", F.array_sort(true_keys(F.get("openai_moderation.categories", F.lit(0)), keys))).alias("first_flags"))


def messages(spark, sf):
    table = hm.message_table(chat_log(spark, sf), keep=["conversation_hash"])
    return table.select(
        "conversation_hash", big("position"), "model_tag", "country", F.length("content").cast("long").alias("length"),
        "toxic", "redacted", *[big(c) for c in hm.MESSAGE_LABELS])


def toxic_countries(spark, sf):
    return hm.toxic_ratio_by_country(hm.message_table(chat_log(spark, sf))).select(
        "country", "toxic_count", "total_count", r6("toxic_ratio"))


def redacted_countries(spark, sf):
    return hm.redacted_ratio_by_country(hm.message_table(chat_log(spark, sf), language=None)).select(
        "country", "pii_count", "total_count", r6("pii_ratio"))


_CANONICAL: dict[str, list[str]] = {}
for _key, _column in CATEGORY_COLUMNS.items():
    _CANONICAL.setdefault(_key.replace("/", "_").replace("-", "_"), []).append(_column)
_RAW = {k: [c] for k, c in CATEGORY_COLUMNS.items()}


def _each(groups, template: str) -> str:
    return " UNION ALL ".join(
        template.format(key=key, hit="(" + " OR ".join(f"COALESCE({c}, false)" for c in columns) + ")")
        for key, columns in groups.items())


def _in_hours(groups):
    return f"""WITH {LOCAL}, band AS (SELECT * FROM local WHERE is_harmful AND (h BETWEEN 20 AND 23 OR h BETWEEN 0 AND 7)),
n AS (SELECT count(*) AS total FROM band), f AS (
  {_each(groups, "SELECT '{key}' AS harmful_flag, count(*) FILTER ({hit}) AS count FROM band")})
SELECT harmful_flag, count, round(count * 100.0 / total, 6) AS percentage FROM f, n WHERE count > 0"""


def _by_family(groups):
    return f"""WITH {MESSAGES}, a AS (SELECT * FROM verdicts WHERE role = 'assistant' AND moderated), f AS (
  {_each(groups, "SELECT model_family, '{key}' AS harmful_flag, count(*) FILTER ({hit}) AS num_harm, count(*) AS total FROM a GROUP BY model_family")})
SELECT *, round(num_harm * 100.0 / total, 6) AS percentage FROM f WHERE num_harm > 0"""


_ASSISTANT = """count(*) FILTER (role = 'assistant') AS total_model_messages,
  count(*) FILTER (role = 'assistant' AND flagged) AS harmful_model_messages,
  round(count(*) FILTER (role = 'assistant' AND flagged) * 100.0
    / NULLIF(count(*) FILTER (role = 'assistant'), 0), 6) AS harmful_percentage"""
_LIST = ", ".join(f"CASE WHEN {c} THEN '{k}' END" for k, c in CATEGORY_COLUMNS.items())
_COUNTRY = """SELECT country, CASE WHEN country IS NOT NULL THEN NULLIF(count(*) FILTER ({flag}), 0) END AS {count},
  count(*) AS total_count,
  round(CASE WHEN country IS NOT NULL THEN CAST(NULLIF(count(*) FILTER ({flag}), 0) AS DOUBLE) END / count(*), 6) AS {ratio}
FROM msgs {where} GROUP BY country ORDER BY count(*) DESC, country NULLS FIRST LIMIT 10"""

CHECKS = {
    "harm_flags": Check(flags, f"""
WITH {HARM} SELECT conversation_hash, is_harmful,
  COALESCE(CASE WHEN is_harmful THEN CAST(first_index AS BIGINT) END, -1) AS harmful_message_index FROM harm"""),
    "first_flag_distribution": Check(first_flags, f"""
WITH {HARM} SELECT CAST(first_index AS BIGINT) AS harmful_message_index, count(*) AS count FROM harm
WHERE is_harmful GROUP BY 1"""),
    "turns_by_harm": Check(turns, f"""
WITH {HARM}, c AS (
  SELECT CASE WHEN is_harmful THEN 'harmful' ELSE 'other' END AS conversations, turn FROM harm WHERE is_harmful IS NOT NULL
  UNION ALL SELECT 'all', turn FROM harm)
SELECT conversations, round(avg(turn), 6) AS avg_turns, round(stddev_samp(turn), 6) AS std_turns,
  quantile_disc(turn, 0.5) AS median_turns FROM c GROUP BY 1"""),
    "harm_by_hour": Check(by_hour, f"""
WITH {LOCAL} SELECT h AS hour_bin, count(*) FILTER (is_harmful) AS num_harm, count(*) AS total,
  round(count(*) FILTER (is_harmful) * 100.0 / count(*), 6) AS percentage,
  round(count(*) FILTER (is_harmful) * 100.0 / (SELECT count(*) FROM local WHERE is_harmful), 6) AS harm_percentage
FROM local WHERE h IS NOT NULL GROUP BY h HAVING count(*) FILTER (is_harmful) > 0"""),
    "harm_by_day_and_hour": Check(by_day, f"""
WITH {LOCAL} SELECT d AS day_of_week, h AS hour_bin, count(*) FILTER (is_harmful) AS num_harm, count(*) AS total,
  round(count(*) FILTER (is_harmful) * 100.0 / count(*), 6) AS percentage
FROM local WHERE h IS NOT NULL GROUP BY d, h HAVING count(*) FILTER (is_harmful) > 0"""),
    "harm_categories_in_hours": Check(categories_in_hours(False), _in_hours(_RAW)),
    "harm_categories_in_hours_canonical": Check(categories_in_hours(True), _in_hours(_CANONICAL)),
    "harm_by_family": Check(by_family, f"""
WITH {HARM} SELECT model_family, count(*) FILTER (is_harmful) AS num_harm, count(*) AS total,
  round(count(*) FILTER (is_harmful) * 100.0 / count(*), 6) AS percentage
FROM harm GROUP BY 1 HAVING count(*) FILTER (is_harmful) > 0"""),
    "harm_overall": Check(overall, f"""
WITH {HARM} SELECT count(*) FILTER (is_harmful) AS num_harm, count(*) AS total,
  round(count(*) FILTER (is_harmful) * 100.0 / count(*), 6) AS percentage FROM harm"""),
    "assistant_harm_by_family": Check(assistant_family, f"""
WITH {MESSAGES} SELECT model_family, {_ASSISTANT} FROM verdicts WHERE moderated GROUP BY 1"""),
    "assistant_harm_by_model": Check(assistant_model, f"""
WITH {VENDORS} SELECT model, {_ASSISTANT} FROM vendor_msgs GROUP BY 1"""),
    "assistant_harm_overall": Check(assistant_overall, f"""
WITH {VENDORS} SELECT round(count(*) FILTER (flagged) * 100.0 / count(*), 6) AS percentage
FROM vendor_msgs WHERE role = 'assistant'"""),
    "harm_categories_by_family": Check(categories_family(False), _by_family(_RAW)),
    "harm_categories_by_family_canonical": Check(categories_family(True), _by_family(_CANONICAL)),
    "harm_flag_lists": Check(flag_lists, f"""
WITH {HARM}, firsts AS (
  SELECT doc_id, array_to_string(list_sort(list_filter([{_LIST}], lambda k: k IS NOT NULL)), ',') AS first_flags
  FROM verdicts WHERE pos = 0)
SELECT conversation_hash,
  array_to_string(list_sort(list_filter([{_LIST}], lambda k: k IS NOT NULL)), ',') AS harmful_flags, first_flags
FROM harm JOIN firsts USING (doc_id)"""),
    "message_table": Check(messages, f"""
WITH {MESSAGES} SELECT conversation_hash, CAST(pos AS BIGINT) AS position, model_tag, country,
  CAST(length(line) AS BIGINT) AS length, rude AS toxic, redacted,
  {', '.join(f"CAST(COALESCE({CATEGORY_COLUMNS[field]}, false) AS BIGINT) AS {name}" for name, field in hm.MESSAGE_LABELS.items())}
FROM verdicts WHERE language = 'English'"""),
    "toxic_ratio_by_country": Check(toxic_countries, f"""
WITH {MESSAGES} {_COUNTRY.format(flag='rude', count='toxic_count', ratio='toxic_ratio', where="WHERE language = 'English'")}"""),
    "redacted_ratio_by_country": Check(redacted_countries, f"""
WITH {MESSAGES} {_COUNTRY.format(flag='redacted', count='pii_count', ratio='pii_ratio', where='')}"""),
}
