"""Registered queries on languages."""
from parlance.plans import languages as lg

from .adapters import CHATS, MESSAGES, VENDORS, chat_log, vendor_log
from .base import Check, big, normal_sql, r6, sum_big
from .devices import mann_whitney_sql

LANGUAGES = ["English", "French", "German", "Spanish"]


def top(spark, sf):
    return lg.top_languages(chat_log(spark, sf), vendor_log(spark, sf), 3)


def by_tag(spark, sf):
    return lg.top_languages_by_tag(chat_log(spark, sf), 3).select("model_tag", "language", "count", big("rank"))


def by_tag_wide(spark, sf):
    top3 = lg.top_languages_by_tag(chat_log(spark, sf), 3)
    return lg.languages_by_tag_wide(top3, LANGUAGES)


def countries(spark, sf):
    return lg.top_countries(chat_log(spark, sf), 20)


def by_country(spark, sf):
    chats = chat_log(spark, sf)
    return lg.top_languages_by_country(chats, 20, 2, ["English", "French"]).select(
        "country", "language", "count", big("rank"))


def by_country_wide(spark, sf):
    chats = chat_log(spark, sf)
    named = ["English", "French"]
    top2 = lg.top_languages_by_country(chats, ["NATION_1", "NATION_2", "NATION_3"], 2, named)
    return lg.languages_by_country_wide(top2, named)


def switches(spark, sf):
    return lg.switch_table(chat_log(spark, sf))


def rates(spark, sf):
    return lg.switch_rates(switches(spark, sf)).select(
        "model_tag", "language_switches", "total_turns", r6("switch_rate"))


def totals(spark, sf):
    return lg.switch_totals(lg.switch_rates(switches(spark, sf))).select(
        "total_language_switches", "total_turns", r6("total_switch_rate"))


def sources(spark, sf):
    return lg.switch_sources(switches(spark, sf), 2).select("model_tag", "prev_language", "count", big("rank"))


def test(spark, sf):
    return lg.switch_test(switches(spark, sf)).select(
        "n1", "n2", r6("u"), r6("z"), r6("effect_size"), "interpretation")


def test_p(spark, sf):
    return lg.switch_test(switches(spark, sf)).select(r6("p_value"))


def normality(spark, sf):
    return lg.switch_normality(switches(spark, sf), "gpt-4").select("n", r6("mean"), r6("std"))


def normality_distance(spark, sf):
    return lg.switch_normality(switches(spark, sf), "gpt-4").select(r6("statistic"), r6("p_value"))


_SWITCH = f"""WITH {MESSAGES}, s AS (
  SELECT model_tag, role, turn_identifier,
    lag(spoken) OVER w AS prev_language, CASE WHEN role <> lag(role) OVER w AND spoken <> lag(spoken) OVER w
      THEN 1 ELSE 0 END AS sw
  FROM msgs WHERE role <> 'system'
  WINDOW w AS (PARTITION BY turn_identifier ORDER BY CASE WHEN role = 'user' THEN 1 ELSE 2 END, pos)), replies AS (
  SELECT * FROM s WHERE role = 'assistant')"""
_TOP = """SELECT {keys}, count(*) AS count, CAST(row_number() OVER (PARTITION BY {group} ORDER BY count(*) DESC, {tie}) AS BIGINT) AS rank
FROM {src} GROUP BY {keys} QUALIFY rank <= {k}"""

_WIDE = ", ".join(f"any_value(count) FILTER (language = '{x}') AS \"{x}\"" for x in LANGUAGES)

CHECKS = {
    "top_languages": Check(top, f"""
WITH {CHATS}, {VENDORS} SELECT language, count(*) AS count FROM
  (SELECT language FROM chats UNION ALL SELECT language FROM vendors) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3"""),
    "top_languages_by_tag": Check(by_tag, f"""
WITH {CHATS} {_TOP.format(keys='model_tag, language', group='model_tag', tie='language', src='families', k=3)}"""),
    "top_languages_by_tag_wide": Check(by_tag_wide, f"""
WITH {CHATS}, t AS ({_TOP.format(keys='model_tag, language', group='model_tag', tie='language', src='families', k=3)})
SELECT model_tag, {_WIDE} FROM t GROUP BY 1"""),
    "top_countries": Check(countries, f"""
WITH {CHATS} SELECT country, count(*) AS count FROM chats GROUP BY 1 ORDER BY 2 DESC, 1 NULLS FIRST LIMIT 20"""),
    "top_languages_by_country": Check(by_country, f"""
WITH {CHATS}, big AS (SELECT country FROM chats GROUP BY 1 ORDER BY count(*) DESC, 1 NULLS FIRST LIMIT 20), m AS (
  SELECT country, CASE WHEN language IN ('English', 'French') THEN language ELSE 'others' END AS language FROM chats
  WHERE country IN (SELECT country FROM big))
{_TOP.format(keys='country, language', group='country', tie='language', src='m', k=2)}"""),
    "top_languages_by_country_wide": Check(by_country_wide, f"""
WITH {CHATS}, m AS (
  SELECT country, CASE WHEN language IN ('English', 'French') THEN language ELSE 'others' END AS language FROM chats
  WHERE country IN ('NATION_1', 'NATION_2', 'NATION_3')), t AS (
{_TOP.format(keys='country, language', group='country', tie='language', src='m', k=2)})
SELECT country, any_value(count) FILTER (language = 'English') AS "English",
  any_value(count) FILTER (language = 'French') AS "French", any_value(count) FILTER (language = 'others') AS others
FROM t GROUP BY 1"""),
    "switch_rates": Check(rates, f"""{_SWITCH}
SELECT model_tag, {sum_big('sw')} AS language_switches, count(*) AS total_turns,
  round(CAST(sum(sw) AS DOUBLE) / count(*), 6) AS switch_rate FROM replies GROUP BY 1"""),
    "switch_totals": Check(totals, f"""{_SWITCH}
SELECT {sum_big('sw')} AS total_language_switches, count(*) AS total_turns,
  round(CAST(sum(sw) AS DOUBLE) / count(*), 6) AS total_switch_rate FROM replies"""),
    "switch_sources": Check(sources, f"""{_SWITCH}, hits AS (SELECT * FROM replies WHERE sw = 1)
{_TOP.format(keys='model_tag, prev_language', group='model_tag', tie='prev_language', src='hits', k=2)}"""),
    "switch_test": Check(test, f"""{_SWITCH}, v AS (
  SELECT sw AS value, count(*) FILTER (model_tag = 'gpt-3.5') AS n1, count(*) FILTER (model_tag = 'gpt-4') AS n2
  FROM replies WHERE model_tag IN ('gpt-3.5', 'gpt-4') GROUP BY sw), {mann_whitney_sql('v')}"""),
    "switch_test_p_value": Check(test_p, f"""{_SWITCH}, v AS (
  SELECT sw AS value, count(*) FILTER (model_tag = 'gpt-3.5') AS n1, count(*) FILTER (model_tag = 'gpt-4') AS n2
  FROM replies WHERE model_tag IN ('gpt-3.5', 'gpt-4') GROUP BY sw), {mann_whitney_sql('v', True)}"""),
    "switch_normality": Check(normality, f"""{_SWITCH}
SELECT count(*) AS n, round(avg(sw), 6) AS mean, round(stddev_samp(sw), 6) AS std FROM replies WHERE model_tag = 'gpt-4'"""),
    # With n d^2 above 10 the p-value is 0 to six digits; otherwise this has no value and differs.
    "switch_normality_distance": Check(normality_distance, f"""{_SWITCH}, g AS (
  SELECT count(*) AS n, avg(sw) AS m, stddev_samp(sw) AS s FROM replies WHERE model_tag = 'gpt-4'), c AS (
  SELECT sw, count(*) AS k, sum(count(*)) OVER (ORDER BY sw) AS upto FROM replies WHERE model_tag = 'gpt-4' GROUP BY sw), d AS (
  SELECT n, upto / n AS high, (upto - k) / n AS low, (sw - m) / s AS z FROM c, g), e AS (
  SELECT n, max(greatest(high - {normal_sql('z')}, {normal_sql('z')} - low)) AS d FROM d GROUP BY n)
SELECT round(d, 6) AS statistic, CASE WHEN n * d * d > 10 THEN CAST(0 AS DOUBLE) END AS p_value FROM e"""),
}
