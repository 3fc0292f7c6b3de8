"""Registered queries on devices."""
from parlance.plans import devices as dv

from .adapters import CHATS, CONTINENTS, MESSAGES, USAGE, chat_log, continents, usage_log
from .base import big, Check, normal_sql, r6


def used(spark, sf):
    return dv.with_device(usage_log(spark, sf))


def chats(spark, sf):
    return dv.with_device(chat_log(spark, sf))


def counts(spark, sf):
    return dv.device_counts(used(spark, sf))


def counts_with_unknown(spark, sf):
    return dv.device_counts(dv.with_device(usage_log(spark, sf), separate_unknown=True))


def by_country(spark, sf):
    return dv.devices_by_country(used(spark, sf)).select(
        "country", big("mobile"), big("desktop"), big("total_devices"), r6("mobile_percentage"), r6("desktop_percentage"))


def large(spark, sf):
    return dv.large_countries(dv.devices_by_country(used(spark, sf)), 350).select("country", big("total_devices"))


def by_continent(spark, sf):
    return dv.devices_by_continent(used(spark, sf), continents(spark, sf)).select(
        "continent", big("total_mobile"), big("total_desktop"), big("total_devices"),
        r6("mobile_percentage"), r6("desktop_percentage"))


def toxic(spark, sf):
    return dv.toxic_rate_by_device(chats(spark, sf)).select("device_type", r6("avg_toxicity"))


def messages(spark, sf):
    return dv.messages_by_device(chats(spark, sf)).select("device_type", r6("avg_messages"))


def length(spark, sf):
    return dv.message_length_by_device(chats(spark, sf)).select("device_type", r6("avg_message_length"))


def row_percentages(spark, sf):
    return dv.with_device_percentages(used(spark, sf)).select(
        "conversation_hash", "device_type", big("total_devices"), r6("mobile_percentage"), r6("desktop_percentage"))


def turns(spark, sf):
    return dv.turns_by_device(used(spark, sf)).select(
        "device_type", r6("avg_turns"), r6("std_turns"), "count", r6("percentage"), r6("avg_turns_all"))


def moments(spark, sf):
    return dv.turn_moments_by_device(used(spark, sf)).select(
        "device_type", "count", r6("mean"), r6("std"), r6("skewness"), r6("kurtosis"))


def descriptives(spark, sf):
    return dv.turn_descriptives_by_device(used(spark, sf)).select(
        "device_type", "count", r6("mean"), r6("std_dev"), big("q1"), big("median"), big("q3"), big("iqr"))


def test_all(spark, sf):
    return dv.compare_devices(used(spark, sf), ["conversation_hash"], size=None).select(
        "n1", "n2", r6("u"), r6("z"), r6("effect_size"), "interpretation")


def test_sampled(spark, sf):
    return dv.compare_devices(used(spark, sf), ["conversation_hash"], size=1000).select(
        "n1", "n2", r6("u"), r6("p_value"), r6("effect_size"), "interpretation")


def median_interval(spark, sf):
    return dv.median_turn_difference(spark, used(spark, sf))


def normality(spark, sf):
    return dv.turn_normality_table(used(spark, sf), "mobile", 9).select(
        r6("probability"), r6("normal"), r6("sample"))


def test_p(spark, sf):
    return dv.compare_devices(used(spark, sf)).select(r6("p_value"))


def mann_whitney_sql(source: str, p_value: bool = False) -> str:
    """Statistics of a table ``source``(value, n1, n2) of counts per value, or the p-value."""
    if p_value:
        first = mann_whitney_sql(source).split("SELECT CAST(a AS BIGINT)")[0]
        return f"{first} SELECT round(least(1.0, 2 * (1 - {normal_sql('z')})), 6) AS p_value FROM scored"
    return f"""ranked AS (SELECT *, COALESCE(sum(n2) OVER (ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
  FROM {source}), summed AS (
  SELECT CAST(sum(n1) AS DOUBLE) AS a, CAST(sum(n2) AS DOUBLE) AS b, CAST(sum(n1 * (below + n2 / 2)) AS DOUBLE) AS u,
    CAST(sum((n1 + n2) ** 3 - (n1 + n2)) AS DOUBLE) AS ties FROM ranked), scored AS (
  SELECT *, greatest(0, (greatest(u, a * b - u) - a * b / 2 - 0.5)
    / sqrt(a * b / 12 * (a + b + 1 - ties / ((a + b) * (a + b - 1))))) AS z FROM summed)
SELECT CAST(a AS BIGINT) AS n1, CAST(b AS BIGINT) AS n2, round(u, 6) AS u, round(z, 6) AS z,
  round(z / sqrt(a + b), 6) AS effect_size,
  CASE WHEN z / sqrt(a + b) < 0.1 THEN 'Negligible effect' WHEN z / sqrt(a + b) < 0.3 THEN 'Small effect'
    WHEN z / sqrt(a + b) < 0.5 THEN 'Medium effect' ELSE 'Large effect' END AS interpretation FROM scored"""


_SHARES = "round({m} * 100.0 / {t}, 6) AS mobile_percentage, round({d} * 100.0 / {t}, 6) AS desktop_percentage"
_MOBILE = "count(*) FILTER (device_type = 'mobile')"
_DESKTOP = "count(*) FILTER (device_type = 'desktop')"

CHECKS = {
    "device_counts": Check(counts, f"WITH {USAGE} SELECT device_type, count(*) AS count FROM usage GROUP BY 1"),
    "device_counts_with_unknown": Check(counts_with_unknown, f"""
WITH {USAGE} SELECT CASE WHEN agent IS NULL THEN 'unknown' ELSE device_type END AS device_type, count(*) AS count
FROM usage GROUP BY 1"""),
    "devices_by_country": Check(by_country, f"""
WITH {USAGE} SELECT country, {_MOBILE} AS mobile, {_DESKTOP} AS desktop, count(*) AS total_devices,
  {_SHARES.format(m=_MOBILE, d=_DESKTOP, t='count(*)')} FROM usage GROUP BY country"""),
    "large_countries": Check(large, f"""
WITH {USAGE} SELECT country, count(*) AS total_devices FROM usage GROUP BY country HAVING count(*) > 350"""),
    "devices_by_continent": Check(by_continent, f"""
WITH {USAGE}, {CONTINENTS} SELECT continent, {_MOBILE} AS total_mobile, {_DESKTOP} AS total_desktop,
  count(*) AS total_devices, {_SHARES.format(m=_MOBILE, d=_DESKTOP, t='count(*)')}
FROM usage LEFT JOIN continents USING (country) GROUP BY continent"""),
    "toxic_rate_by_device": Check(toxic, f"""
WITH {CHATS} SELECT device_type, round(avg(CASE WHEN toxic THEN 1 ELSE 0 END), 6) AS avg_toxicity FROM chats GROUP BY 1"""),
    "messages_by_device": Check(messages, f"""
WITH {CHATS} SELECT device_type, round(avg(len(lines)), 6) AS avg_messages FROM chats GROUP BY 1"""),
    "message_length_by_device": Check(length, f"""
WITH {MESSAGES} SELECT device_type, round(avg(length(line)), 6) AS avg_message_length FROM msgs GROUP BY 1"""),
    "device_percentages_by_row": Check(row_percentages, f"""
WITH {USAGE} SELECT conversation_hash, device_type, CAST(1 AS BIGINT) AS total_devices,
  CASE device_type WHEN 'mobile' THEN 100.0::DOUBLE ELSE 0.0::DOUBLE END AS mobile_percentage,
  CASE device_type WHEN 'mobile' THEN 0.0::DOUBLE ELSE 100.0::DOUBLE END AS desktop_percentage FROM usage"""),
    "turns_by_device": Check(turns, f"""
WITH {USAGE} SELECT device_type, round(avg(turn), 6) AS avg_turns, round(stddev_samp(turn), 6) AS std_turns,
  count(*) AS count, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percentage,
  round((SELECT avg(turn) FROM usage), 6) AS avg_turns_all FROM usage GROUP BY 1"""),
    "turn_moments_by_device": Check(moments, f"""
WITH {USAGE} SELECT device_type, count(turn) AS count, round(avg(turn), 6) AS mean, round(stddev_samp(turn), 6) AS std,
  round(skewness(turn) * (count(turn) - 2) / sqrt(count(turn) * (count(turn) - 1.0)), 6) AS skewness,
  round(kurtosis_pop(turn), 6) AS kurtosis FROM usage GROUP BY 1"""),
    "turn_descriptives_by_device": Check(descriptives, f"""
WITH {USAGE} SELECT device_type, count(turn) AS count, round(avg(turn), 6) AS mean, round(stddev_samp(turn), 6) AS std_dev,
  quantile_disc(turn, 0.25) AS q1, quantile_disc(turn, 0.5) AS median, quantile_disc(turn, 0.75) AS q3,
  quantile_disc(turn, 0.75) - quantile_disc(turn, 0.25) AS iqr FROM usage GROUP BY 1"""),
    "compare_devices": Check(test_all, f"""
WITH {USAGE}, v AS (SELECT turn AS value, {_DESKTOP} AS n1, {_MOBILE} AS n2 FROM usage GROUP BY turn),
{mann_whitney_sql('v')}"""),
    "compare_devices_p_value": Check(test_p, f"""
WITH {USAGE}, v AS (SELECT turn AS value, {_DESKTOP} AS n1, {_MOBILE} AS n2 FROM usage GROUP BY turn),
{mann_whitney_sql('v', True)}"""),
    "compare_devices_sampled": Check(test_sampled),
    "median_turn_difference": Check(median_interval),
    "turn_normality_table": Check(normality, f"""
WITH {USAGE}, q AS (SELECT unnest([0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS probability,
  unnest([-1.281552, -0.841621, -0.524401, -0.253347, 0.0, 0.253347, 0.524401, 0.841621, 1.281552]) AS normal,
  unnest(quantile_disc(turn, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS sample FROM usage
  WHERE device_type = 'mobile')
SELECT CAST(probability AS DOUBLE) AS probability, CAST(normal AS DOUBLE) AS normal, CAST(sample AS DOUBLE) AS sample FROM q"""),
}
