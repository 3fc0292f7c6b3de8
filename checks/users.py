"""Registered queries on users and engagement."""
from pyspark.sql import functions as F

from parlance.operators.lineage import settled
from parlance.plans import users as us

from .adapters import USAGE, usage_log
from .base import Check, big, known, r6

PROFILE = f"""{USAGE}, profile AS (
  SELECT *, CASE WHEN avg_conv_per_day > 2 THEN 1 ELSE 0 END AS repeat_user FROM (
    SELECT hashed_ip, count(*) AS conv_count, min(ts) AS a, max(ts) AS b, avg(turn) AS avg_turns,
      date_diff('day', CAST(min(ts) AS DATE), CAST(max(ts) AS DATE)) AS num_days,
      count(*) / NULLIF(date_diff('day', CAST(min(ts) AS DATE), CAST(max(ts) AS DATE)), 0) AS avg_conv_per_day
    FROM usage GROUP BY hashed_ip)), trimmed AS (
  SELECT * FROM profile WHERE avg_conv_per_day <= (SELECT quantile_disc(avg_conv_per_day, 0.9) FROM profile)),
repeats AS (SELECT * FROM profile WHERE repeat_user = 1), kept AS (
  SELECT * FROM repeats WHERE avg_conv_per_day < (SELECT quantile_disc(avg_conv_per_day, 0.9) FROM repeats))"""


def identities(spark, sf):
    return us.identity_candidates(usage_log(spark, sf))


def repeat_share(spark, sf):
    return us.repeat_share(usage_log(spark, sf)).select("total_users", "repeat_users", r6("percentage"))


def count_histogram(spark, sf):
    return us.conversation_count_histogram(usage_log(spark, sf), 60).select(
        big("conversation_count"), "user_count", r6("percentage"))


def count_histogram_model(spark, sf):
    return us.conversation_count_histogram_by_model(usage_log(spark, sf)).select(
        "model", big("conversation_count"), "user_count", r6("percentage"))


def model_share(spark, sf):
    return us.share_by_model(usage_log(spark, sf)).select("model", "count", r6("percentage"))


def family_share(spark, sf):
    return us.share_by_family(usage_log(spark, sf)).select("model_family", "count", r6("percentage"))


def turns_model(spark, sf):
    return us.mean_turns_by_model(usage_log(spark, sf)).select("model", r6("avg_turns"))


def turns_family(spark, sf):
    return us.mean_turns_by_family(usage_log(spark, sf)).select("model_family", r6("avg_turns"))


def distribution(by_family, key):
    def run(spark, sf):
        return us.turn_distribution(usage_log(spark, sf), by_family).select(
            key, big("turn"), "count", r6("percentage"))
    return run


def profile(spark, sf):
    return us.activity_profile(usage_log(spark, sf)).select(
        "hashed_ip", "conv_count", F.to_date("earliest_date").alias("earliest_date"),
        F.to_date("latest_date").alias("latest_date"), big("num_days"), r6("avg_conv_per_day"),
        big("repeat_user"))


def class_sizes(spark, sf):
    return us.repeat_class_sizes(us.activity_profile(usage_log(spark, sf))).select(
        big("repeat_user"), "count")


def _trimmed(spark, sf):
    return us.without_heaviest(settled(us.activity_profile(usage_log(spark, sf))))


def class_counts(spark, sf):
    return us.conversation_counts_by_class(_trimmed(spark, sf)).select(
        big("repeat_user"), "conv_count", "count", r6("percentage"))


def class_turns(spark, sf):
    return us.turns_by_class(_trimmed(spark, sf)).select(
        "user_class", "users", r6("mean_turns"), r6("median_turns"))


def deciles(exact):
    def run(spark, sf):
        return us.turn_decile_histogram(_trimmed(spark, sf), exact).select(
            big("repeat_user"), big("bin"), r6("low"), r6("high"), "count", r6("percentage"))
    return run


def gaps(spark, sf):
    return us.user_time_gaps(usage_log(spark, sf)).select(
        "hashed_ip", "conv_count", r6("avg_time_gap"), known("median_time_gap"), big("repeat_user"))


def gap_classes(spark, sf):
    return us.time_gaps_by_class(us.user_time_gaps(usage_log(spark, sf))).select(
        big("repeat_user"), r6("mean_of_mean_gap"), r6("median_of_median_gap"), r6("mean_of_median_gap"))


def country_repeat(spark, sf):
    return us.repeat_share_by_country(usage_log(spark, sf)).select(
        "country", "conversations", r6("percentage"))


def overall_repeat(spark, sf):
    return us.repeat_share_of_users(us.activity_profile(usage_log(spark, sf))).select(
        "total_users", "repeat_users", r6("percentage"))


def trimmed_users(spark, sf):
    return us.trimmed_repeat_users(usage_log(spark, sf)).select("hashed_ip", "conv_count", r6("avg_conv_per_day"))


def trimmed_conversations(spark, sf):
    log = usage_log(spark, sf)
    return us.conversations_of(log, us.trimmed_repeat_users(log)).select(
        "conversation_hash", "hashed_ip", "model")


def composite_users(spark, sf):
    from parlance.functions.labels import composite_user
    return usage_log(spark, sf).groupBy(composite_user().alias("composite_key")).agg(
        F.count("*").alias("conversations"))


_GAPS = f"""WITH {USAGE}, t AS (
  SELECT hashed_ip, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS s FROM usage), g AS (
  SELECT hashed_ip, s - lag(s) OVER (PARTITION BY hashed_ip ORDER BY s) AS gap FROM t), per_user AS (
  SELECT hashed_ip, count(*) AS conv_count, avg(gap) AS mean_gap, quantile_disc(gap, 0.5) AS median_gap,
    CAST(CASE WHEN count(*) > 3 THEN 1 ELSE 0 END AS BIGINT) AS repeat_user
  FROM g GROUP BY hashed_ip)"""
_DISTRIBUTION = """SELECT {key}, t AS turn, count(*) AS count,
  round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY {key}), 6) AS percentage
FROM (SELECT {key}, CAST(CASE WHEN turn < 10 THEN turn ELSE 10 END AS BIGINT) AS t FROM usage) GROUP BY {key}, t"""

_DECILES = f"""WITH {PROFILE}, edges AS (
  SELECT repeat_user, quantile_{{kind}}(avg_turns, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]) AS t
  FROM trimmed GROUP BY repeat_user), binned AS (
  SELECT p.repeat_user, t, COALESCE(list_min(list_filter(range(10), lambda i: avg_turns >= t[i + 1] AND avg_turns < t[i + 2])), 9) AS bin
  FROM trimmed p JOIN edges e ON p.repeat_user = e.repeat_user)
SELECT CAST(repeat_user AS BIGINT) AS repeat_user, CAST(bin AS BIGINT) AS bin, round(any_value(t)[bin + 1], 6) AS low,
  round(any_value(t)[bin + 2], 6) AS high, count(*) AS count,
  round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY repeat_user), 6) AS percentage
FROM binned GROUP BY repeat_user, bin"""

CHECKS = {
    "user_identities": Check(identities, f"""
WITH {USAGE} SELECT (SELECT count(*) FROM (SELECT DISTINCT hashed_ip FROM usage)) AS by_ip,
  (SELECT count(*) FROM (SELECT DISTINCT hashed_ip, agent FROM usage)) AS by_ip_and_agent,
  (SELECT count(*) FROM (SELECT DISTINCT hashed_ip, accept_language FROM usage)) AS by_ip_and_language"""),
    "composite_users": Check(composite_users, f"""
WITH {USAGE} SELECT hashed_ip || '_' || agent AS composite_key, count(*) AS conversations FROM usage GROUP BY 1"""),
    "repeat_share": Check(repeat_share, f"""
WITH {USAGE}, u AS (SELECT hashed_ip, count(*) AS n FROM usage GROUP BY 1)
SELECT count(*) AS total_users, count(*) FILTER (n > 1) AS repeat_users,
  round(count(*) FILTER (n > 1) * 100.0 / count(*), 6) AS percentage FROM u"""),
    "conversation_count_histogram": Check(count_histogram, f"""
WITH {USAGE}, u AS (SELECT least(count(*), 60) AS c FROM usage GROUP BY hashed_ip)
SELECT c AS conversation_count, count(*) AS user_count, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percentage
FROM u GROUP BY c"""),
    "conversation_count_histogram_by_model": Check(count_histogram_model, f"""
WITH {USAGE}, u AS (SELECT model, least(count(*), 10) AS c FROM usage GROUP BY hashed_ip, model)
SELECT model, c AS conversation_count, count(*) AS user_count,
  round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY model), 6) AS percentage FROM u GROUP BY model, c"""),
    "share_by_model": Check(model_share, f"""
WITH {USAGE} SELECT model, count(*) AS count, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percentage
FROM usage GROUP BY model"""),
    "share_by_family": Check(family_share, f"""
WITH {USAGE} SELECT model_family, count(*) AS count, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percentage
FROM usage GROUP BY model_family"""),
    "mean_turns_by_model": Check(turns_model, f"""
WITH {USAGE} SELECT model, round(avg(turn), 6) AS avg_turns FROM usage GROUP BY model"""),
    "mean_turns_by_family": Check(turns_family, f"""
WITH {USAGE} SELECT model_family, round(avg(turn), 6) AS avg_turns FROM usage GROUP BY model_family"""),
    "turn_distribution_by_family": Check(
        distribution(True, "model_family"), f"WITH {USAGE} {_DISTRIBUTION.format(key='model_family')}"),
    "turn_distribution_by_model": Check(
        distribution(False, "model"), f"WITH {USAGE} {_DISTRIBUTION.format(key='model')}"),
    "activity_profile": Check(profile, f"""
WITH {PROFILE} SELECT hashed_ip, conv_count, CAST(a AS DATE) AS earliest_date, CAST(b AS DATE) AS latest_date,
  CAST(num_days AS BIGINT) AS num_days, round(avg_conv_per_day, 6) AS avg_conv_per_day,
  CAST(repeat_user AS BIGINT) AS repeat_user FROM profile"""),
    "repeat_class_sizes": Check(class_sizes, f"""
WITH {PROFILE} SELECT CAST(repeat_user AS BIGINT) AS repeat_user, count(*) AS count FROM profile GROUP BY 1"""),
    "conversation_counts_by_class": Check(class_counts, f"""
WITH {PROFILE} SELECT CAST(repeat_user AS BIGINT) AS repeat_user, conv_count, count(*) AS count,
  round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY repeat_user), 6) AS percentage
FROM trimmed GROUP BY repeat_user, conv_count"""),
    "turns_by_class": Check(class_turns, f"""
WITH {PROFILE}, c AS (
  SELECT CASE repeat_user WHEN 1 THEN 'repeat' ELSE 'other' END AS user_class, avg_turns FROM trimmed
  UNION ALL SELECT 'all', avg_turns FROM trimmed)
SELECT user_class, count(*) AS users, round(avg(avg_turns), 6) AS mean_turns,
  round(quantile_disc(avg_turns, 0.5), 6) AS median_turns FROM c GROUP BY user_class"""),
    "turn_decile_histogram": Check(deciles(False), _DECILES.format(kind="disc")),
    "turn_decile_histogram_exact": Check(deciles(True), _DECILES.format(kind="cont")),
    "user_time_gaps": Check(gaps, f"""{_GAPS}
SELECT hashed_ip, conv_count, round(mean_gap, 6) AS avg_time_gap, COALESCE(median_gap, -1) AS median_time_gap,
  repeat_user FROM per_user"""),
    "time_gaps_by_class": Check(gap_classes, f"""{_GAPS}
SELECT repeat_user, round(avg(mean_gap), 6) AS mean_of_mean_gap,
  round(CAST(quantile_disc(median_gap, 0.5) AS DOUBLE), 6) AS median_of_median_gap,
  round(avg(median_gap), 6) AS mean_of_median_gap FROM per_user GROUP BY repeat_user"""),
    "repeat_share_by_country": Check(country_repeat, f"""
WITH {PROFILE}, top AS (SELECT country FROM usage GROUP BY country ORDER BY count(*) DESC, country LIMIT 7), c AS (
  SELECT country, repeat_user, count(*) AS n FROM usage JOIN profile USING (hashed_ip)
  WHERE country IN (SELECT country FROM top) GROUP BY country, repeat_user), s AS (
  SELECT *, n * 100.0 / sum(n) OVER (PARTITION BY country) AS p FROM c)
SELECT country, n AS conversations, round(p, 6) AS percentage FROM s WHERE repeat_user = 1"""),
    "repeat_share_of_users": Check(overall_repeat, f"""
WITH {PROFILE} SELECT count(*) AS total_users, CAST(sum(repeat_user) AS BIGINT) AS repeat_users,
  round(sum(repeat_user) * 100.0 / count(*), 6) AS percentage FROM profile"""),
    "trimmed_repeat_users": Check(trimmed_users, f"""
WITH {PROFILE} SELECT hashed_ip, conv_count, round(avg_conv_per_day, 6) AS avg_conv_per_day FROM kept"""),
    "trimmed_repeat_conversations": Check(trimmed_conversations, f"""
WITH {PROFILE} SELECT conversation_hash, hashed_ip, model FROM usage WHERE hashed_ip IN (SELECT hashed_ip FROM kept)"""),
}
