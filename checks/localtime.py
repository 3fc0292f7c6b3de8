"""Registered queries on local time, countries and continents."""
from pyspark.sql import functions as F

from parlance.plans import localtime as lt
from parlance.plans import users as us

from .adapters import (
    CONTINENTS, ORDERS, USAGE, continents, local_sql, locations, order_log, usage_log,
)
from .base import Check, big, known, r6
from .users import PROFILE

LOCAL = f"{USAGE}, {local_sql('usage')}"


def local(spark, sf):
    return lt.with_local_time(usage_log(spark, sf), locations(spark, sf))


def shifted(spark, sf):
    return local(spark, sf).select(
        "conversation_hash", F.date_format("offseted_timestamp", "yyyy-MM-dd HH:mm:ss").alias("local_time"))


def unmatched(spark, sf):
    return lt.unmatched_locations(local(spark, sf))


def by_zone(spark, sf):
    log = lt.with_local_time(usage_log(spark, sf), locations(spark, sf), by_zone=True)
    return log.groupBy("hour_bin_offseted").count().select(known("hour_bin_offseted"), "count")


def peak_hours(spark, sf):
    return lt.peak_hours_by_country(local(spark, sf)).select(
        "country", F.concat_ws(",", F.col("offseted_peak_hours").cast("array<string>")).alias("hours"))


def hourly(spark, sf):
    return lt.hourly_share(local(spark, sf)).select(known("hour_bin_offseted"), "count", r6("percentage"))


def by_day(spark, sf):
    return lt.hourly_share_by_day(local(spark, sf)).select(
        big("day_of_week"), big("hour_bin_offseted"), "count", r6("percentage"))


def busiest_day(spark, sf):
    return lt.busiest_hour_by_day(local(spark, sf)).select(
        big("day_of_week"), big("hour_bin_offseted"), r6("percentage"))


def continent(spark, sf):
    return lt.share_by_continent(usage_log(spark, sf), continents(spark, sf)).select(
        "continent", "count", r6("percentage"))


def weekday_hours(weekday_total=False):
    def run(spark, sf):
        return lt.weekday_hours_by_continent(local(spark, sf), continents(spark, sf), weekday_total).select(
            "continent", big("hour_bin_offseted"), "count", r6("percentage"))
    return run


def busiest_continent(spark, sf):
    return lt.busiest_hour_by_continent(local(spark, sf), continents(spark, sf)).select(
        "continent", big("hour_bin_offseted"), r6("percentage"))


def country(spark, sf):
    return lt.share_by_country(usage_log(spark, sf)).select(
        "country", "count", r6("percentage"), r6("cumulative_percentage"))


def _kept(spark, sf):
    log = local(spark, sf)
    return us.conversations_of(log, us.trimmed_repeat_users(log))


def kept_days(spark, sf):
    return lt.daily_share(_kept(spark, sf)).select(big("day_of_week"), "count", r6("percentage"))


def kept_grid(spark, sf):
    return lt.hourly_share_by_day(_kept(spark, sf)).select(
        big("day_of_week"), big("hour_bin_offseted"), "count", r6("percentage"))


def kept_dates(spark, sf):
    return lt.daily_counts(_kept(spark, sf)).select("date", "count")


def peak_days(spark, sf):
    return lt.peak_days(local(spark, sf)).select("date", "count")


def time_range(spark, sf):
    out = lt.time_range(order_log(spark, sf), "timestamp")
    return out.select(F.to_date("earliest").alias("earliest"), F.to_date("latest").alias("latest"),
                      *[big(c) for c in ("earliest_year", "earliest_month", "latest_year", "latest_month")])


def monthly(spark, sf):
    return lt.monthly_counts(order_log(spark, sf), "timestamp").select(
        big("year"), big("month"), "count", F.to_date("month_year_timestamp").alias("month_start"))


def monthly_turns(spark, sf):
    return lt.monthly_turns(order_log(spark, sf), "timestamp").select(
        big("year"), big("month"), r6("avg_turns"), F.to_date("month_year_timestamp").alias("month_start"))


def family_monthly(spark, sf):
    return lt.monthly_turns_by_family(order_log(spark, sf), "timestamp").select(
        "model_family", big("year"), big("month"), r6("avg_turns"))


def hourly_turns(spark, sf):
    return lt.hourly_turns(local(spark, sf)).select(known("hour_bin_offseted"), r6("avg_turns"))


_CONTINENT = f"{LOCAL}, {CONTINENTS}, placed AS (SELECT l.*, c.continent FROM local l LEFT JOIN continents c USING (country))"
_WEEKDAY = f"""WITH {_CONTINENT}, weekday AS (
  SELECT continent, h, count(*) AS n FROM placed WHERE d BETWEEN 2 AND 6 AND continent IS NOT NULL GROUP BY ALL),
totals AS (SELECT continent, count(*) AS all_days, count(*) FILTER (d BETWEEN 2 AND 6) AS weekdays
  FROM placed GROUP BY continent)"""
_MONTH = "CAST(year(ts) AS BIGINT) AS year, CAST(month(ts) AS BIGINT) AS month"
# Users are counted on the shifted log, whose rows have a country.
_KEPT = f"{PROFILE}, {local_sql('usage')}, mine AS (SELECT * FROM local WHERE hashed_ip IN (SELECT hashed_ip FROM kept))"

CHECKS = {
    "local_time": Check(shifted, f"""
WITH {LOCAL} SELECT conversation_hash, strftime(lts, '%Y-%m-%d %H:%M:%S') AS local_time FROM local"""),
    "unmatched_locations": Check(unmatched, f"""
WITH {LOCAL} SELECT count(*) FILTER (NOT matched) AS unmatched FROM local"""),
    "hours_by_zone_name": Check(by_zone, f"""
WITH {LOCAL}, z AS (SELECT *, CAST(hour(ts + to_hours(CAST(n_nationkey - 12 AS BIGINT))) AS BIGINT) AS zh
  FROM local JOIN nation ON n_name = country)
SELECT CASE WHEN matched THEN zh ELSE -1 END AS hour_bin_offseted, count(*) AS count FROM z GROUP BY 1"""),
    "peak_hours_by_country": Check(peak_hours, f"""
WITH {LOCAL}, c AS (SELECT country, h, count(*) AS n FROM local GROUP BY ALL), k AS (
  SELECT *, rank() OVER (PARTITION BY country ORDER BY n DESC) AS r FROM c)
SELECT country, COALESCE(string_agg(CAST(h AS VARCHAR), ',' ORDER BY n DESC, h), '') AS hours
FROM k WHERE r <= 5 GROUP BY country"""),
    "hourly_share": Check(hourly, f"""
WITH {LOCAL} SELECT COALESCE(h, -1) AS hour_bin_offseted, count(*) AS count,
  round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percentage FROM local GROUP BY h"""),
    "hourly_share_by_day": Check(by_day, f"""
WITH {LOCAL} SELECT d AS day_of_week, h AS hour_bin_offseted, count(*) AS count,
  round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY d), 6) AS percentage
FROM local WHERE d IS NOT NULL GROUP BY d, h"""),
    "busiest_hour_by_day": Check(busiest_day, f"""
WITH {LOCAL}, g AS (SELECT d, h, count(*) AS n, count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY d) AS p,
  rank() OVER (PARTITION BY d ORDER BY count(*) DESC) AS r FROM local WHERE d IS NOT NULL GROUP BY d, h)
SELECT d AS day_of_week, h AS hour_bin_offseted, round(p, 6) AS percentage FROM g WHERE r = 1"""),
    "share_by_continent": Check(continent, f"""
WITH {USAGE}, {CONTINENTS} SELECT continent, count(*) AS count,
  round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percentage
FROM usage LEFT JOIN continents USING (country) GROUP BY continent"""),
    "weekday_hours_by_continent": Check(weekday_hours(), f"""{_WEEKDAY}
SELECT continent, h AS hour_bin_offseted, n AS count, round(n * 100.0 / all_days, 6) AS percentage
FROM weekday JOIN totals USING (continent)"""),
    "weekday_hours_by_continent_of_weekdays": Check(weekday_hours(True), f"""{_WEEKDAY}
SELECT continent, h AS hour_bin_offseted, n AS count, round(n * 100.0 / weekdays, 6) AS percentage
FROM weekday JOIN totals USING (continent)"""),
    "busiest_hour_by_continent": Check(busiest_continent, f"""{_WEEKDAY}, k AS (
  SELECT *, rank() OVER (PARTITION BY continent ORDER BY n DESC) AS r FROM weekday JOIN totals USING (continent))
SELECT continent, h AS hour_bin_offseted, round(n * 100.0 / all_days, 6) AS percentage FROM k WHERE r = 1"""),
    "share_by_country": Check(country, f"""
WITH {USAGE}, c AS (SELECT country, count(*) AS n, count(*) * 100.0 / sum(count(*)) OVER () AS p FROM usage GROUP BY 1)
SELECT country, n AS count, round(p, 6) AS percentage,
  round(sum(p) OVER (ORDER BY n DESC), 6) AS cumulative_percentage FROM c"""),
    "repeat_users_by_weekday": Check(kept_days, f"""
WITH {_KEPT} SELECT CAST(dayofweek(ts) + 1 AS BIGINT) AS day_of_week, count(*) AS count,
  round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percentage FROM mine GROUP BY 1"""),
    "repeat_users_by_day_and_hour": Check(kept_grid, f"""
WITH {_KEPT} SELECT d AS day_of_week, h AS hour_bin_offseted, count(*) AS count,
  round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY d), 6) AS percentage
FROM mine WHERE d IS NOT NULL GROUP BY d, h"""),
    "repeat_users_by_date": Check(kept_dates, f"""
WITH {_KEPT} SELECT CAST(lts AS DATE) AS date, count(*) AS count FROM mine GROUP BY 1"""),
    "peak_days": Check(peak_days, f"""
WITH {LOCAL} SELECT CAST(lts AS DATE) AS date, count(*) AS count FROM local GROUP BY 1 ORDER BY 2 DESC, 1 NULLS FIRST LIMIT 5"""),
    "time_range": Check(time_range, f"""
WITH {ORDERS} SELECT CAST(min(ts) AS DATE) AS earliest, CAST(max(ts) AS DATE) AS latest,
  CAST(year(min(ts)) AS BIGINT) AS earliest_year, CAST(month(min(ts)) AS BIGINT) AS earliest_month,
  CAST(year(max(ts)) AS BIGINT) AS latest_year, CAST(month(max(ts)) AS BIGINT) AS latest_month FROM order_log"""),
    "monthly_counts": Check(monthly, f"""
WITH {ORDERS} SELECT {_MONTH}, count(*) AS count, CAST(date_trunc('month', ts) AS DATE) AS month_start
FROM order_log GROUP BY ALL"""),
    "monthly_turns": Check(monthly_turns, f"""
WITH {ORDERS} SELECT {_MONTH}, round(avg(turn), 6) AS avg_turns, CAST(date_trunc('month', ts) AS DATE) AS month_start
FROM order_log GROUP BY ALL"""),
    "monthly_turns_by_family": Check(family_monthly, f"""
WITH {ORDERS} SELECT model_family, {_MONTH}, round(avg(turn), 6) AS avg_turns FROM order_log GROUP BY ALL"""),
    "hourly_turns": Check(hourly_turns, f"""
WITH {LOCAL} SELECT COALESCE(h, -1) AS hour_bin_offseted, round(avg(turn), 6) AS avg_turns FROM local GROUP BY h"""),
}
