from datetime import datetime as dt

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from parlance.plans import devices, harm, languages, localtime, structure, users, words
from parlance.sources import sinks
from parlance.sources import (
    combine_corpora, distinct_values, one_per_first_turn, one_per_key, read_corpus, read_lines, row_count, rows_not_in,
    shared_columns, with_continent, write_csv, write_parquet, write_partitions,
)


def rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


# --- sources ---------------------------------------------------------------------


def test_corpora_with_different_nested_fields(spark):
    first = spark.createDataFrame(
        [("h1", "gpt-4", [("hi", "user", "English")], [((True, False), True)])],
        "conversation_hash string, model string, conversation array<struct<content:string,role:string,language:string>>,"
        "openai_moderation array<struct<categories:struct<hate:boolean,`hate/x`:boolean>,flagged:boolean>>")
    second = spark.createDataFrame(
        [("i1", "vicuna", [("yo", "user")], [((False,), False)])],
        "conversation_id string, model string, conversation array<struct<content:string,role:string>>,"
        "openai_moderation array<struct<categories:struct<hate:boolean>,flagged:boolean>>")
    both = combine_corpora(first, second)
    assert "conversation_id" not in both.columns
    got = {r.conversation_identifier: r for r in both.collect()}
    assert got["i1"].conversation[0].language is None
    assert got["i1"].openai_moderation[0].categories["hate/x"] is None
    assert rows(shared_columns(first, second), "model") == [("gpt-4",), ("vicuna",)]
    assert shared_columns(first, second).columns == ["model"]


def test_sinks(spark, tmp_path):
    df = spark.range(5).withColumn("v", F.col("id") * 2).repartition(3)
    write_csv(df, str(tmp_path / "c"))
    write_csv(df, str(tmp_path / "c"))
    assert row_count(spark.read.option("header", True).csv(str(tmp_path / "c"))).first()["rows"] == 5
    write_parquet(df, str(tmp_path / "p"), single_file=True)
    assert len(list((tmp_path / "p").glob("*.parquet"))) == 1
    assert rows(read_corpus(spark, str(tmp_path / "p")), "v") == [(0,), (2,), (4,), (6,), (8,)]


def test_single_file_is_for_small_tables(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "ONE_FILE_ROWS", 100)
    with pytest.raises(ValueError):
        write_parquet(spark.range(101), str(tmp_path / "p"), single_file=True)
    assert not (tmp_path / "p").exists()
    write_parquet(spark.range(100), str(tmp_path / "p"), single_file=True)
    write_parquet(spark.range(7), str(tmp_path / "p"), single_file=True)
    assert spark.read.parquet(str(tmp_path / "p")).count() == 7


def test_partitions_are_split_and_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "days")
    first = spark.range(1000).select(F.lit("hot").alias("day"), F.col("id"), F.lit(1).alias("v")).unionByName(
        spark.range(30).selectExpr("CASE WHEN id % 3 = 0 THEN NULL ELSE concat('d', id % 3) END AS day", "id", "1 AS v"))
    write_partitions(first, path, ["day"], rows_per_file=100)
    files = {d.name: [pq.ParquetFile(f).metadata.num_rows for f in d.glob("*.parquet")] for d in (tmp_path / "days").iterdir() if d.is_dir()}
    assert set(files) == {"day=hot", "day=d1", "day=d2", "day=__HIVE_DEFAULT_PARTITION__"}
    assert len(files["day=hot"]) > 3 and max(files["day=hot"]) < 500 and all(len(f) == 1 for d, f in files.items() if d != "day=hot")
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "days").glob("day=*/*.parquet")}
    again = spark.createDataFrame([("d1", 5, 2), ("d9", 6, 2)], "day string, id long, v int")
    write_partitions(again, path, ["day"])
    got = spark.read.parquet(path)
    assert rows(got.filter("v = 2"), "day", "id") == [("d1", 5), ("d9", 6)]
    assert got.count() == 1000 + 20 + 2 and got.filter("day IS NULL").count() == 10
    assert {f for f, t in before.items() if f.exists() and f.stat().st_mtime_ns == t} == {f for f in before if f.parent.name != "day=d1"}
    same = spark.range(600).selectExpr("'x' AS day", "7L AS id", "3 AS v")
    write_partitions(same, path, ["day"], rows_per_file=100)
    assert spark.read.parquet(path).filter("day = 'x'").count() == 600 and len(list((tmp_path / "days/day=x").glob("*.parquet"))) > 1
    with pytest.raises(ValueError):
        write_partitions(same, path, [])


def test_word_count_keeps_empty_words(spark, tmp_path):
    (tmp_path / "t.txt").write_text("a b  a\n\nb\n")
    got = words.word_count(read_lines(spark, str(tmp_path / "t.txt")))
    assert rows(got, "word", "count") == [("", 2), ("a", 2), ("b", 2)]


def test_continents_with_overrides(spark):
    table = spark.createDataFrame([("India", "Asia"), ("Russia", "Asia")], "country string, continent string")
    df = spark.createDataFrame([("India",), ("Russia",), ("Kosovo",), ("Narnia",), (None,)], "country string")
    assert rows(with_continent(df, table), "country", "continent") == sorted(
        [("India", "Asia"), ("Russia", "Europe"), ("Kosovo", "Europe"), ("Narnia", None), (None, None)], key=repr)


def test_copies_and_differences(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y"), (3, None), (3, None)], "k int, v string")
    b = spark.createDataFrame([(2, "y"), (4, "z")], "k int, v string")
    assert rows(rows_not_in(a, b), "k", "v") == sorted([(1, "x"), (3, None)], key=repr)
    assert rows(one_per_key(a, ["k"]), "k") == [(1,), (2,), (3,)]
    assert distinct_values(a, "v").count() == 3
    talks = spark.createDataFrame(
        [(1, [(7, "u"), (8, "u")]), (2, [(7, "u")]), (3, [(9, "u")]), (4, [])],
        "id int, conversation array<struct<turn_identifier:bigint,role:string>>")
    assert one_per_first_turn(talks).count() == 3 and "_first" not in one_per_first_turn(talks).columns


# --- structure -------------------------------------------------------------------

MESSAGE = "struct<content:string,role:string,timestamp:string>"


@pytest.fixture(scope="module")
def talks(spark):
    return spark.createDataFrame([
        ("a", "m1", [("hello", "user", None), ("good day", "assistant", "2024-01-01 00:00:10"),
                     ("bye", "user", None), ("ok", "assistant", "2024-01-01 00:01:40")]),
        ("b", "m2", [("x" * 9, "user", None)]),
        ("c", "m1", []),
        ("d", "m1", None),
        ("a", "m1", [("again", "user", "2024-01-01 00:02:00")]),
        ("e", "m2", [("sys", "system", None), ("q", "user", None), ("abcd", "assistant", "not a time")]),
    ], f"conversation_identifier string, model string, conversation array<{MESSAGE}>")


def test_durations(talks):
    spans = structure.conversation_spans(talks)
    assert rows(spans, "conversation_identifier", "duration", "messages") == [
        ("a", 110, 5), ("b", None, 1), ("e", None, 3)]
    assert rows(structure.conversation_durations(spans), "conversation_identifier", "duration") == [("a", 110)]
    assert structure.missing_duration_share(spans).first()[0] == pytest.approx(4 / 9)


def test_message_lengths(talks):
    got = {r.turn_number: r.avg_content_length for r in structure.user_length_by_turn(talks).collect()}
    assert got == {1: pytest.approx((5 + 9 + 5 + 1) / 4), 2: 3.0}
    assert rows(structure.assistant_length_by_turn(talks), "turn_number", "model", "avg_content_length") == [
        (1, "m1", 8.0), (1, "m2", 4.0), (2, "m1", 2.0)]
    assert rows(structure.assistant_length_by_position(talks), "turn_number", "model", "avg_content_length") == [
        (1, "m1", 8.0), (2, "m2", 4.0), (3, "m1", 2.0)]
    assert structure.user_length_by_turn(talks, last_turn=1).count() == 1


def test_duplicates_and_models(talks):
    assert rows(structure.duplicate_ids(talks, "conversation_identifier"), "conversation_identifier", "count") == [("a", 2)]
    assert structure.model_count(talks).first()[0] == 2
    assert structure.conversations_longer_than(talks, 2).count() == 2


def test_flat_and_nested_lengths_agree(talks):
    flat = talks.filter("conversation_identifier in ('b', 'e')").select(
        "conversation_identifier", "model", F.posexplode("conversation").alias("pos", "m")).select("*", "m.*")
    nested = structure.assistant_length_by_turn(talks.filter("conversation_identifier in ('b', 'e')"))
    got = structure.length_by_turn_flat(flat, "assistant", "conversation_identifier", "pos", "content", ["model"])
    names = ("turn_number", "model", "avg_content_length")
    assert rows(got, *names) == rows(nested, *names)


def test_toxicity_by_turn_index_numbers_copies(spark):
    one = "array<struct<toxicity:double>>"
    df = spark.createDataFrame(
        [("a", 1, [(0.2,)])] * 3 + [("a", 2, [(0.8,)]), ("b", 1, [(0.4,), (0.9,)]), ("c", 1, []), ("d", 1, None)],
        f"conversation_hash string, turn int, detoxify_moderation {one}")
    got = {r.turn_index: r.avg_toxicity for r in structure.toxicity_by_turn_index(df).collect()}
    assert got == {1: pytest.approx(0.3), 2: pytest.approx(0.2), 3: pytest.approx(0.2), 4: pytest.approx(0.8)}
    by_position = {r.turn_index: r.avg_toxicity for r in structure.toxicity_by_position(df).collect()}
    assert by_position == {1: pytest.approx((0.2 * 3 + 0.8 + 0.4) / 5), 2: 0.9}


# --- users -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def log(spark):
    visits = [("one_day", dt(2024, 1, 1, h), 1) for h in range(5)]
    visits += [("exact", dt(2024, 1, d, 3), 2) for d in (1, 1, 2, 3)]
    visits += [("busy", dt(2024, 1, 1 + i // 5, i % 5), 3) for i in range(10)]
    visits += [("rare", dt(2024, 1, 1), 9), ("rare", dt(2024, 1, 31), 11), (None, dt(2024, 1, 1), 5)]
    return spark.createDataFrame(
        [(str(i), u, t, n, "gpt-4" if n > 1 else "gpt-3.5-x", "A" if n < 3 else "B") for i, (u, t, n) in enumerate(visits)],
        "conversation_hash string, hashed_ip string, timestamp timestamp_ntz, turn int, model string, country string")


def test_activity_profile(log):
    got = {r.hashed_ip: r for r in users.activity_profile(log).collect()}
    assert set(got) == {"one_day", "exact", "busy", "rare"}
    assert (got["one_day"].num_days, got["one_day"].avg_conv_per_day, got["one_day"].repeat_user) == (0, None, 0)
    assert (got["exact"].avg_conv_per_day, got["exact"].repeat_user) == (2.0, 0)
    assert (got["busy"].avg_conv_per_day, got["busy"].repeat_user) == (10.0, 1)
    assert users.repeat_share_of_users(users.activity_profile(log)).first()["percentage"] == 25.0


def test_percentile_cut_drops_single_day_users(log):
    kept = users.without_heaviest(users.activity_profile(log), 0.5)
    assert rows(kept, "hashed_ip") == [("exact",), ("rare",)]


def test_turns_by_class(log):
    got = {r.user_class: (r.users, r.mean_turns, r.median_turns) for r in users.turns_by_class(users.activity_profile(log)).collect()}
    assert got == {"repeat": (1, 3.0, 3.0), "other": (3, pytest.approx(13 / 3), 2.0), "all": (4, 4.0, 2.0)}


def test_repeat_share_by_country(log):
    got = users.repeat_share_by_country(log, 2)
    assert rows(got, "country", "conversations", "percentage") == [("B", 10, pytest.approx(100 * 10 / 12))]


def test_repeat_counts(log):
    got = users.repeat_share(log, 2).first()
    assert (got.total_users, got.repeat_users) == (5, 3)
    histogram = users.conversation_count_histogram(log, 4)
    assert rows(histogram, "conversation_count", "user_count", "percentage") == [(1, 1, 20.0), (2, 1, 20.0), (4, 3, 60.0)]


def test_trimmed_users(log):
    # The only repeat user is its own 90th percentile, and the cut is exclusive.
    assert users.trimmed_repeat_users(log).count() == 0
    two = users.trimmed_repeat_users(log, per_day=1)
    assert rows(two, "hashed_ip") == [("exact",)]
    assert users.conversations_of(log, two).count() == 4


def test_identities_count_missing_parts(spark):
    header = "struct<`user-agent`:string,`accept-language`:string>"
    df = spark.createDataFrame(
        [("u", ("x", "en")), ("u", (None, "en")), ("u", None), ("v", ("x", "en"))], f"hashed_ip string, header {header}")
    assert tuple(users.identity_candidates(df).first()) == (2, 3, 3)


# --- local time ------------------------------------------------------------------


@pytest.fixture(scope="module")
def places(spark):
    return spark.createDataFrame(
        [("India", None, "Asia/Kolkata", (5, 30)), ("Nepal", "Bagmati", "Asia/Kathmandu", (5, 45)),
         ("Brazil", "Acre", "America/Rio_Branco", (-5, 0))],
        "ccountry string, sstate string, timezone string, gmt_offset struct<hours:int,minutes:int>")


def test_location_match(spark, places):
    at = dt(2024, 1, 1, 1, 0)  # a Monday
    df = spark.createDataFrame(
        [(1, "India", None, at), (2, "India", "Goa", at), (3, "Nepal", "Bagmati", at), (4, "Brazil", "Acre", at),
         (5, "Atlantis", None, at), (6, None, None, at)], "id int, country string, state string, timestamp timestamp_ntz")
    local = localtime.with_local_time(df, places)
    assert rows(local, "id", "hour_bin_offseted", "day_of_week") == [
        (1, 6, 2), (2, None, None), (3, 6, 2), (4, 20, 1), (5, None, None)]
    assert localtime.unmatched_locations(local).first()[0] == 2
    assert localtime.with_local_time(df, places, require_country=False).count() == 6


def test_peak_hours_keep_ties_and_skip_unknown(spark):
    hours = [0] * 9 + [1] * 8 + [2] * 7 + [3] * 6 + [5] * 5 + [4] * 5 + [7]
    df = spark.createDataFrame(
        [("X", h) for h in hours] + [("Y", None)] * 3 + [("Y", 2), (None, 1)], "country string, hour_bin_offseted int")
    got = {r.country: r.offseted_peak_hours for r in localtime.peak_hours_by_country(df).collect()}
    assert got == {"X": [0, 1, 2, 3, 4, 5], "Y": [2]}


def test_continent_percentage_is_of_all_days(spark):
    df = spark.createDataFrame(
        [("A", 9, 2), ("A", 9, 1), ("B", 9, 3), ("A", None, None), ("Z", 9, 2)],
        "country string, hour_bin_offseted int, day_of_week int")
    table = spark.createDataFrame([("A", "Land"), ("B", "Land")], "country string, continent string")
    got = localtime.weekday_hours_by_continent(df, table)
    assert rows(got, "continent", "hour_bin_offseted", "count", "percentage") == [("Land", 9, 2, 50.0)]
    got = localtime.weekday_hours_by_continent(df, table, weekday_total=True)
    assert rows(got, "percentage") == [(100.0,)]


def test_months(spark):
    df = spark.createDataFrame([(dt(2024, 1, 5), 1), (dt(2024, 1, 6), 3), (dt(2023, 12, 1), 5)], "t timestamp, turn int")
    got = [(r.year, r.month, r.month_year_timestamp, r.avg_turns) for r in localtime.monthly_turns(df, "t").collect()]
    assert got == [(2023, 12, dt(2023, 12, 1), 5.0), (2024, 1, dt(2024, 1, 1), 2.0)]
    assert [r["count"] for r in localtime.monthly_counts(df, "t").collect()] == [1, 2]
    span = localtime.time_range(df, "t").first()
    assert (span.earliest_year, span.latest_month) == (2023, 1)


# --- devices ---------------------------------------------------------------------


def test_devices(spark):
    df = spark.createDataFrame(
        [("A", ("x mobile",), 2, True, [("ab", "user"), ("cdef", "assistant")]), ("A", (None,), 4, None, [("a", "user")]),
         ("A", ("pc",), 6, False, None), (None, None, 8, True, [])],
        "country string, header struct<`user-agent`:string>, turn int, toxic boolean,"
        "conversation array<struct<content:string,role:string>>")
    used = devices.with_device(df)
    assert rows(devices.device_counts(used), "device_type", "count") == [("desktop", 3), ("mobile", 1)]
    by_country = {r.country: r for r in devices.devices_by_country(used).collect()}
    assert (by_country["A"].mobile, by_country["A"].desktop, by_country["A"].total_devices) == (1, 2, 3)
    assert by_country[None].mobile == 0 and by_country[None].desktop_percentage == 100.0
    assert rows(devices.toxic_rate_by_device(used), "device_type", "avg_toxicity") == [
        ("desktop", pytest.approx(1 / 3)), ("mobile", 1.0)]
    assert rows(devices.messages_by_device(used), "device_type", "avg_messages") == [("desktop", 0.5), ("mobile", 2.0)]
    assert rows(devices.message_length_by_device(used), "device_type", "avg_message_length") == [
        ("desktop", 1.0), ("mobile", 3.0)]
    turns = {r.device_type: r for r in devices.turns_by_device(used).collect()}
    assert turns["desktop"].avg_turns_all == 5.0 and turns["desktop"].percentage == 75.0
    assert rows(devices.large_countries(devices.devices_by_country(used), 2), "country") == [("A",)]


# --- harm ------------------------------------------------------------------------

CATEGORIES = "struct<harassment:boolean,hate:boolean,`self-harm`:boolean,sexual:boolean,violence:boolean,violence_graphic:boolean,`violence/graphic`:boolean>"
NONE, SEXUAL = (False,) * 7, (False, False, False, True, False, False, False)
GRAPHIC = (False, False, False, False, True, True, True)


@pytest.fixture(scope="module")
def judged(spark):
    ask, answer = ("q", "user", False, False), ("r", "assistant", True, True)
    return spark.createDataFrame([
        # more verdicts than messages, fewer, none, an element without verdict
        ("a", "gpt-4-x", "English", "A", 3, 21, 2, [ask, answer], [(NONE, False), (SEXUAL, True), (GRAPHIC, True)]),
        ("b", "gpt-4-x", "English", "A", 1, 3, 2, [ask, answer], [(GRAPHIC, True)]),
        ("c", "gpt-3.5-y", "English", "B", 5, 12, 3, [ask, answer], None),
        ("d", "gpt-3.5-y", "English", None, 7, None, None, [ask, answer, ask, answer], [(NONE, False), (GRAPHIC, True), None, (None, None)]),
        ("e", "zephyr", "French", "B", 9, 21, 2, [], []),
    ], "conversation_hash string, model string, language string, country string, turn int, hour_bin_offseted int, day_of_week int,"
       "conversation array<struct<content:string,role:string,toxic:boolean,redacted:boolean>>,"
       f"openai_moderation array<struct<categories:{CATEGORIES},flagged:boolean>>")


def test_turns_by_harm(judged):
    got = {r.conversations: (r.avg_turns, r.median_turns) for r in harm.turns_by_harm(judged).collect()}
    assert got == {"harmful": (pytest.approx(11 / 3), 3), "other": (9.0, 9), "all": (5.0, 5)}


def test_harm_by_time(judged):
    hours = harm.harm_by_hour(judged)
    assert rows(hours, "hour_bin", "num_harm", "total", "percentage") == [(21, 1, 2, 50.0), (3, 1, 1, 100.0)]
    assert rows(hours, "harm_percentage") == [(pytest.approx(100 / 3),)] * 2
    assert rows(harm.harm_by_day_and_hour(judged), "day_of_week", "hour_bin", "percentage") == [(2, 21, 50.0), (2, 3, 100.0)]


def test_categories(judged):
    got = harm.categories_in_hours(judged)
    assert rows(got, "harmful_flag", "count", "percentage") == [
        ("sexual", 1, 50.0), ("violence", 2, 100.0), ("violence/graphic", 2, 100.0), ("violence_graphic", 2, 100.0)]
    merged = harm.categories_in_hours(judged, canonical=True)
    assert rows(merged, "harmful_flag", "count") == [("sexual", 1), ("violence", 2), ("violence_graphic", 2)]
    families = harm.categories_by_family(judged)
    assert rows(families, "model_family", "harmful_flag", "num_harm", "total") == [
        ("GPT-3.5", "violence", 1, 2), ("GPT-3.5", "violence/graphic", 1, 2), ("GPT-3.5", "violence_graphic", 1, 2),
        ("GPT-4", "sexual", 1, 2)]


def test_assistant_harm(judged):
    got = harm.assistant_harm_by_model(judged, by_family=True)
    assert rows(got, "model_family", "total_model_messages", "harmful_model_messages") == [
        ("GPT-3.5", 2, 1), ("GPT-4", 2, 1)]
    assert harm.assistant_harm_overall(got).first()[0] == 50.0
    assert rows(harm.harm_by_family(judged), "model_family", "num_harm", "total") == [("GPT-3.5", 1, 2), ("GPT-4", 2, 2)]
    assert harm.harm_overall(judged).first()["percentage"] == pytest.approx(60.0)


def test_message_table(judged):
    table = harm.message_table(judged, keep=["conversation_hash"])
    assert rows(table, "conversation_hash", "position", "sexual", "violence") == [
        ("a", 0, 0, 0), ("a", 1, 1, 0), ("b", 0, 0, 1), ("b", 1, 0, 0), ("c", 0, 0, 0), ("c", 1, 0, 0),
        ("d", 0, 0, 0), ("d", 1, 0, 1), ("d", 2, 0, 0), ("d", 3, 0, 0)]
    ratios = harm.toxic_ratio_by_country(table)
    assert rows(ratios, "country", "toxic_count", "total_count", "toxic_ratio") == sorted(
        [("A", 2, 4, 0.5), ("B", 1, 2, 0.5), (None, None, 4, None)], key=repr)


# --- languages -------------------------------------------------------------------


def test_switches(spark):
    def m(role, language, turn):
        return (turn, role, language)
    df = spark.createDataFrame([
        ("gpt-4-a", [m("user", "English", 1), m("assistant", "English", 1), m("user", "French", 2), m("assistant", "English", 2)]),
        ("gpt-4-b", [m("user", "German", 3), m("assistant", "English", 3), m("assistant", "French", 3)]),
        ("gpt-3.5-c", [m("user", "English", 4), m("assistant", None, 4), m("user", "English", 5)]),
        ("gpt-3.5-d", [m("assistant", "English", 6)]),
    ], "model string, conversation array<struct<turn_identifier:bigint,role:string,language:string>>")
    messages = languages.switch_table(df)
    rates = languages.switch_rates(messages)
    assert rows(rates, "model_tag", "language_switches", "total_turns", "switch_rate") == [
        ("gpt-3.5", 0, 2, 0.0), ("gpt-4", 2, 4, 0.5)]
    assert tuple(languages.switch_totals(rates).first()) == (2, 6, pytest.approx(1 / 3))
    assert rows(languages.switch_sources(messages), "model_tag", "prev_language", "count") == [
        ("gpt-4", "French", 1), ("gpt-4", "German", 1)]
    assert rows(languages.switch_counts(messages), "model_tag", "language_switch", "weight") == [
        ("gpt-3.5", 0, 2), ("gpt-4", 0, 2), ("gpt-4", 1, 2)]
    test = languages.switch_test(messages).first()
    assert (test.n1, test.n2, test.u) == (2, 4, 2.0)


def test_top_languages(spark):
    df = spark.createDataFrame(
        [("gpt-4", x, "P") for x in "aaabbc"] + [("gpt-3.5", "b", "Q"), ("gpt-3.5", "a", "Q"), ("gpt-3.5", "z", "R")],
        "model string, language string, country string")
    top = languages.top_languages_by_tag(df, 2)
    assert rows(top, "model_tag", "language", "rank") == [
        ("gpt-3.5", "a", 1), ("gpt-3.5", "b", 2), ("gpt-4", "a", 1), ("gpt-4", "b", 2)]
    wide = {r.model_tag: (r.a, r.b) for r in languages.languages_by_tag_wide(top, ["a", "b"]).collect()}
    assert wide == {"gpt-3.5": (1, 1), "gpt-4": (3, 2)}
    both = languages.top_languages(df, df, 1)
    assert rows(both, "language", "count") == [("a", 8)]
    named = languages.top_languages_by_country(df, languages.top_countries(df, 2), 5, ["a"])
    assert rows(named, "country", "language", "count") == [("P", "a", 3), ("P", "others", 3), ("Q", "a", 1), ("Q", "others", 1)]
    listed = languages.top_languages_by_country(df, ["R"], 5, ["a"])
    assert rows(languages.languages_by_country_wide(listed, ["a"]), "country", "a", "others") == [("R", None, 1)]
