from datetime import datetime

import pytest
from pyspark.sql import functions as F

from parlance.functions import clock, labels, moderation


def column(spark, values, type_, expression):
    df = spark.createDataFrame([(v,) for v in values], f"v {type_}")
    return [r[0] for r in df.select(expression).collect()]


def test_model_labels(spark):
    names = ["gpt-3.5-turbo", "gpt-4-0314", "claude", None, "gpt-4.1"]
    assert column(spark, names, "string", labels.model_family("v")) == [
        "GPT-3.5", "GPT-4", "Other", "Other", "GPT-4"]
    assert column(spark, names, "string", labels.model_tag("v")) == ["gpt-3.5", "gpt-4", "", None, "gpt-4.1"]


def test_device_type_is_case_blind_and_defaults_to_desktop(spark):
    agents = ["X MoBiLe Safari", "Windows", None]
    assert column(spark, agents, "string", labels.device_type("v")) == ["mobile", "desktop", "desktop"]
    assert column(spark, agents, "string", labels.device_type("v", separate_unknown=True)) == [
        "mobile", "desktop", "unknown"]


def test_top_coding_maps_null_to_the_ceiling(spark):
    assert column(spark, [1, 9, 10, 99, None], "int", labels.top_coded("v", 10)) == [1, 9, 10, 10, 10]


@pytest.mark.parametrize("edges, values, expected", [
    ([0.0, 1.0, 2.0], [0.0, 0.5, 1.0, 2.0, 5.0, -1.0, None], [0, 0, 1, 1, 1, 1, None]),
    ([1.0, 1.0, 1.0, 3.0], [1.0, 2.0, 3.0], [2, 2, 2]),
])
def test_bin_index(spark, edges, values, expected):
    cuts = F.array(*[F.lit(e) for e in edges])
    assert column(spark, values, "double", labels.bin_index("v", cuts, len(edges) - 1)) == expected


def test_effect_labels(spark):
    assert column(spark, [0.0, 0.1, 0.3, 0.5], "double", labels.effect_label("v")) == [
        "Negligible effect", "Small effect", "Medium effect", "Large effect"]


def test_local_shift_with_odd_minutes_and_negative_hours(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 1, 0, 10), 5, 45), (datetime(2024, 1, 1, 0, 10), -4, 0), (datetime(2024, 1, 1), None, None)],
        "timestamp timestamp_ntz, h int, m int",
    ).select("timestamp", F.struct(F.col("h").alias("hours"), F.col("m").alias("minutes")).alias("gmt_offset"))
    got = [r[0] for r in df.select(clock.shifted_by_offset()).collect()]
    assert got == [datetime(2024, 1, 1, 5, 55), datetime(2023, 12, 31, 20, 10), None]


def test_zone_shift_knows_daylight_saving(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 1, 12), "Europe/Amsterdam"), (datetime(2024, 7, 1, 12), "Europe/Amsterdam")],
        "timestamp timestamp, timezone string")
    assert [r[0].hour for r in df.select(clock.shifted_by_zone()).collect()] == [13, 14]


def test_hour_bands(spark):
    assert column(spark, [0, 7, 8, 19, 20, 23], "int", clock.in_hour_bands("v", [(20, 23), (0, 7)])) == [
        True, True, False, False, True, True]


VERDICT = "struct<categories: struct<`hate/x`: boolean, hate_x: boolean, sexual: boolean>, flagged: boolean>"


def verdict(flagged, a=False, b=False, c=False):
    return ((a, b, c), flagged)


@pytest.fixture(scope="module")
def judged(spark):
    rows = [
        (1, [verdict(False), verdict(True, True, True), verdict(True, c=True)]),
        (2, [verdict(False), verdict(None)]),
        (3, [verdict(False)]),
        (4, None),
        (5, []),
        (6, [None, verdict(True, c=True)]),
    ]
    return spark.createDataFrame(rows, f"id int, openai_moderation array<{VERDICT}>")


def test_harm_flag_and_index(judged):
    got = judged.select("id", moderation.is_harmful(), moderation.first_flagged_index()).orderBy("id").collect()
    assert [tuple(r) for r in got] == [
        (1, True, 1), (2, None, None), (3, False, None), (4, None, None), (5, False, None), (6, True, 1)]


def test_category_lists(judged):
    keys = moderation.category_keys(judged)
    assert keys == ["hate/x", "hate_x", "sexual"]
    got = judged.select(
        "id", moderation.true_keys_of_all("openai_moderation", keys),
        moderation.true_keys_of_all("openai_moderation", keys, canonical=True)).orderBy("id").collect()
    assert [(list(r[1]), list(r[2])) for r in got] == [
        (["hate/x", "hate_x", "sexual"], ["hate_x", "sexual"]), ([], []), ([], []), ([], []), ([], []),
        (["sexual"], ["sexual"])]
