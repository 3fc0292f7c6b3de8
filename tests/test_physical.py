"""What the plans look like: columns read, joins, number of scans, Python steps."""
import re

import pytest

from checks import all_checks
from checks.adapters import chat_log, locations, usage_log
from parlance.plans import devices, harm, languages, localtime, structure, users

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The chat log as users store it: nested Parquet."""
    folder = str(tmp_path_factory.mktemp("corpus") / "chats")
    chat_log(spark, SF).write.parquet(folder)
    return spark.read.parquet(folder)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df):
    return re.findall(r"ReadSchema: (struct<.*)", plan_of(df).split("Initial Plan")[0])


@pytest.mark.parametrize("analysis, unread", [
    (structure.user_length_by_turn, ["language", "timestamp", "openai_moderation"]),
    (structure.assistant_length_by_position, ["timestamp", "redacted", "openai_moderation"]),
    (languages.message_languages, ["content", "redacted", "openai_moderation"]),
    (languages.switch_table, ["content", "redacted", "openai_moderation"]),
    (harm.turns_by_harm, ["categories", "category_scores", "content"]),
    (lambda df: harm.assistant_harm_by_model(df, True), ["categories", "content", "language"]),
    (harm.categories_by_family, ["category_scores", "content", "language"]),
    (harm.message_table, ["category_scores", "flagged", "turn_identifier"]),
    (lambda df: devices.messages_by_device(devices.with_device(df)), ["content", "openai_moderation"]),
    (structure.toxicity_by_position, ["content", "openai_moderation"]),
    (users.mean_turns_by_model, ["conversation", "openai_moderation"]),
])
def test_only_needed_fields_are_read(stored, analysis, unread):
    read = scans(analysis(stored))
    assert len(read) == 1
    for name in unread:
        assert not re.search(rf"\b{name}\b", read[0]), (name, read[0])


def test_filters_reach_the_scan(spark, stored):
    plan = plan_of(harm.message_table(stored))
    assert "EqualTo(language,English)" in plan
    local = localtime.with_local_time(stored, locations(spark, SF))
    assert "IsNotNull(country)" in plan_of(localtime.hourly_share(local))


RELATIONAL = [
    name for name, check in all_checks().items()
    if check.sql and not name.startswith(("compare_devices", "switch_test", "switch_normality"))]


@pytest.mark.parametrize("name", RELATIONAL)
def test_no_cross_join_and_no_python_step(spark, name):
    plan = plan_of(all_checks()[name].run(spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("analysis, times", [
    (users.conversation_count_histogram, 1),
    (lambda df: users.user_time_gaps(df), 1),
    (lambda df: users.turns_by_class(users.activity_profile(df)), 1),
    (lambda df: devices.turns_by_device(devices.with_device(df)), 1),
])
def test_log_is_scanned_once(spark, analysis, times):
    df = analysis(usage_log(spark, SF))
    df.collect()
    final = plan_of(df).split("== Initial Plan ==")[0]
    assert final.count("events.parquet") <= times


def test_switches_and_harm_count_before_they_move(stored):
    switches = plan_of(languages.switch_table(stored))
    assert switches.count("Exchange") == 1 and "Exchange hashpartitioning(model_tag" in switches
    assert "Window" not in switches and "Join" not in switches
    assert "Expand" not in plan_of(harm.turns_by_harm(stored))
    assert "array_sort" in switches and switches.count("array_sort") == 1  # put in order once a row


def test_large_tables_are_read_once(spark, stored):
    used = devices.with_device(usage_log(spark, SF))
    assert plan_of(devices.large_countries(devices.devices_by_country(used), 5)).count("events.parquet") == 1
    assert len(scans(languages.top_languages_by_country(stored, 3))) <= 2  # both of the stored counts
    assert "conversation" not in scans(languages.top_languages_by_country(stored, 3))[0]
