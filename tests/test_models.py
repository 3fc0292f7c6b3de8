import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from parlance.plans import classify, harm, topics


@pytest.fixture(scope="module")
def flagged(spark):
    """Messages whose flag shows in their words, some unflagged, some repeated."""
    rng = random.Random(1)
    plain = "the a of we go home today work rain sun tree".split()
    private = "mail phone street number call".split()
    rows = []
    for i in range(400):
        flag = i % 4 == 0
        words = rng.choices(plain, k=8) + (rng.choices(private, k=4) if flag else []) + [f"w{i}"]
        rng.shuffle(words)
        rows.append((" ".join(words), flag))
    rows += rows[:40] + [("nobody knows", None)]
    return spark.createDataFrame(rows, "content string, redacted boolean")


def test_draw_is_disjoint_and_balanced(flagged):
    drawn = classify.draw_messages(flagged, train=60, test=20).collect()
    train = {r.content for r in drawn if r.part == "train"}
    test = {r.content for r in drawn if r.part == "test"}
    assert not train & test and len(train) == 120 and len(test) == 40
    assert sum(r.label for r in drawn) == 80


def test_flag_classifier_learns(flagged):
    drawn = classify.draw_messages(flagged, train=60, test=20)
    fitted = classify.fit_flag_classifier(drawn)
    m = fitted.metrics().first()
    assert m.rows == 40 and m.accuracy > 0.8 and m.weighted_precision > 0.8
    assert 0.8 < fitted.area_under_roc() <= 1.0
    scaled = classify.fit_flag_classifier(drawn, use_scaled=True, without_stop_words=True)
    assert scaled.metrics().first().accuracy > 0.7


def test_tuning_reports_a_grid_point(flagged):
    drawn = classify.draw_messages(flagged, train=60, test=20)
    fitted = classify.tune_flag_classifier(drawn, (10,), (0.01, 1.0), (0.0,), folds=2)
    best = classify.best_parameters(fitted)
    assert best["maxIter"] == 10 and best["regParam"] in (0.01, 1.0)
    assert fitted.area_under_roc() > 0.8


def test_metrics_against_a_known_table(spark):
    rows = [(1, 1)] * 6 + [(1, 0)] * 2 + [(0, 1)] * 1 + [(0, 0)] * 11
    df = spark.createDataFrame([(float(a), float(b)) for a, b in rows], "label double, prediction double")
    m = classify.classification_metrics(df).first()
    assert m.rows == 20 and m.accuracy == pytest.approx(17 / 20) and m.weighted_recall == pytest.approx(17 / 20)
    assert m.weighted_precision == pytest.approx((8 * 6 / 7 + 12 * 11 / 13) / 20)


def test_label_classifiers(spark):
    rng = random.Random(4)
    rows = []
    for i in range(300):
        hate, toxic = i % 3 == 0, i % 2 == 0
        words = rng.choices("red blue green".split(), k=5) + (["awful", "nasty"] * 3 if hate else ["kind", "nice"] * 3)
        rows.append((i, " ".join(words), toxic, int(hate)))
    messages = spark.createDataFrame(rows, "id int, content string, toxic boolean, hate int")
    for name in harm.MESSAGE_LABELS:
        if name != "hate":
            messages = messages.withColumn(name, F.lit(0))
    drawn = classify.draw_labelled_messages(messages, ["id"], per_label=80)
    assert {r.drawn_for: r["count"] for r in drawn.groupBy("drawn_for").count().collect()} == {"not_toxic": 80, "hate": 80}
    embedded = classify.embed_messages(drawn, ["id"], fraction=1.0, size=8, min_count=2)
    assert {r.part for r in embedded.select("part").distinct().collect()} == {"train", "validation", "test"}
    got = classify.fit_label_classifiers(embedded, lambda w: classify.network(w, (6,), 60)).collect()
    assert [r.label_name for r in got] == ["hate"] and got[0].accuracy > 0.8


def test_topics(spark):
    texts = ["cat dog cat bird, dog!"] * 10 + ["stock bond market. stock price"] * 10
    df = spark.createDataFrame([(i, t, "English") for i, t in enumerate(texts)], "id int, full_text string, language string")
    model = topics.fit_topics(spark, df, topics=2, iterations=15)
    documents = model.documents().withColumn("w", vector_to_array("topicDistribution")).collect()
    assert all(sum(r.w) == pytest.approx(1) for r in documents)
    assert len({r.dominant_topic for r in documents[:10]}) == 1
    terms = model.terms(3).collect()
    assert {(r.topic, r["rank"]) for r in terms} == {(t, n) for t in (0, 1) for n in (1, 2, 3)}
    assert set(model.metrics()) == {"log_perplexity", "log_likelihood"}
    again = topics.fit_topics(spark, df, topics=2, iterations=15)
    assert [tuple(r) for r in again.terms(3).collect()] == [tuple(r) for r in terms]


def test_topic_metrics_are_the_models_own_whatever_the_partitions(spark):
    texts = ["cat dog cat bird, dog!"] * 10 + ["stock bond market. stock price"] * 10 + ["", "unknown"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, full_text string")
    model = topics.fit_topics(spark, df, topics=2, iterations=15)
    found = model.metrics()
    assert found["log_likelihood"] == pytest.approx(model.model.logLikelihood(model.features), rel=1e-3)
    assert found["log_perplexity"] == pytest.approx(model.model.logPerplexity(model.features), rel=1e-3)
    for parts in (1, 5):  # starting values by row number gave other values for other partitions
        moved = topics.TopicModel(spark, model.model, model.vocabulary, model.features.repartition(parts, "id"))
        assert moved.metrics() == pytest.approx(found, rel=1e-12)


def test_topics_keep_words_only_and_drop_the_same_characters(spark, monkeypatch):
    kept, persist = [], DataFrame.persist
    monkeypatch.setattr(DataFrame, "persist", lambda df, *level: (kept.append(df.columns), persist(df, *level))[1])
    df = spark.createDataFrame([(i, "cat dog") for i in range(4)], "id int, full_text string")
    topics.fit_topics(spark, df, topics=2, iterations=1)
    assert kept == [["filtered_words"], ["features"]]
    codes = spark.createDataFrame([("".join(map(chr, range(k, k + 64))),) for k in range(0, 0x3000, 64)], "t string")
    slow = F.regexp_replace("t", r"[^a-zA-Z0-9\s]", "")
    assert codes.filter(slow != F.regexp_replace("t", topics.PUNCTUATION, "")).isEmpty()
    assert not any(k in topics.PUNCTUATION for k in ("a-z", r"\s"))  # those take fifteen times as long


def test_topics_keep_nothing_in_executors_memory(spark, monkeypatch):
    kept, persist = [], DataFrame.persist
    monkeypatch.setattr(DataFrame, "persist", lambda df, *level: (kept.append((df.dtypes, persist(df, *level).storageLevel)), df)[1])
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["cat dog", "Dog cat 7 _x", "", "the", "cat dog"])], "id int, full_text string")
    model = topics.fit_topics(spark, df, topics=2, iterations=1)
    assert [(level.useDisk, level.useMemory, level.useOffHeap) for _, level in kept] == [(True, False, False)] * 2
    assert kept[0][0] == [("filtered_words", "string")]  # a list of words takes over three times the memory
    assert model.vocabulary == ["cat", "dog"]
    counts = [r.features.toArray().tolist() for r in model.features.orderBy("id").collect()]
    assert counts == [[1, 1], [1, 1], [0, 0], [0, 0], [1, 1]]


def test_topic_metrics_take_a_few_texts_at_a_time(spark, monkeypatch):
    texts = [f"cat{' dog' * (i % 3)} bird{' stock' * (i % 2)} market" for i in range(20)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, full_text string")
    model = topics.fit_topics(spark, df, topics=2, iterations=1)
    taken, mapped = [], DataFrame.mapInArrow
    monkeypatch.setattr(DataFrame, "mapInArrow", lambda df, run, *more: (taken.append(run), mapped(df, run, *more))[1])
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    model.metrics()
    assert spark.conf.get(setting) == before
    rng, n, terms = np.random.default_rng(1), 5000, len(model.vocabulary) * 20
    indices, counts = rng.integers(0, len(model.vocabulary), n * terms), rng.integers(1, 9, n * terms).astype(float)
    ends = pa.array(np.arange(n + 1) * terms, pa.int32())
    features = pa.StructArray.from_arrays(
        [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (indices, counts)], ["indices", "values"])
    first = rng.uniform(0.1, 0.9, n)
    shares = pa.ListArray.from_arrays(
        pa.array(np.arange(n + 1) * 2, pa.int32()), pa.array(np.column_stack([first, 1 - first]).ravel()))
    batch = pa.RecordBatch.from_arrays([features, shares], ["features", "shares"])
    tracemalloc.start()
    try:
        found = [out.to_pydict() for out in taken[0]([batch])]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 2 * n * terms * 8  # of all texts at once, the weights of two topics take more
    sizes = np.concatenate([out["terms"] for out in found])
    assert sizes == pytest.approx(counts.reshape(n, terms).sum(axis=1))
    alone = next(taken[0]([batch.slice(n - 1)])).to_pydict()
    assert found[-1]["bound"][-1] == pytest.approx(alone["bound"][0], rel=1e-12)


def test_dominant_topic_takes_the_first_of_equals(spark):
    df = spark.createDataFrame([(Vectors.dense([0.4, 0.4, 0.2]),), (Vectors.dense([0.1, 0.2, 0.7]),)], ["topicDistribution"])
    assert [r[0] for r in df.select(topics.dominant_topic()).collect()] == [0, 2]


def test_full_text_joins_messages(spark):
    df = spark.createDataFrame(
        [("English", [("a", "user"), (None, "assistant"), ("b", "user")]), ("French", [("c", "user")])],
        "language string, conversation array<struct<content:string,role:string>>")
    assert [r.full_text for r in topics.full_texts(df).collect()] == ["a b"]
