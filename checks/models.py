"""Registered queries that sample rows or fit models; none can be said in SQL."""
from parlance.operators.lineage import settled
from parlance.operators.sampling import bernoulli_sample, hash_split
from parlance.plans import classify as cl
from parlance.plans import harm as hm
from parlance.plans import topics as tp
from pyspark.sql import functions as F

from .adapters import CATEGORY_COLUMNS, LANGUAGE_NAMES, MESSAGES, chat_log, mapped, table
from .base import Check, big, r6


def _texts(spark, sf):
    """Whole document texts with the toxic label as the flag to learn."""
    d, lab = table(spark, sf, "documents"), table(spark, sf, "labels")
    return d.join(lab, "doc_id").select(F.col("text").alias("content"), (F.col("toxic") == 1).alias("redacted"))


def draw_sizes(spark, sf):
    drawn = cl.draw_messages(_texts(spark, sf))
    return drawn.groupBy(big("label"), "part").agg(
        F.count("*").alias("messages"), F.count_distinct("content").alias("contents")).orderBy("label", "part")


def flag_classifier(spark, sf):
    return cl.fit_flag_classifier(cl.draw_messages(_texts(spark, sf))).metrics()


def flag_classifier_scaled(spark, sf):
    drawn = cl.draw_messages(_texts(spark, sf))
    return cl.fit_flag_classifier(drawn, use_scaled=True, without_stop_words=True).metrics()


def tuned_classifier(spark, sf):
    fitted = cl.tune_flag_classifier(cl.draw_messages(_texts(spark, sf)))
    best = cl.best_parameters(fitted)
    return fitted.metrics().select(
        "*", F.lit(fitted.area_under_roc()).alias("area_under_roc"),
        *[F.lit(float(v)).alias(k) for k, v in best.items()])


def _documents(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", F.col("text").alias("full_text"), mapped(F.col("lang"), LANGUAGE_NAMES).alias("language"))


def _topics(spark, sf):
    texts = _documents(spark, sf).filter("language = 'English'")
    return tp.fit_topics(spark, texts)


def topic_terms(spark, sf):
    return _topics(spark, sf).terms(10).select("topic", big("rank"), "term", r6("weight"))


def dominant_topics(spark, sf):
    return _topics(spark, sf).documents().select("doc_id", big("dominant_topic"))


def topic_quality(spark, sf):
    found = _topics(spark, sf).metrics()
    return spark.createDataFrame([tuple(found.values())], ", ".join(f"{k} double" for k in found))


def conversation_texts(spark, sf):
    return tp.full_texts(chat_log(spark, sf)).select("conversation_hash", F.md5("full_text").alias("digest"))


def _embedded(spark, sf):
    """Word vectors of the drawn messages; the draw is small at these scales, so all of it is used."""
    keys = ["conversation_hash", "position"]
    messages = hm.message_table(chat_log(spark, sf), language=None, keep=["conversation_hash"])
    return cl.embed_messages(cl.draw_labelled_messages(messages, keys), keys, fraction=1.0)


def label_classifiers(spark, sf):
    """The linear alternative, one regression per label."""
    return cl.fit_label_classifiers(_embedded(spark, sf), cl.regression, partitions=8)


def label_network(spark, sf):
    """One network of (256, 128) hidden units for all labels."""
    return cl.fit_label_network(settled(_embedded(spark, sf))).metrics()


def labelled_draw(spark, sf):
    keys = ["conversation_hash", "position"]
    messages = hm.message_table(chat_log(spark, sf), language=None, keep=["conversation_hash"])
    return cl.draw_labelled_messages(messages, keys).groupBy("drawn_for").count()


def split_sizes(spark, sf):
    parts = hash_split(table(spark, sf, "documents"), {"train": 0.8, "validation": 0.1, "test": 0.1}, ["doc_id"])
    return parts.groupBy("part").count()


def sampled_languages(spark, sf):
    return bernoulli_sample(table(spark, sf, "documents"), 0.5, ["doc_id"]).groupBy("lang").count()


def _ruled(spark, sf):
    """Documents called toxic for two words, beside their labels, by source."""
    d, lab = table(spark, sf, "documents"), table(spark, sf, "labels")
    said = F.col("text").contains("idiot") | F.col("text").contains("trash")
    return d.join(lab, "doc_id").select("source", F.col("toxic").alias("label"), said.cast("int").alias("prediction"))


def rule_metrics(spark, sf):
    """The classifiers' metrics on predictions that SQL can make as well."""
    return cl.classification_metrics(_ruled(spark, sf), by=["source"]).select(
        "source", "rows", r6("accuracy"), r6("weighted_precision"), r6("weighted_recall"))


def rule_label_metrics(spark, sf):
    """The label metrics on the same predictions."""
    scored = _ruled(spark, sf).withColumnRenamed("source", "label_name")
    return cl.binary_metrics(scored).select("label_name", "rows", r6("accuracy"), r6("precision"), r6("recall"))


_RULED = """ruled AS (SELECT source, toxic AS y, CAST(contains(text, 'idiot') OR contains(text, 'trash') AS INT) AS p
  FROM documents JOIN labels USING (doc_id))"""

_LABELS = " UNION ALL ".join(
    f"SELECT '{name}' AS drawn_for, least(count(*) FILTER ({CATEGORY_COLUMNS[field]}), 1000) AS count FROM verdicts"
    for name, field in hm.MESSAGE_LABELS.items())

CHECKS = {
    "balanced_draw": Check(draw_sizes, """
WITH n AS (SELECT toxic AS label, least(count(DISTINCT text), 6000) AS n
  FROM documents JOIN labels USING (doc_id) GROUP BY toxic), s AS (
  SELECT label, n, least(5000, CAST(floor(n * 5000 / 6000) AS BIGINT)) AS train FROM n), p AS (
  SELECT label, 'train' AS part, train AS messages FROM s UNION ALL SELECT label, 'test', n - train FROM s)
SELECT CAST(label AS BIGINT) AS label, part, messages, messages AS contents FROM p WHERE messages > 0"""),
    "flag_classifier": Check(flag_classifier),
    "flag_classifier_scaled": Check(flag_classifier_scaled),
    "flag_classifier_tuned": Check(tuned_classifier),
    "topic_terms": Check(topic_terms),
    "dominant_topics": Check(dominant_topics),
    "topic_quality": Check(topic_quality),
    "conversation_texts": Check(conversation_texts, """
SELECT CAST(doc_id AS VARCHAR) AS conversation_hash, md5(replace(text, chr(10), ' ')) AS digest
FROM documents WHERE lang = 'en'"""),
    "labelled_draw": Check(labelled_draw, f"""
WITH {MESSAGES}, c AS (
  SELECT 'not_toxic' AS drawn_for, least(count(*) FILTER (NOT rude), 1000) AS count FROM verdicts UNION ALL {_LABELS})
SELECT * FROM c WHERE count > 0"""),
    "label_classifiers": Check(label_classifiers),
    "label_network": Check(label_network),
    "rule_metrics": Check(rule_metrics, f"""
WITH {_RULED}, c AS (SELECT source, k, count(*) FILTER (y = k) AS actual, count(*) FILTER (p = k) AS predicted,
  count(*) FILTER (y = k AND p = k) AS hit FROM ruled, (VALUES (0), (1)) v(k) GROUP BY source, k)
SELECT source, CAST(sum(actual) AS BIGINT) AS rows, round(sum(hit) / sum(actual), 6) AS accuracy,
  round(sum(CASE WHEN predicted = 0 THEN 0 ELSE hit / predicted END * actual) / sum(actual), 6) AS weighted_precision,
  round(sum(hit) / sum(actual), 6) AS weighted_recall FROM c GROUP BY source"""),
    "rule_label_metrics": Check(rule_label_metrics, f"""
WITH {_RULED} SELECT source AS label_name, count(*) AS rows, round(avg(CASE WHEN y = p THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
  round(coalesce(count(*) FILTER (y = 1 AND p = 1) / nullif(count(*) FILTER (p = 1), 0), 0.0), 6) AS precision,
  round(coalesce(count(*) FILTER (y = 1 AND p = 1) / nullif(count(*) FILTER (y = 1), 0), 0.0), 6) AS recall FROM ruled GROUP BY source"""),
    "hash_split": Check(split_sizes),
    "hash_sample": Check(sampled_languages),
}
