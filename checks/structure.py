"""Registered queries on the structure of conversations."""
import uuid

from pyspark.sql import functions as F

from parlance.operators.ranking import row_with_first
from parlance.plans import structure as st
from parlance.plans import words
from parlance.sources import (
    combine_corpora, distinct_values, one_per_first_turn, one_per_key, read_corpus, read_lines, row_count, rows_not_in,
    shared_columns, write_csv, write_partitions,
)

from parlance.operators.lineage import shared_folder

from .adapters import CHATS, MESSAGES, VENDORS, chat_log, table, vendor_log
from .base import Check, big, r6, sum_big


def combined(spark, sf):
    return combine_corpora(chat_log(spark, sf), vendor_log(spark, sf))


def document_words(spark, sf):
    lines = table(spark, sf, "documents").select(F.explode(F.split("text", "\n")).alias("value"))
    return words.word_count(lines)


def stored_orders(spark, sf):
    """Orders written in folders by status, one status written again, read back by the library's reader."""
    folder = f"{shared_folder(spark)}/orders-{uuid.uuid4().hex}"
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    write_partitions(orders, folder, ["o_orderstatus"], rows_per_file=5000)
    write_partitions(orders.filter("o_orderstatus = 'F'").withColumn("o_totalprice", F.col("o_totalprice") + 1), folder, ["o_orderstatus"])
    return read_corpus(spark, folder).groupBy("o_orderstatus").agg(
        F.count("*").alias("orders"), F.round(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double"), 2).alias("total"))


def stored_words(spark, sf):
    """Customers written as CSV and read back as lines: the lines that name each segment."""
    folder = f"{shared_folder(spark)}/customers-{uuid.uuid4().hex}"
    write_csv(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), folder)
    lines = read_lines(spark, folder).select(F.substring_index("value", ",", -1).alias("word"))
    return lines.filter("word <> 'c_mktsegment'").groupBy("word").count()


def repeated_ids(spark, sf):
    messages = table(spark, sf, "conversations")
    return st.duplicate_ids(messages, "conv_id").select("conv_id", big("count"))


def combined_corpus(spark, sf):
    both = combined(spark, sf)
    return both.groupBy("model").agg(
        F.count("conversation_identifier").alias("conversations"),
        F.count("timestamp").alias("dated"),
        F.sum(F.size("conversation.content")).cast("long").alias("messages"),
        F.sum(F.size(F.filter(
            F.col("openai_moderation.categories"), lambda c: c["hate/threatening"]))).cast("long").alias("hate_threatening"))


def shared_columns_corpus(spark, sf):
    both = shared_columns(chat_log(spark, sf), vendor_log(spark, sf))
    return both.groupBy("language", "turn").agg(F.count("*").alias("conversations")).select(
        "language", big("turn"), "conversations")


def turns(spark, sf):
    return st.turns_per_conversation(combined(spark, sf)).select(
        "conversation_identifier", big("num_turns"))


def turn_histogram(spark, sf):
    per = st.turns_per_conversation(table(spark, sf, "conversations"), "conv_id", "turn")
    return st.turn_histogram(spark, per, 30).select(
        big("bin"), r6("low"), r6("high"), big("count"))


def durations(spark, sf):
    spans = st.conversation_spans(combined(spark, sf))
    return st.conversation_durations(spans).select("conversation_identifier", big("duration"))


def missing_durations(spark, sf):
    return st.missing_duration_share(st.conversation_spans(combined(spark, sf))).select(r6("proportion"))


def user_length(spark, sf):
    return st.user_length_by_turn(combined(spark, sf)).select(big("turn_number"), r6("avg_content_length"))


def user_length_flat(spark, sf):
    out = st.length_by_turn_flat(table(spark, sf, "conversations"), "user", "conv_id", "turn", "text")
    return out.select(big("turn_number"), r6("avg_content_length"))


def assistant_length(spark, sf):
    return st.assistant_length_by_turn(combined(spark, sf)).select(
        big("turn_number"), "model", r6("avg_content_length"))


def assistant_length_position(spark, sf):
    return st.assistant_length_by_position(vendor_log(spark, sf)).select(
        big("turn_number"), "model", r6("avg_content_length"))


def models(spark, sf):
    return st.model_count(combined(spark, sf))


def toxicity_index(spark, sf):
    # Copies of one text share an identifier here, so indices above 1 occur.
    chats = chat_log(spark, sf).withColumn(
        "conversation_hash", F.md5(F.concat_ws("\n", F.col("conversation.content"))))
    return st.toxicity_by_turn_index(chats).select(big("turn_index"), r6("avg_toxicity"))


def toxicity_position(spark, sf):
    return st.toxicity_by_position(chat_log(spark, sf)).select(big("turn_index"), r6("avg_toxicity"))


def long_conversations(spark, sf):
    return row_count(st.conversations_longer_than(chat_log(spark, sf), 2))


def without_copies(spark, sf):
    texts = table(spark, sf, "documents").select(F.md5("text").alias("digest"), "lang")
    return one_per_key(texts, ["digest"])


def first_turns(spark, sf):
    # Every conversation twice, so that there are copies to remove.
    log = chat_log(spark, sf)
    return row_count(one_per_first_turn(log.union(log)))


def user_only_lines(spark, sf):
    lines = chat_log(spark, sf).select(F.explode(F.arrays_zip(
        F.col("conversation.role").alias("role"), F.col("conversation.content").alias("content"))).alias("m"))
    digests = lines.select("m.role", F.md5("m.content").alias("digest"))
    return rows_not_in(
        digests.filter("role = 'user'").select("digest"), digests.filter("role = 'assistant'").select("digest"))


def known_pairs(spark, sf):
    return distinct_values(chat_log(spark, sf), "model", "language")


def largest(spark, sf):
    return st.largest_turn(combined(spark, sf)).select(big("max_turn"))


def some_long_conversation(spark, sf):
    return row_with_first(chat_log(spark, sf), F.size("conversation.role") > 2).select(
        (F.size("conversation.role") > 2).alias("is_long"))


_BOTH = f"""{MESSAGES}, {VENDORS}, both_msgs AS (
  SELECT conversation_hash AS cid, model, role, line, pos FROM msgs
  UNION ALL SELECT conversation_id, model, role, line, pos FROM vendor_msgs)"""
_BY_ROLE = """SELECT CAST(n AS BIGINT) AS turn_number{key}, round(avg(length(line)), 6) AS avg_content_length
FROM (SELECT *, row_number() OVER (PARTITION BY cid ORDER BY pos) AS n FROM {src} WHERE role = '{role}')
WHERE n <= 215 GROUP BY ALL"""
_SPANS = f"""WITH {MESSAGES}, spans AS (
  SELECT conversation_hash, min(mts) AS a, max(mts) AS b, count(*) AS n FROM msgs GROUP BY 1)"""

CHECKS = {
    "stored_orders": Check(stored_orders, """
SELECT o_orderstatus, count(*) AS orders, round(CAST(sum(CAST(o_totalprice + CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END
  AS DECIMAL(18, 2))) AS DOUBLE), 2) AS total FROM orders GROUP BY 1"""),
    "stored_words": Check(stored_words, "SELECT c_mktsegment AS word, count(*) AS count FROM customer GROUP BY 1"),
    "word_count": Check(document_words, """
SELECT word, count(*) AS count FROM (SELECT unnest(string_split(line, ' ')) AS word FROM
  (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)) GROUP BY word"""),
    "one_per_key": Check(without_copies, "SELECT md5(text) AS digest, any_value(lang) AS lang FROM documents GROUP BY 1"),
    "one_per_first_turn": Check(first_turns, "SELECT count(*) AS rows FROM documents"),
    "rows_not_in": Check(user_only_lines, f"""
WITH {MESSAGES} SELECT md5(line) AS digest FROM msgs WHERE role = 'user'
EXCEPT SELECT md5(line) FROM msgs WHERE role = 'assistant'"""),
    "distinct_values": Check(known_pairs, f"WITH {CHATS} SELECT DISTINCT model, language FROM chats"),
    "largest_turn": Check(largest, f"""
WITH {CHATS}, {VENDORS} SELECT max(turn) AS max_turn FROM
  (SELECT turn FROM chats UNION ALL SELECT turn FROM vendors)"""),
    "row_with_first": Check(some_long_conversation, f"""
WITH {CHATS} SELECT true AS is_long FROM chats WHERE len(lines) > 2 LIMIT 1"""),
    "duplicate_ids": Check(repeated_ids, """
SELECT conv_id, count(*) AS count FROM conversations GROUP BY conv_id HAVING count(*) > 1"""),
    "combined_corpus": Check(combined_corpus, f"""
WITH {CHATS}, {VENDORS}
SELECT model, count(*) AS conversations, count(*) AS dated, {sum_big('len(lines)')} AS messages,
  CAST(0 AS BIGINT) AS hate_threatening FROM chats GROUP BY model
UNION ALL
SELECT v.model, count(*), CAST(0 AS BIGINT), {sum_big('len(lines)')},
  {sum_big("len(list_filter(lines, lambda x: contains(x, 'div')))")}
FROM vendors v GROUP BY v.model"""),
    "shared_columns": Check(shared_columns_corpus, f"""
WITH {CHATS}, {VENDORS}
SELECT language, turn, count(*) AS conversations FROM
  (SELECT language, turn FROM chats UNION ALL SELECT language, turn FROM vendors) GROUP BY ALL"""),
    "turns_per_conversation": Check(turns, f"""
WITH {CHATS}, {VENDORS}
SELECT conversation_hash AS conversation_identifier, turn AS num_turns FROM chats
UNION ALL SELECT conversation_id, turn FROM vendors"""),
    "turn_histogram": Check(turn_histogram, """
WITH t AS (SELECT conv_id, CAST(max(turn) AS DOUBLE) AS v FROM conversations GROUP BY 1),
r AS (SELECT min(v) AS lo, max(v) AS hi FROM t),
b AS (SELECT CAST(least(floor((v - lo) / (hi - lo) * 30), 29) AS BIGINT) AS bin, count(*) AS n FROM t, r GROUP BY 1)
SELECT g.bin, round(lo + g.bin * (hi - lo) / 30, 6) AS low, round(lo + (g.bin + 1) * (hi - lo) / 30, 6) AS high,
  COALESCE(n, 0) AS count
FROM (SELECT unnest(range(30)) AS bin) g CROSS JOIN r LEFT JOIN b ON g.bin = b.bin"""),
    "conversation_duration": Check(durations, f"""{_SPANS}
SELECT conversation_hash AS conversation_identifier, CAST(epoch(b) - epoch(a) AS BIGINT) AS duration
FROM spans WHERE a IS NOT NULL"""),
    "missing_duration_share": Check(missing_durations, f"""{_SPANS}, {VENDORS}
SELECT round(CAST(sum(n) FILTER (a IS NULL) AS DOUBLE) / sum(n), 6) AS proportion FROM
  (SELECT a, n FROM spans UNION ALL SELECT CAST(NULL AS TIMESTAMP), len(lines) FROM vendors)"""),
    "user_length_by_turn": Check(user_length, f"WITH {_BOTH} {_BY_ROLE.format(key='', src='both_msgs', role='user')}"),
    "user_length_by_turn_flat": Check(
        user_length_flat, "WITH m AS (SELECT conv_id AS cid, turn AS pos, role, text AS line FROM conversations) "
        + _BY_ROLE.format(key="", src="m", role="user")),
    "assistant_length_by_turn": Check(
        assistant_length, f"WITH {_BOTH} {_BY_ROLE.format(key=', model', src='both_msgs', role='assistant')}"),
    "assistant_length_by_position": Check(assistant_length_position, f"""
WITH {VENDORS} SELECT CAST(pos AS BIGINT) AS turn_number, model, round(avg(length(line)), 6) AS avg_content_length
FROM vendor_msgs WHERE role = 'assistant' AND pos <= 215 GROUP BY ALL"""),
    "model_count": Check(models, f"""
WITH {CHATS}, {VENDORS} SELECT count(DISTINCT model) AS models FROM
  (SELECT model FROM chats UNION ALL SELECT model FROM vendors)"""),
    "toxicity_by_turn_index": Check(toxicity_index, f"""
WITH {CHATS}, n AS (
  SELECT row_number() OVER (PARTITION BY md5(text) ORDER BY turn) AS i, length(lines[1]) / 1000 AS s FROM chats)
SELECT CAST(i AS BIGINT) AS turn_index, round(avg(s), 6) AS avg_toxicity FROM n GROUP BY i"""),
    "toxicity_by_position": Check(toxicity_position, f"""
WITH {MESSAGES} SELECT CAST(pos + 1 AS BIGINT) AS turn_index, round(avg(length(line) / 1000), 6) AS avg_toxicity
FROM msgs GROUP BY pos"""),
    "conversations_longer_than": Check(long_conversations, f"""
WITH {CHATS} SELECT count(*) AS rows FROM chats WHERE len(lines) > 2"""),
}
