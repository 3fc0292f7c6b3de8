"""Registered queries of the operators on single texts."""
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, pii, quality, toxicity, urls, wrappers


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def quality_rules(spark, sf):
    """Ledger of all rules over whole documents, with the verdict of policy v1."""
    book = quality.ledger(table(spark, sf, "documents"))
    base_failed = ~quality.verdict("base")
    return book.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "failed",
        base_failed.alias("base_failed"), (~base_failed & quality.verdict("v1")).alias("kept"))


QUALITY_CTE = """
q0 AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
q1 AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w,
  list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS l FROM q0),
q2 AS (SELECT rid, i, list_slice(w, i, i + 2) AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM q1)),
q3 AS (SELECT rid, i FROM q2 QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
q4 AS (SELECT rid, count(DISTINCT p) AS n_repeat_words FROM (
  SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM q3) GROUP BY rid),
q5 AS (SELECT rid, doc_id, CAST(len(w) AS BIGINT) AS n_words,
  CAST(length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
  CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
  CAST(len(l) AS BIGINT) AS n_lines,
  CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
  coalesce(n_repeat_words, 0) AS n_repeat_words,
  len(regexp_extract_all(t, '[A-Za-z\\x{00C0}-\\x{10FFFF}]')) AS n_letters,
  len(regexp_extract_all(t, '!')) AS n_marks,
  len(list_filter(w, lambda x: regexp_matches(x, '[A-Z].*[A-Z]') AND NOT regexp_matches(x, '[a-z]'))) AS n_capitals
  FROM q1 LEFT JOIN q4 USING (rid)),
ledger AS (SELECT *, """ + " | ".join(
    f"(CASE WHEN {r.fails} THEN {1 << i} ELSE 0 END)" for i, r in enumerate(quality.RULES)) + " AS failed FROM q5)"

QUALITY_SQL = f"""WITH {QUALITY_CTE}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, CAST(failed AS BIGINT) AS failed,
  failed & {quality.policy_mask("base")} <> 0 AS base_failed, failed & {quality.policy_mask("v1")} = 0 AS kept
FROM ledger"""

KEY = "pseudonym key of this corpus"


def pii_pseudonyms(spark, sf):
    """Whole documents with personal data replaced by pseudonyms of the same format."""
    out = pii.pseudonymised(table(spark, sf, "documents").select("doc_id", "text"), KEY)
    return out.select("doc_id", "text", F.col("pii_.found").alias("found"), F.col("pii_.changed").alias("changed"))


def toxicity_scores(spark, sf):
    """Toxicity of whole documents, learnt from labels outside the held-out fifth."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return toxicity.scored(docs, toxicity.fit(docs, table(spark, sf, "labels")))


def list_entries(captures):
    """Four dated lists over the hosts of the captures: hosts, paths, domains and adverts."""
    hosts = captures.select(urls.host_of(F.col("url")).alias("h")).filter("h <> ''").distinct()
    hosts = hosts.withColumn("a", F.conv(F.substring(F.md5("h"), 1, 4), 16, 10).cast("int"))
    entry = lambda name, pattern, action, since: F.struct(
        F.lit(name).alias("list"), F.expr(pattern).alias("pattern"), F.lit(action).alias("action"), F.expr(since).alias("since"))
    day = "date_add(DATE'2023-01-01', {})".format
    every = [
        ("a % 3 = 0", entry("hosts", "h", "block", day("a % 200"))),
        ("a % 3 = 0", entry("hosts", "h", "remove", day("a % 200 + 90 + a % 60"))),
        ("a % 6 = 0", entry("hosts", "h", "block", day("a % 200 + 300"))),
        ("a % 2 = 0", entry("paths", "concat(h, '/de')", "block", day("59 + a % 100"))),
        ("a % 2 = 0", entry("paths", "concat(h, '/de')", "allow", day("259 + a % 100"))),
        ("a % 5 = 1", entry("domains", "substring_index(h, '.', -3)", "allow", day("150 + a % 50"))),
        ("h LIKE '%ads-track%'", entry("adverts", "h", "block", day("-31"))),
    ]
    picked = F.filter(F.array(*[F.when(F.expr(c), e) for c, e in every]), lambda e: e.isNotNull())
    return hosts.select(F.explode(picked).alias("e")).select("e.*").distinct()


def url_filters(spark, sf):
    """Every page against dated lists, as of the day it was fetched."""
    captures = table(spark, sf, "pages").select(
        "page_id", "url", F.expr("date_add(DATE'2023-01-01', CAST(page_id * 37 % 700 AS INT))").alias("fetched_at"))
    out = urls.filtered(captures, list_entries(captures))
    return out.select("page_id", "url", F.col("fetched_at").cast("string").alias("fetched_at"), "verdict", "list", "pattern",
                      F.col("since").cast("string").alias("since"))


URL_SQL = """
WITH c AS (SELECT page_id, url, DATE '2023-01-01' + CAST(page_id * 37 % 700 AS INT) AS day,
  lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]*)', 1)) AS h,
  trim(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/') AS path FROM pages),
hosts AS (SELECT DISTINCT h, CAST('0x' || substr(md5(h), 1, 4) AS INT) AS a FROM c),
e AS (
  SELECT 'hosts' AS list, h AS pattern, 'block' AS action, DATE '2023-01-01' + a % 200 AS since FROM hosts WHERE a % 3 = 0
  UNION SELECT 'hosts', h, 'remove', DATE '2023-01-01' + (a % 200 + 90 + a % 60) FROM hosts WHERE a % 3 = 0
  UNION SELECT 'hosts', h, 'block', DATE '2023-01-01' + (a % 200 + 300) FROM hosts WHERE a % 6 = 0
  UNION SELECT 'paths', h || '/de', 'block', DATE '2023-01-01' + (59 + a % 100) FROM hosts WHERE a % 2 = 0
  UNION SELECT 'paths', h || '/de', 'allow', DATE '2023-01-01' + (259 + a % 100) FROM hosts WHERE a % 2 = 0
  UNION SELECT 'domains', array_to_string((string_split(h, '.'))[-3:], '.'), 'allow',
    DATE '2023-01-01' + (150 + a % 50) FROM hosts WHERE a % 5 = 1
  UNION SELECT 'adverts', h, 'block', DATE '2022-12-01' FROM hosts WHERE h LIKE '%ads-track%'),
v AS (SELECT *, lead(since) OVER (PARTITION BY list, pattern ORDER BY since) AS until FROM (
  SELECT DISTINCT list, pattern, since, action FROM e)),
p AS (
  SELECT page_id, day, array_to_string(l[i:], '.') AS pattern, (len(l) - i + 1) * 1000000 AS rank
  FROM (SELECT page_id, day, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT *, string_split(h, '.') AS l FROM c))
  UNION ALL SELECT page_id, day, h || '/' || array_to_string(s[:i], '/'), n * 1000000 + i
  FROM (SELECT page_id, day, h, s, n, unnest(range(1, len(s) + 1)) AS i FROM (
    SELECT *, string_split(path, '/') AS s, len(string_split(h, '.')) AS n FROM c))),
hit AS (SELECT page_id, v.* FROM p JOIN v ON p.pattern = v.pattern AND action <> 'remove' AND since <= day AND (until IS NULL OR day < until)
  QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY rank DESC, action = 'block' DESC, list DESC) = 1)
SELECT page_id, url, CAST(day AS VARCHAR) AS fetched_at, coalesce(action, 'none') AS verdict, list, pattern,
  CAST(since AS VARCHAR) AS since FROM c LEFT JOIN hit USING (page_id)"""

def html_main_text(spark, sf):
    """Main text of every page."""
    return wrappers.extracted(table(spark, sf, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))


def chat_repair(spark, sf):
    """Every conversation repaired to legal turns and rendered."""
    return chat.formatted(table(spark, sf, "conversations"))


CHECKS = {"op10_chat_repair": (chat_repair, None), "op5_html_main_text": (html_main_text, None), "op3_url_filters": (url_filters, URL_SQL), "op4_toxicity_scores": (toxicity_scores, None), "op1_pii_pseudonyms": (pii_pseudonyms, None), "op8_quality_rules": (quality_rules, QUALITY_SQL)}
