"""Conversation logs made from the supplied tables, and the same in SQL.

Each function builds one input of the library from whole tables; the SQL text of the
same name is a list of common table expressions that the oracle queries start with.
"""
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


_opened: dict[tuple, DataFrame] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A supplied table; its footer is read once per application."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _opened:
        _opened[key] = spark.read.parquet(f"{sf}/{name}.parquet")
    return _opened[key]


def mapped(column: Column, pairs: dict, otherwise=None) -> Column:
    out = None
    for k, v in pairs.items():
        out = F.when(column == k, v) if out is None else out.when(column == k, v)
    return out.otherwise(otherwise)


def sql_case(column: str, pairs: dict, otherwise: str = "NULL") -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in pairs.items())
    return f"CASE {column} {whens} ELSE {otherwise} END"


MODEL_OF_EVENT = {
    "click": "gpt-3.5-turbo", "view": "gpt-4", "purchase": "gpt-4-0314",
    "signup": "gpt-3.5-turbo-0613", "error": "other-model",
}
AGENT_OF_SEGMENT = {
    "AUTOMOBILE": "Mozilla/5.0 (iPhone; CPU iPhone OS 17) MOBILE/15E148 Safari",
    "BUILDING": "Mozilla/5.0 (Linux; Android 14) Chrome/120 Mobile Safari",
    "HOUSEHOLD": "Mozilla/5.0 (Windows NT 10.0; Win64; x64)",
    "MACHINERY": "Mozilla/5.0 (X11; Linux x86_64)",
}
LANGUAGE_NAMES = {"en": "English", "fr": "French", "de": "German", "es": "Spanish"}


# --- usage log: one row per event -------------------------------------------------

def usage_log(spark: SparkSession, sf: str) -> DataFrame:
    """Events as conversations of customers; some user agents and states are NULL."""
    e, c, n = (table(spark, sf, t) for t in ("events", "customer", "nation"))
    return (
        e.join(c, e.user_id == c.c_custkey)
        .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("event_id").cast("string").alias("conversation_hash"),
            F.concat(F.lit("u"), "user_id").alias("hashed_ip"),
            F.col("ts").alias("timestamp"),
            mapped(F.col("event_type"), MODEL_OF_EVENT).alias("model"),
            F.get_json_object("props", "$.k").cast("int").alias("turn"),
            F.col("n_name").alias("country"),
            F.nullif("c_mktsegment", F.lit("HOUSEHOLD")).alias("state"),
            F.struct(
                F.concat(F.lit("x-"), "n_regionkey").alias("accept-language"),
                mapped(F.col("c_mktsegment"), AGENT_OF_SEGMENT).alias("user-agent")).alias("header"))
    )


USAGE = f"""usage AS (
  SELECT CAST(e.event_id AS VARCHAR) AS conversation_hash, 'u' || e.user_id AS hashed_ip, e.ts AS ts,
    {sql_case('e.event_type', MODEL_OF_EVENT)} AS model,
    CAST(regexp_extract(e.props, '([0-9]+)', 1) AS BIGINT) AS turn,
    n.n_name AS country, NULLIF(c.c_mktsegment, 'HOUSEHOLD') AS state,
    'x-' || n.n_regionkey AS accept_language,
    {sql_case('c.c_mktsegment', AGENT_OF_SEGMENT)} AS agent,
    CASE WHEN lower({sql_case('c.c_mktsegment', AGENT_OF_SEGMENT)}) LIKE '%mobile%' THEN 'mobile'
      ELSE 'desktop' END AS device_type,
    CASE WHEN {sql_case('e.event_type', MODEL_OF_EVENT)} LIKE 'gpt-3.5%' THEN 'GPT-3.5'
      WHEN {sql_case('e.event_type', MODEL_OF_EVENT)} LIKE 'gpt-4%' THEN 'GPT-4' ELSE 'Other' END AS model_family
  FROM events e JOIN customer c ON e.user_id = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey)"""


# --- order log: several years ------------------------------------------------------

def order_log(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as conversations, over several years."""
    return table(spark, sf, "orders").select(
        F.concat(F.lit("c"), "o_custkey").alias("hashed_ip"),
        F.col("o_orderdate").alias("timestamp"),
        F.floor(F.col("o_totalprice") / 1000).cast("int").alias("turn"),
        mapped(F.col("o_orderstatus"), {"O": "gpt-3.5-turbo", "F": "gpt-4-0314"}, "other-model").alias("model"))


ORDERS = f"""order_log AS (
  SELECT 'c' || o_custkey AS hashed_ip, o_orderdate AS ts, CAST(floor(o_totalprice / 1000) AS BIGINT) AS turn,
    CASE o_orderstatus WHEN 'O' THEN 'GPT-3.5' WHEN 'F' THEN 'GPT-4' ELSE 'Other' END AS model_family
  FROM orders)"""


# --- dimensions --------------------------------------------------------------------

def locations(spark: SparkSession, sf: str) -> DataFrame:
    """Offset per (country, state); one country and one state are spelt differently."""
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    key = F.col("n_nationkey")
    return (
        c.join(n, c.c_nationkey == n.n_nationkey)
        .select(
            F.when(key == 7, "Unlisted").otherwise(F.col("n_name")).alias("ccountry"),
            F.when((key == 3) & (F.col("c_mktsegment") == "MACHINERY"), "Elsewhere")
            .otherwise(F.nullif("c_mktsegment", F.lit("HOUSEHOLD"))).alias("sstate"),
            F.concat(F.lit("Etc/GMT"), F.when(key <= 12, F.lit("+")).otherwise("-"),
                     F.abs(key - 12)).alias("timezone"),
            F.struct(
                (key - 12).alias("hours"),
                F.when(key % 3 == 0, 30).otherwise(0).alias("minutes")).alias("gmt_offset"))
        .distinct()
    )


LOCATIONS = """locs AS (
  SELECT DISTINCT CASE WHEN n_nationkey = 7 THEN 'Unlisted' ELSE n_name END AS ccountry,
    CASE WHEN n_nationkey = 3 AND c_mktsegment = 'MACHINERY' THEN 'Elsewhere'
      ELSE NULLIF(c_mktsegment, 'HOUSEHOLD') END AS sstate,
    n_nationkey - 12 AS hours, CASE WHEN n_nationkey % 3 = 0 THEN 30 ELSE 0 END AS minutes
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def continents(spark: SparkSession, sf: str) -> DataFrame:
    """Continent per country; one country is spelt differently."""
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.when(F.col("n_nationkey") == 11, "Unlisted").otherwise(F.col("n_name")).alias("country"),
        F.col("r_name").alias("continent"))


CONTINENTS = """continents AS (
  SELECT CASE WHEN n_nationkey = 11 THEN 'Unlisted' ELSE n_name END AS country, r_name AS continent
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""


def local_sql(log: str) -> str:
    """CTE ``local``: a log with local time, hour (NULL if unmatched) and weekday from 1."""
    return f"""{LOCATIONS}, shifted AS (
  SELECT g.*, l.ccountry IS NOT NULL AS matched,
    date_trunc('second', g.ts) + to_seconds(CAST(l.hours * 3600 + l.minutes * 60 AS BIGINT)) AS lts
  FROM {log} g LEFT JOIN locs l ON g.country = l.ccountry AND g.state IS NOT DISTINCT FROM l.sstate
  WHERE g.country IS NOT NULL), local AS (
  SELECT *, CAST(hour(lts) AS BIGINT) AS h, CAST(dayofweek(lts) + 1 AS BIGINT) AS d FROM shifted)"""


# --- chat log: nested conversations, one per document ------------------------------

# Words that stand for a moderation category; both spellings of three categories are
# present, as in the real verdicts.
CATEGORY_WORDS = {
    "harassment": "idiot",
    "harassment/threatening": "scum",
    "harassment_threatening": "scum",
    "hate": "worthless",
    "self-harm": "pathetic",
    "self_harm": "pathetic",
    "sexual": "trash",
    "violence": "moron",
    "violence/graphic": "disgusting",
    "violence_graphic": "disgusting",
}
ACCENTS = {"French": "[éèêç]", "German": "[üöäß]", "Spanish": "[óñíá]"}
MODELS = ["gpt-3.5-turbo-0301", "gpt-3.5-turbo-0613", "gpt-4-0314", "gpt-4-1106-preview", "other-model"]


def _lines(text: str) -> Column:
    return F.split(text, "\n")


def _verdict(line: Column) -> Column:
    hits = {k: line.contains(w) for k, w in CATEGORY_WORDS.items()}
    flagged = hits["harassment"]
    for hit in hits.values():
        flagged = flagged | hit
    return F.struct(
        F.struct(*[h.alias(k) for k, h in hits.items()]).alias("categories"),
        F.struct((F.length(line) / 1000).alias("harassment")).alias("category_scores"),
        F.when(line != "", flagged).alias("flagged"))


def chat_log(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as conversations, their lines as messages.

    Conversations of source 3 have no verdicts, those of low quality one verdict too
    few and no message times. The nesting happens inside each row.
    """
    d, lab, n = (table(spark, sf, t) for t in ("documents", "labels", "nation"))
    number = F.substring("source", 4, 9).cast("int")
    started = F.timestamp_add(
        "MINUTE", F.pmod(F.col("doc_id") * 97, F.lit(1051200)), F.lit("2023-04-09 00:07:13").cast("timestamp_ntz"))
    rows = (
        d.join(lab, "doc_id", "left")
        .join(n, F.col("n_chars") % 26 == F.col("n_nationkey"), "left")
        .withColumn("timestamp", started)
    )

    def message(line, i):
        reply = i % 2 == 1
        spoken = F.lit("English")
        for name, letters in reversed(ACCENTS.items()):
            spoken = F.when(line.rlike(letters), name).otherwise(spoken)
        at = F.timestamp_add("SECOND", i * 20, F.col("timestamp")).cast("string")
        return F.struct(
            line.alias("content"),
            F.when(reply, "assistant").when((i == 0) & (F.col("source") == "src7"), "system")
            .otherwise("user").alias("role"),
            spoken.alias("language"),
            line.contains("@").alias("redacted"),
            (line.contains("idiot") | line.contains("trash")).alias("toxic"),
            F.when(reply & (F.coalesce("quality", F.lit(1)) == 1), at).alias("timestamp"),
            (F.col("doc_id") * 100000 + F.floor(i / 2)).alias("turn_identifier"))

    lines = _lines("text")
    verdicts = F.transform(lines, _verdict)
    return rows.select(
        F.col("doc_id").cast("string").alias("conversation_hash"),
        F.concat_ws("-", "source", "lang").alias("hashed_ip"),
        F.element_at(F.array(*[F.lit(m) for m in MODELS]), number % 5 + 1).alias("model"),
        "timestamp",
        F.ceil(F.size(lines) / 2).cast("int").alias("turn"),
        mapped(F.col("lang"), LANGUAGE_NAMES).alias("language"),
        F.col("n_name").alias("country"),
        F.when(F.col("lang") != "en", "BUILDING").alias("state"),
        (F.col("toxic") == 1).alias("toxic"),
        F.struct(
            F.col("lang").alias("accept-language"),
            F.when(F.col("lang") != "fr", F.when(F.col("n_chars") % 4 == 0, "Android Mobile")
                   .otherwise("Windows")).alias("user-agent")).alias("header"),
        F.transform(lines, message).alias("conversation"),
        F.when(F.col("source") != "src3",
               F.when(F.col("quality") == 0, F.slice(verdicts, 1, F.size(lines) - 1))
               .otherwise(verdicts)).alias("openai_moderation"),
        F.transform(lines, lambda x: F.struct((F.length(x) / 1000).alias("toxicity"))).alias("detoxify_moderation"))


_HIT = {k: f"contains(line, '{w}')" for k, w in CATEGORY_WORDS.items()}
CATEGORY_COLUMNS = {k: f"c{i}" for i, k in enumerate(CATEGORY_WORDS)}

CHATS = f"""chats AS (
  SELECT d.doc_id, CAST(d.doc_id AS VARCHAR) AS conversation_hash, d.text, d.source, lab.quality,
    TIMESTAMP '2023-04-09 00:07:13' + to_minutes(CAST((d.doc_id * 97) % 1051200 AS BIGINT)) AS ts,
    ['gpt-3.5-turbo-0301', 'gpt-3.5-turbo-0613', 'gpt-4-0314', 'gpt-4-1106-preview', 'other-model'
    ][CAST(substring(d.source, 4) AS INTEGER) % 5 + 1] AS model,
    CAST(ceil(len(string_split(d.text, chr(10))) / 2) AS BIGINT) AS turn,
    {sql_case('d.lang', LANGUAGE_NAMES)} AS language, n.n_name AS country,
    CASE WHEN d.lang <> 'en' THEN 'BUILDING' END AS state, lab.toxic = 1 AS toxic,
    CASE WHEN d.lang <> 'fr' AND d.n_chars % 4 = 0 THEN 'mobile' ELSE 'desktop' END AS device_type,
    string_split(d.text, chr(10)) AS lines
  FROM documents d LEFT JOIN labels lab ON d.doc_id = lab.doc_id
    LEFT JOIN nation n ON d.n_chars % 26 = n.n_nationkey), families AS (
  SELECT *, CASE WHEN model LIKE 'gpt-3.5%' THEN 'GPT-3.5' WHEN model LIKE 'gpt-4%' THEN 'GPT-4'
      ELSE 'Other' END AS model_family,
    regexp_extract(model, '(gpt-\\d(?:\\.\\d)?)', 1) AS model_tag FROM chats)"""

MESSAGES = f"""{CHATS}, unnested AS (
  SELECT *, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS pos FROM families), msgs AS (
  SELECT *, CASE WHEN pos % 2 = 1 THEN 'assistant' WHEN pos = 0 AND source = 'src7' THEN 'system'
      ELSE 'user' END AS role,
    CASE WHEN regexp_matches(line, '[éèêç]') THEN 'French' WHEN regexp_matches(line, '[üöäß]') THEN 'German'
      WHEN regexp_matches(line, '[óñíá]') THEN 'Spanish' ELSE 'English' END AS spoken,
    contains(line, '@') AS redacted, contains(line, 'idiot') OR contains(line, 'trash') AS rude,
    CASE WHEN pos % 2 = 1 AND COALESCE(quality, 1) = 1 THEN ts + to_seconds(CAST(pos * 20 AS BIGINT)) END AS mts,
    doc_id * 100000 + pos // 2 AS turn_identifier,
    source <> 'src3' AS moderated,
    source <> 'src3' AND NOT (COALESCE(quality, 1) = 0 AND pos = len(lines) - 1) AS judged
  FROM unnested), verdicts AS (
  SELECT *, {', '.join(f"judged AND {_HIT[k]} AS {c}" for k, c in CATEGORY_COLUMNS.items())},
    CASE WHEN judged AND line <> '' THEN {' OR '.join(_HIT.values())} END AS flagged FROM msgs)"""

# Conversations with is_harmful (NULL where unknown) and the first flagged index.
HARM = f"""{MESSAGES}, per_conversation AS (
  SELECT doc_id, bool_or(flagged) AS any_flag, count(*) FILTER (judged AND flagged IS NULL) AS unknown,
    min(pos) FILTER (flagged) AS first_index,
    {', '.join(f"bool_or({c}) AS {c}" for c in CATEGORY_COLUMNS.values())}
  FROM verdicts GROUP BY doc_id), harm AS (
  SELECT f.*, CASE WHEN source = 'src3' THEN NULL WHEN any_flag THEN true
      WHEN unknown > 0 THEN NULL ELSE false END AS is_harmful, first_index,
    {', '.join('p.' + c for c in CATEGORY_COLUMNS.values())}
  FROM families f JOIN per_conversation p ON f.doc_id = p.doc_id)"""


# --- vendor log: the second corpus, fewer fields and category keys ------------------

def vendor_log(spark: SparkSession, sf: str) -> DataFrame:
    """Web pages as conversations, their paragraphs as messages."""
    parts = F.split("html", "<p>")

    def verdict(x):
        return F.struct(
            F.struct(x.contains("the").alias("harassment"), x.contains("div").alias("hate/threatening")).alias("categories"),
            x.contains("div").alias("flagged"))

    return table(spark, sf, "pages").select(
        F.concat(F.lit("p"), "page_id").alias("conversation_id"),
        F.regexp_extract("url", "//([^/]+)", 1).alias("model"),
        F.ceil(F.size(parts) / 2).cast("int").alias("turn"),
        mapped(F.regexp_extract("html", '<html lang="([a-z]+)"', 1), LANGUAGE_NAMES).alias("language"),
        F.transform(parts, lambda x, i: F.struct(
            x.alias("content"), F.when(i % 2 == 1, "assistant").otherwise("user").alias("role"))).alias("conversation"),
        F.transform(parts, verdict).alias("openai_moderation"))


VENDORS = f"""vendors AS (
  SELECT 'p' || page_id AS conversation_id, regexp_extract(url, '//([^/]+)', 1) AS model,
    CAST(ceil(len(string_split(html, '<p>')) / 2) AS BIGINT) AS turn,
    {sql_case("regexp_extract(html, '<html lang=\"([a-z]+)\"', 1)", LANGUAGE_NAMES)} AS language,
    string_split(html, '<p>') AS lines
  FROM pages), vendor_msgs AS (
  SELECT *, CASE WHEN pos % 2 = 1 THEN 'assistant' ELSE 'user' END AS role,
    contains(line, 'div') AS flagged
  FROM (SELECT *, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS pos FROM vendors))"""
