"""Registered query of periodic runs."""
from pyspark.sql import functions as F

from .checks_text import table
from .periods import collapsed_runs, strongest

WORD = r"[^\x20\x09-\x0D]+"


def planted(docs):
    """Every tenth document by the crc32 of its id has a periodic tail."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    docs = docs.select("doc_id", "text", h.alias("h")).withColumn(
        "w", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), 0)))
    docs = docs.withColumn("n", F.size("w")).withColumn("g", F.expr("h div 10"))
    docs = docs.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    docs = docs.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    tail = "array_join(transform(sequence(0L, n - 1L), i -> w[cast(if(i < a, i, a + (i - a) % p) as int)]), ' ')"
    return docs.select("doc_id", F.expr(f"CASE WHEN a IS NOT NULL THEN {tail} ELSE text END").alias("text"))


def periodic_runs(spark, sf):
    """Runs of every whole document, and the document without what repeats."""
    out = collapsed_runs(planted(table(spark, sf, "documents")))
    line = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, chr(10))), '')")
    best = out.withColumn("best", strongest())
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(line.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def crc32_sql(codes: str) -> str:
    """Unsigned crc32 in DuckDB's SQL of a list of bytes, bit by bit."""
    bits = f"flatten(list_transform({codes}, lambda b: [{', '.join(f'(b >> {k}) & 1' for k in range(8))}]))"
    step = "lambda c, bit: xor(c >> 1, (xor(c, bit) & 1) * 3988292384)"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), CAST({bits} AS BIGINT[])), {step}), 4294967295)"


DIGITS = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: unicode(x))"

# Three equal neighbours at a distance q make a link; runs of links are the stretches of period q.
RUNS_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
  {crc32_sql(DIGITS)} AS h FROM documents),
e AS (SELECT *, len(w) AS n, h // 10 AS g, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM d),
f AS (SELECT *, CASE WHEN a IS NOT NULL THEN 1 + (n - a) // (3 + g % 8) END AS p FROM e),
t AS (SELECT rid, doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_transform(range(n),
  lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) END AS w FROM f),
x AS (SELECT rid, i, list_slice(w, i + 1, i + 3) AS v FROM (SELECT rid, w, unnest(range(n - 2)) AS i FROM t WHERE n >= 24)),
y AS (SELECT b.rid, a.i, b.i - a.i AS q FROM x a JOIN x b ON a.rid = b.rid AND a.v = b.v AND a.i < b.i),
z AS (SELECT rid, q, min(i) AS s, max(i) + 3 + q - min(i) AS l FROM (
  SELECT rid, q, i, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS part FROM y) GROUP BY rid, q, part),
r AS (SELECT rid, s, l, min(q) AS q FROM z WHERE l >= greatest(24, 3 * q) GROUP BY rid, s, l),
k AS (SELECT rid, array_to_string(list(v ORDER BY i), ' ') AS c FROM (
  SELECT rid, i, w[i + 1] AS v FROM (SELECT rid, w, unnest(range(n)) AS i FROM t)) o
  WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.rid = o.rid AND o.i >= r.s + r.q AND o.i < r.s + r.l) GROUP BY rid),
m AS (SELECT rid, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS lines FROM r GROUP BY rid),
b AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY rid ORDER BY l / q DESC, s, q) = 1)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, s AS start, CAST(l AS BIGINT) AS length, CAST(q AS BIGINT) AS period,
  CAST(1000 * l // q AS BIGINT) AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(c, '')) AS collapsed_sha256
FROM t LEFT JOIN m USING (rid) LEFT JOIN b USING (rid) LEFT JOIN k USING (rid)"""

CHECKS = {"op11_periodic_runs": (periodic_runs, RUNS_SQL)}
