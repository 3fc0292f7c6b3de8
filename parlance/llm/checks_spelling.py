"""Registered query of spelling variants."""
from pyspark.sql import functions as F

from .checks_runs import crc32_sql
from .checks_text import table
from .spelling import counted, letter_runs, variants

LEAST, OFTEN, EVERY, TIMES = 7, 2, 31, 10


def spelled(docs):
    """Every run of letters of whole texts; one in 31 by crc32 has lost a code point."""
    runs = docs.select("doc_id", F.explode(letter_runs("text", LEAST)).alias("run"))
    runs = runs.withColumn("h", F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("run")).cast("binary")))
    cut = "concat(substring(run, 1, CAST(h % char_length(run) AS INT)), substring(run, CAST(h % char_length(run) AS INT) + 2))"
    return runs.select(F.expr(f"CASE WHEN h % {EVERY} = 0 THEN {cut} ELSE run END").alias("word"))


def spelling_variants(spark, sf):
    """Every frequent long word of the documents with its near words and its usual form."""
    return variants(counted(spelled(table(spark, sf, "documents")), LEAST, OFTEN), TIMES)


BYTES = ("flatten(list_transform(string_split(concat(CAST(doc_id AS VARCHAR), ':', r), ''), "
         "lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)] ELSE [195, unicode(x) - 64] END))")

# Words that agree when one code point is left out of either or of one of them.
SPELLING_SQL = f"""
WITH RECURSIVE t AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{{00C0}}-\\x{{00FF}}]+')) AS r FROM documents),
c AS (SELECT doc_id, r, count(*) AS k FROM t WHERE length(r) >= {LEAST} GROUP BY ALL),
h AS (SELECT r, k, {crc32_sql(BYTES)} AS h FROM c),
v AS (SELECT CASE WHEN h % {EVERY} = 0 THEN r[1:h % length(r)] || r[h % length(r) + 2:] ELSE r END AS word, k FROM h),
w AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM v WHERE length(word) >= {LEAST} GROUP BY word HAVING sum(k) >= {OFTEN}),
d AS (SELECT word, n, i, word[1:i] || word[i + 2:] AS g FROM (SELECT *, unnest(range(length(word))) AS i FROM w)),
p AS (SELECT a.word, b.word AS near, b.n AS near_n FROM d a JOIN d b ON a.g = b.g AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM d a JOIN w b ON a.g = b.word
  UNION SELECT b.word, a.word, a.n FROM d a JOIN w b ON a.g = b.word),
f AS (SELECT word, count(*) AS n_near, max(near_n) AS top FROM p GROUP BY word),
m AS (SELECT word, min(near) AS form, any_value(top) AS form_n FROM p JOIN f USING (word) JOIN w USING (word)
  WHERE near_n = top AND top >= {TIMES} * n GROUP BY word),
s AS (SELECT word, word AS root, 0 AS steps FROM w UNION ALL SELECT s.word, m.form, steps + 1 FROM s JOIN m ON m.word = s.root),
z AS (SELECT word, arg_max(root, steps) AS root FROM s GROUP BY word)
SELECT word, n, coalesce(n_near, 0) AS n_near, form, CAST(form_n AS BIGINT) AS form_n, root
FROM w LEFT JOIN f USING (word) LEFT JOIN m USING (word) JOIN z USING (word)"""

CHECKS = {"op13_spelling_variants": (spelling_variants, SPELLING_SQL)}
