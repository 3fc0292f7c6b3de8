"""Registered query of near-duplicate detection."""
from pyspark.sql import functions as F

from .checks_text import table
from .neardup import near_duplicates


def minhash_near_dedup(spark, sf):
    """Groups of near-duplicate documents: three-word shingles, similarity 0.85."""
    groups = near_duplicates(table(spark, sf, "documents"), width=3, percent=85)
    return groups.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


# All pairs that share a shingle: right, but only for small tables.
NEAR_SQL = """
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i:i + 2], ' ') for i in range(1, len(w) - 1)] END)) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * k >= 85 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l)
"""

CHECKS = {"op2_minhash_near_dedup": (minhash_near_dedup, f"""WITH RECURSIVE {NEAR_SQL.strip().removeprefix("WITH ")},
r(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM c LEFT JOIN n USING (doc_id)""")}
