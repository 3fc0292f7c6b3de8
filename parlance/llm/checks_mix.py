"""Registered query of mixing sources."""
from pyspark.sql import functions as F

from .checks_text import table
from .mixing import mix


def mixing_sources(spark, sf):
    """Words that the mix takes of every document, sources weighed 1, 2, 3 in turn."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", F.col("mix_.size").alias("size"), F.col("mix_.source_size").alias("source_size"),
                            F.col("mix_.target").alias("target"), F.col("mix_.taken").alias("taken"))


CHECKS = {"op6_mixing_sources": (mixing_sources, None)}
