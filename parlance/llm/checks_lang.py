"""Registered query of language identification."""
from . import langid
from .checks_text import table


def language_centroids(spark, sf):
    """Language of every whole document, learnt from the rows that are not held out."""
    docs = table(spark, sf, "documents")
    return langid.identified(docs, langid.fit(docs))


# Clustering has no SQL; tests measure held-out accuracy.
CHECKS = {"op12_language_centroids": (language_centroids, None)}
