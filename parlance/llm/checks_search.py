"""Registered query of nearest-neighbour search."""
from .checks_text import table
from .neighbours import nearest


def multiprobe_neighbours(spark, sf):
    """The 5 nearest vectors of every 50th vector among all others."""
    return nearest(table(spark, sf, "embeddings"), "vec_id % 50 = 0")


CHECKS = {"op9_multiprobe_neighbours": (multiprobe_neighbours, None)}
