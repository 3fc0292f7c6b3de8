"""Connected components of a table of links, by repeated contraction."""
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of a link; ``component`` is the smallest id.

    Each round every node points to the smallest id among itself and its neighbours,
    pointers are followed once, and the links are rewritten to the pointed ids; links
    inside one id vanish. Rounds end when no link is left. Only counts reach the
    driver. Links with a NULL end are ignored; repeated links and loops change nothing;
    an empty table gives an empty one. A hub with most of the links is
    pre-aggregated by the minimum before each shuffle.
    """
    edges = stored(links.select(F.col(a).alias("u"), F.col(b).alias("v"))
                   .filter("u IS NOT NULL AND v IS NOT NULL AND u <> v").distinct())
    members = None
    while not edges.isEmpty():
        both = edges.union(edges.select("v", "u"))
        pointer = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("p"))
        pointer = stored(pointer)
        target = pointer.select(F.col("u").alias("p"), F.col("p").alias("q"))
        moved = stored(pointer.join(target, "p", "left")
                       .select(F.col("u").alias("node"), F.coalesce("q", "p").alias("to")))
        if members is None:
            members = moved.select("node", F.col("to").alias("component"))
        else:
            step = moved.select(F.col("node").alias("component"), "to")
            members = stored(members.join(step, "component", "left")
                             .select("node", F.coalesce("to", "component").alias("component")))
        left = moved.select(F.col("node").alias("u"), F.col("to").alias("nu"))
        right = moved.select(F.col("node").alias("v"), F.col("to").alias("nv"))
        edges = stored(edges.join(left, "u").join(right, "v")
                       .select(F.least("nu", "nv").alias("u"), F.greatest("nu", "nv").alias("v"))
                       .filter("u <> v").distinct())
    if members is None:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members
