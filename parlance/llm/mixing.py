"""Mixing sources to target weights by entropy balancing.

Every document gets a rate, the expected number of its copies. Among all rates between
0 and ``CAP`` that give each source its target number of words, entropy balancing takes
those closest to one copy each; they are exponentially tilted in the document's size x:

    rate = CAP * e / (CAP - 1 + e),  e = exp(lambda * x)

``lambda`` solves the convex dual, one equation per source: sum of rate * x = target.
Newton steps are kept inside a bracket and evaluated by Spark over counts per
(source, size), so that a source with a third of all rows is only a longer list of sizes.
Rates are then rounded to copies: the rounding error of a source is carried from size to
size, and which of equally large documents get one copy more is decided by a hash of the
whole row; rows that are equal throughout are numbered, and the first of them take it.
"""
import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import small, stored

CAP = 3
CELL_ROWS = 1000
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: str = "text") -> Column:
    """Number of words of a text; 0 for NULL."""
    return F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORD)), F.lit(0)).cast("long")


def shared_targets(totals: DataFrame, weights=(1, 2, 3), cap: int = CAP) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``.

    Sources in order of code points, NULL last, take the weights in turn and share the
    sum of all sizes. A target stops at ``cap`` times its source's size and the rest is
    shared again by weight until none is above. There is one row per source; the
    reshared level is found by a running sum over sources ordered by how soon they stop.
    """
    names = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((F.row_number().over(names) - 1) % len(weights) + 1).cast("int"))
    weighed = totals.withColumn("weight", weight).withColumn(
        "stops_at", F.lit(float(cap)) * F.col("source_size") / F.col("weight"))
    everything = Window.partitionBy()
    # Water level: with the first k sources stopped, the others share what is left.
    order = Window.orderBy("stops_at", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    left = (F.sum("source_size").over(everything).cast("double")
            - F.coalesce(F.sum(F.lit(float(cap)) * F.col("source_size")).over(before), F.lit(0.0)))
    weights_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    leveled = weighed.withColumn("level", left / weights_left)
    # The level is right at the first source that does not stop below it, and falls after it.
    final = F.max(F.when(F.col("level") <= F.col("stops_at"), F.col("level"))).over(everything)
    return leveled.select(
        "source", "source_size",
        F.least(F.col("weight") * final, F.lit(float(cap)) * F.col("source_size")).alias("target"))


def _rate(lam: Column, x: Column, cap: int) -> Column:
    e = F.exp(-F.greatest(F.least(lam * x, F.lit(600.0)), F.lit(-600.0)))
    return F.lit(float(cap)) / (F.lit(1.0) + F.lit(float(cap - 1)) * e)


def balanced_rates(counts: DataFrame, targets: DataFrame, cap: int = CAP, tolerance: float = 1e-9,
                   rounds: int = 60) -> DataFrame:
    """``(source, size, n, rate)`` that meet every source's target.

    ``counts`` has ``(source, size, n)``. Sizes are scaled by the source's mean. A source
    whose target is its cap has rate ``cap`` throughout. The tilts, one number per source,
    are the only state between Newton steps.
    """
    goal = targets.select(F.col("source").alias("s"), "source_size", "target")
    rows = stored(counts.filter("size > 0").join(goal, F.col("source").eqNullSafe(F.col("s"))).drop("s"))
    scale = rows.groupBy("source").agg(
        F.first("target").alias("target"), F.first("source_size").alias("source_size"),
        (F.sum("n") / F.first("source_size")).alias("per_word"))
    tilts = stored(scale.select(
        F.col("source").alias("s"), "per_word", (F.col("target") >= cap * F.col("source_size")).alias("full"),
        F.lit(0.0).alias("lam"), F.lit(float("-inf")).alias("lo"), F.lit(float("inf")).alias("hi"),
        F.lit(False).alias("done")))
    for _ in range(rounds):
        if tilts.filter("NOT done AND NOT full").isEmpty():
            break
        now = rows.join(tilts, F.col("source").eqNullSafe(F.col("s")))
        x = F.col("size") * F.col("per_word")
        r = _rate(F.col("lam"), x, cap)
        mass = now.groupBy("s").agg(
            F.first("per_word").alias("per_word"), F.first("full").alias("full"), F.first("lam").alias("lam"),
            F.first("lo").alias("lo"), F.first("hi").alias("hi"), F.first("target").alias("target"),
            F.sum(r * F.col("size") * F.col("n")).alias("got"),
            F.sum(r * (1 - r / cap) * x * F.col("size") * F.col("n")).alias("slope"))
        over = F.col("got") > F.col("target")
        lo, hi = F.when(over, F.col("lo")).otherwise(F.col("lam")), F.when(over, F.col("lam")).otherwise(F.col("hi"))
        newton = F.col("lam") - (F.col("got") - F.col("target")) / F.col("slope")
        middle = F.when(F.col("lo") == float("-inf"), F.col("hi") * 2 - 1).when(
            F.col("hi") == float("inf"), F.col("lo") * 2 + 1).otherwise((F.col("lo") + F.col("hi")) / 2)
        done = F.abs(F.col("got") - F.col("target")) <= tolerance * F.col("target")
        tilts = stored(
            mass.withColumn("done", done).withColumn("nlo", lo).withColumn("nhi", hi).drop("lo", "hi")
            .withColumnsRenamed({"nlo": "lo", "nhi": "hi"})
            .withColumn("next", F.when(
                (F.col("slope") > 0) & (newton > F.col("lo")) & (newton < F.col("hi"))
                & (F.abs(newton - F.col("lam")) <= 4), newton).otherwise(middle))
            .select("s", "per_word", "full", F.when(F.col("done"), F.col("lam")).otherwise(F.col("next")).alias("lam"),
                    "lo", "hi", "done"))
    out = rows.join(tilts, F.col("source").eqNullSafe(F.col("s")))
    rate = F.when(F.col("full"), F.lit(float(cap))).otherwise(
        _rate(F.col("lam"), F.col("size") * F.col("per_word"), cap))
    return out.select("source", "size", "n", rate.alias("rate"))


def _whole_copies(rates: DataFrame, cap: int) -> DataFrame:
    """``(source, size, n, rate, base, extra)``: every document of a size gets ``base``
    copies, its rate rounded down, and ``extra`` of them one more. What rounding leaves open
    is carried from large to small sizes, so that a source comes near its target. A group
    holds one row per different size, so it is bounded by the largest size, not by the
    number of documents.
    """
    def carry(pdf):
        pdf = pdf.sort_values("size", ascending=False)
        copies, open_words = [], 0.0
        for size, n, rate in zip(pdf["size"], pdf["n"], pdf["rate"]):
            open_words += size * n * rate
            least = min(math.floor(rate + 1e-9), cap) * n
            c = min(max(round(open_words / size), least), least + n, cap * n)
            open_words -= c * size
            copies.append(c)
        c = pd.Series(copies, index=pdf.index, dtype="int64")
        return pdf.assign(base=c // pdf["n"], extra=c % pdf["n"])

    return rates.groupBy("source").applyInPandas(
        carry, "source string, size long, n long, rate double, base long, extra long")


def _thresholds(light: DataFrame, sizes: DataFrame) -> DataFrame:
    """Adds to each size ``last``, the hash up to which its documents get one copy more, and
    ``tied`` and ``open``: how many rows have just that hash and how many of them get it.

    An order statistic of the hashes: a size's rows are counted in cells of hash ranges,
    about ``CELL_ROWS`` each, and only the cell that holds the wanted place is sorted, with
    one row per different hash.
    """
    key = ["source", "size"]
    wanted = sizes.filter("extra > 0").select(
        F.col("source").alias("s"), F.col("size").alias("z"), "extra", F.ceil(F.col("n") / CELL_ROWS).alias("cells"))
    same = F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z"))
    celled = light.withColumn("u", F.shiftrightunsigned("h", 11)).join(small(wanted), same).withColumn(
        "cell", F.floor(F.col("u") * F.lit(2.0 ** -53) * F.col("cells"))).drop("s", "z")
    counted = celled.groupBy(*key, "cell").agg(F.count("*").alias("m"), F.first("extra").alias("extra"))
    upto = F.sum("m").over(Window.partitionBy(*key).orderBy("cell"))
    place = counted.withColumn("need", F.col("extra") - (upto - F.col("m"))).filter("need > 0 AND need <= m").select(
        F.col("source").alias("s"), F.col("size").alias("z"), F.col("cell").alias("c"), "need")
    hashes = celled.join(place, same & (F.col("cell") == F.col("c"))).groupBy(*key, "cell", "u").agg(
        F.count("*").alias("tied"), F.first("need").alias("need"))
    ranked = hashes.withColumn("open", F.col("need") - F.sum("tied").over(
        Window.partitionBy(*key, "cell").orderBy("u")) + F.col("tied"))
    found = ranked.filter("open > 0 AND open <= tied").select(
        F.col("source").alias("s"), F.col("size").alias("z"), F.col("u").alias("last"), "tied", "open")
    return sizes.join(found, same, "left").drop("s", "z")


def _numbered(tied: DataFrame) -> DataFrame:
    """Adds ``place``, from 1 within each ``(source, size)`` of the rows that share a hash.

    Rows are numbered inside the partitions they are stored in, and partitions are added up,
    so a group of any size is nowhere numbered as a whole.
    """
    key = ["k.source", "k.size"]
    parts = stored(tied.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()))
    counted = parts.groupBy(*key, "part").agg(F.count("*").alias("m"))
    before = F.sum("m").over(Window.partitionBy("source", "size").orderBy("part")) - F.col("m")
    starts = counted.select(F.col("source").alias("s"), F.col("size").alias("z"), F.col("part").alias("b"),
                            before.alias("before"))
    inside = F.row_number().over(Window.partitionBy(*key, "part").orderBy("at"))
    same = (F.col("k.source").eqNullSafe(F.col("s")) & (F.col("k.size") == F.col("z")) & (F.col("part") == F.col("b")))
    return parts.withColumn("inside", inside).join(starts, same).withColumn(
        "place", F.col("before") + F.col("inside")).drop("part", "at", "inside", "before", "s", "z", "b")


def _mix(df: DataFrame, id_col: str, source: str, text: str, weights, cap: int, seed: int) -> DataFrame:
    """``(row, mix)``: every row of ``df`` and its part of the mix, see ``mix``."""
    # Maps and variants cannot be hashed; rows that differ in them only count as equal.
    hashed = [F.col(f"`{f.name}`") for f in df.schema
              if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
    key = F.struct(
        F.col(f"`{source}`").cast("string").alias("source"), n_words(text).alias("size"),
        F.xxhash64(F.lit(seed), F.col(f"`{id_col}`"), *hashed).alias("h"))
    light = stored(df.select(key.alias("k")).select("k.*"))
    counts = stored(light.groupBy("source", "size").agg(F.count("*").alias("n")))
    totals = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = stored(shared_targets(totals, weights, cap))
    sizes = stored(_whole_copies(balanced_rates(counts, targets, cap), cap))
    plan = _thresholds(light, sizes)
    goal = targets.select(F.col("source").alias("g"), "source_size", "target")
    none = F.lit(None).cast("long")
    nothing = counts.filter("size = 0").select(
        "source", "size", F.lit(0.0).alias("rate"), F.lit(0).cast("long").alias("base"), none.alias("last"),
        none.alias("tied"), none.alias("open"))
    plan = stored(plan.select("source", "size", "rate", "base", "last", "tied", "open").union(nothing)
                  .join(goal, F.col("source").eqNullSafe(F.col("g"))).select(
        F.col("source").alias("p_source"), F.col("size").alias("p_size"), "rate", "base", "last", "tied", "open",
        "source_size", "target"))
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), key.alias("k"))
    planned = rows.join(small(plan), F.col("k.source").eqNullSafe(F.col("p_source")) & (F.col("k.size") == F.col("p_size")))
    u = F.shiftrightunsigned("k.h", 11)

    def with_copies(some, more):
        copies = (F.col("base") + F.when(more, 1).otherwise(0)).cast("long")
        return some.select("row", F.struct(
            F.col("k.size").alias("size"), "source_size", "target", "rate", copies.alias("copies"),
            (copies * F.col("k.size")).alias("taken")).alias("mix"))

    if plan.filter("open < tied").isEmpty():
        return with_copies(planned, u <= F.col("last"))
    shared = F.coalesce((u == F.col("last")) & (F.col("open") < F.col("tied")), F.lit(False))
    return with_copies(planned.filter(~shared), u <= F.col("last")).union(
        with_copies(_numbered(planned.filter(shared)), F.col("place") <= F.col("open")))


def mix(df: DataFrame, id_col: str = "doc_id", source: str = "source", text: str = "text", weights=(1, 2, 3),
        cap: int = CAP, seed: int = 42) -> DataFrame:
    """The rows of ``df`` with ``mix_``: size, source_size, target, rate, copies, taken.

    ``mix_.copies`` is the rounded rate and ``mix_.taken`` is copies times size; empty and
    NULL texts have size 0 and no copies. A NULL source is a source of its own. Which of
    several equally large documents of a source get one copy more is decided by a hash of
    seed and row, so reruns agree; of rows that are equal throughout just as many get it as
    the target needs, also where ids are NULL or repeated. Extra columns are kept whatever
    their names (``mix_`` excepted). An empty table gives an empty one. Jobs run when called.
    """
    return _mix(df, id_col, source, text, weights, cap, seed).select("row.*", F.col("mix").alias("mix_"))


def mixed(df: DataFrame, id_col: str = "doc_id", source: str = "source", text: str = "text", weights=(1, 2, 3),
          cap: int = CAP, seed: int = 42) -> DataFrame:
    """Every row of ``df`` as often as the mix takes it; columns as they are, whatever their names.

    Rows without words (NULL and empty texts too) are never taken. NULL sources and ids,
    ties, repeated rows and empty tables: see ``mix``.
    """
    taken = _mix(df, id_col, source, text, weights, cap, seed).filter("mix.copies > 0")
    return taken.select("row", F.explode(F.array_repeat(F.lit(1), F.col("mix.copies").cast("int"))).alias("copy")).select("row.*")
