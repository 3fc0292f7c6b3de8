"""Row numbers and differences inside groups that may hold a large part of all rows.

A plain window puts a whole group into one task. Both operators here split each group
into pieces along its own order, work inside the pieces, and carry over from piece to
piece with a second window that sees one row per piece.
"""
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .distributions import in_ranges
from .lineage import settled


def ordinal_within(df: DataFrame, key: str, position: str, out: str) -> DataFrame:
    """Number the rows of each key from 1 by position.

    Positions may be of any sortable type, may repeat and may be NULL, which comes first;
    NULL is a key like any other. Of equal positions any is first, always the same one for
    the stored rows. Rows are laid into ranges of (key, position) of bounded size, whatever
    part of them one key, or one key's rows without a position, makes up. Only the first key
    of a range can have begun in an earlier one, so one number per range carries the count on.
    """
    rows = settled(df).withColumn("_row", F.monotonically_increasing_id())
    ranged = in_ranges(rows, key, position, "_row")
    spans = ranged.groupBy("_range", key).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        spans.withColumn("_start", F.sum("_n").over(before)).filter("_start > 0")
        .select(F.col("_range").alias("_at"), F.col(key).alias("_key"), "_start")
    )
    inside = Window.partitionBy("_range", key).orderBy(F.col(position).asc_nulls_first(), "_row")
    same = (F.col("_range") == F.col("_at")) & F.col(key).eqNullSafe(F.col("_key"))
    return (
        ranged.withColumn("_inside", F.row_number().over(inside))
        .join(F.broadcast(starts), same, "left")
        .withColumn(out, F.coalesce("_start", F.lit(0)) + F.col("_inside"))
        .drop("_row", "_range", "_at", "_key", "_start", "_inside")
    )


def gap_statistics(df: DataFrame, key: str, second: str, probability: float = 0.5,
                   slot: int = 3600) -> DataFrame:
    """Per key: rows, mean and lower quantile of the gaps between consecutive rows.

    ``second`` is a whole number of seconds; rows without it count in ``rows`` only.
    Rows are first reduced to the distinct seconds of each (key, slot), at most
    ``slot`` of them however many rows a key has, and those to counted gaps. The
    second shuffle, by key alone, moves one short row per slot, so the share of one
    key is bounded by the time the data spans. Everything after it stays in place.
    """
    slots = (
        df.filter(F.col(key).isNotNull())
        .groupBy(key, F.floor(F.col(second) / slot).alias("_slot"))
        .agg(F.sort_array(F.collect_set(second)).alias("_seen"), F.count("*").alias("_rows"))
    )
    later = F.slice("_seen", 2, slot)
    steps = F.zip_with(later, F.slice("_seen", 1, F.greatest(F.size("_seen") - 1, F.lit(0))),
                       lambda b, a: b - a)
    slots = slots.withColumn("_steps", steps).select(
        key, "_slot", "_rows",
        F.get("_seen", F.lit(0)).alias("_first"),
        F.try_element_at("_seen", F.lit(-1)).alias("_last"),
        F.transform(F.array_distinct("_steps"), lambda g: F.struct(
            g.alias("gap"), F.size(F.filter("_steps", lambda s: s == g)).cast("long").alias("weight"))).alias("_inside"),
        F.when(F.col("_slot").isNotNull(), F.col("_rows") - F.size("_seen")).otherwise(0).alias("_repeats"))
    whole = Window.partitionBy(key)
    between = F.col("_first") - F.lag("_last").over(whole.orderBy("_slot"))
    linked = slots.withColumn("_between", between).withColumn("_total", F.sum("_rows").over(whole))
    zero = F.struct(F.lit(0).cast("long").alias("gap"), F.col("_repeats").alias("weight"))
    border = F.struct(
        F.col("_between").alias("gap"),
        F.when(F.col("_between").isNotNull(), 1).otherwise(0).cast("long").alias("weight"))
    counted = (
        linked.select(key, "_total", F.inline(F.concat("_inside", F.array(zero, border))))
        .groupBy(key, "gap").agg(F.sum("weight").alias("weight"), F.max("_total").alias("_total"))
    )
    reached = F.sum("weight").over(whole.orderBy("gap"))
    needed = F.sum("weight").over(whole) * F.lit(probability)
    return (
        counted.withColumn("_hit", (reached >= needed) & (F.col("weight") > 0))
        .groupBy(key)
        .agg(F.max("_total").alias("rows"),
             F.try_divide(F.sum(F.col("gap") * F.col("weight")), F.sum("weight")).alias("mean_gap"),
             F.min(F.when(F.col("_hit"), F.col("gap"))).alias("quantile_gap"))
    )


def expand_ranges(df: DataFrame, start: str, count: str, out: str,
                  chunk: int = 100_000) -> DataFrame:
    """Repeat each row ``count`` times with ``out`` = start + 1, start + 2, ...

    A row is first cut into chunks which are spread over the tasks, so that one row
    with a huge count does not expand in one place.
    """
    chunks = df.withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(count) - 1) / chunk))))
    low = F.col(start) + F.col("_chunk") * chunk + 1
    high = F.col(start) + F.least(F.col(count), (F.col("_chunk") + 1) * chunk)
    return (
        chunks.repartition(F.col(start), F.col("_chunk"))
        .withColumn(out, F.explode(F.sequence(low, high)))
        .drop("_chunk")
    )
