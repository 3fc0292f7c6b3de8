"""URL filters with dated lists, as a temporal join.

A list is a log of entries ``(list, pattern, action, since)``: from that day on the
pattern is on the list with the action ``block`` or ``allow``, or off it (``remove``). Each
entry holds until the next one of the same list and pattern, so the log becomes validity
intervals. A pattern is a host suffix (``example.org`` covers all hosts below it) or a
host with a path prefix of whole segments (``example.org/de``).

A capture is looked up under every suffix of its host and every prefix of its path, as
of the time it was fetched. The join is an equality of pattern and month: intervals are
cut into the months they touch, so a pattern with many versions meets a capture with those
of one month only, and a host with a third of all captures is spread over patterns and
months. The most specific pattern decides; between lists, a block wins.
"""
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and a closing dot; '' if the URL has none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]*)", 1))
    return F.coalesce(F.regexp_replace(host, r"\.+$", ""), F.lit(""))


def path_of(url: Column) -> Column:
    """Path without query and fragment, without slashes at its ends and double slashes."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.regexp_replace(F.regexp_replace(path, "/+", "/"), "^/|/$", ""), F.lit(""))


def patterns_of(url: Column, labels_known: int, segments_known: int) -> Column:
    """All patterns that cover a URL with their rank; longer hosts and paths rank higher.

    Patterns longer than any on the lists are left out.
    """
    labels, parts = F.split(host_of(url), r"\."), F.split(path_of(url), "/")
    n = F.least(F.size(labels), F.lit(max(labels_known, 1)))
    suffixes = F.transform(F.sequence(F.lit(1), n), lambda k: F.struct(
        F.array_join(F.slice(labels, -k, k), ".").alias("pattern"), (k * 1_000_000).alias("rank")))
    depth = F.when(path_of(url) == "", 0).otherwise(F.least(F.size(parts), F.lit(segments_known)))
    prefixes = F.when(depth > 0, F.transform(F.sequence(F.lit(1), F.greatest(depth, F.lit(1))), lambda k: F.struct(
        F.concat(host_of(url), F.lit("/"), F.array_join(F.slice(parts, 1, k), "/")).alias("pattern"),
        (F.size(labels) * 1_000_000 + k).alias("rank")))).otherwise(F.slice(suffixes, 1, 0))
    return F.when(host_of(url) == "", F.slice(suffixes, 1, 0)).otherwise(F.concat(suffixes, prefixes))


def intervals(entries: DataFrame) -> DataFrame:
    """``(list, pattern, action, since, until)``; ``until`` is exclusive, NULL if open.

    Entries with a NULL list, pattern, action or date are ignored. Of several entries of
    one list, pattern and day, the strictest holds: block before allow before remove.
    """
    known = entries.select("list", F.lower("pattern").alias("pattern"), "action", F.col("since").cast("date").alias("since")).filter(
        "list IS NOT NULL AND pattern IS NOT NULL AND action IN ('block', 'allow', 'remove') AND since IS NOT NULL")
    strict = F.when(F.col("action") == "block", 3).when(F.col("action") == "allow", 2).otherwise(1)
    daily = known.groupBy("list", "pattern", "since").agg(F.max_by("action", strict).alias("action"))
    after = F.lead("since").over(Window.partitionBy("list", "pattern").orderBy("since"))
    return daily.withColumn("until", after).filter("action <> 'remove'")


def filtered(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url: str = "url",
             fetched: str = "fetched_at") -> DataFrame:
    """``id_col, url, fetched, verdict, list, pattern, since`` of every capture.

    ``verdict`` is ``block``, ``allow`` or ``none``; the other three name the deciding entry.
    A NULL or hostless URL and a NULL time give ``none``. Repeated rows give repeated
    results, NULL ids stay. An empty list gives ``none`` throughout. Extra columns are not
    read. Only four numbers reach the driver: the longest patterns and the last day.
    """
    rows = captures.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url}`").alias("u"),
                           F.col(f"`{fetched}`").cast("date").alias("day"))
    of_path = F.when(F.instr("pattern", "/") > 0, F.size(F.split("pattern", "/")) - 1).otherwise(0)
    of_host = F.size(F.split(F.substring_index("pattern", "/", 1), r"\."))
    labels_known, segments_known = entries.agg(F.max(of_host), F.max(of_path)).first()
    last = rows.agg(F.max("day")).first()[0]
    looked = rows.withColumn("p", F.explode(patterns_of(F.col("u"), labels_known or 1, segments_known or 0))).filter(
        "day IS NOT NULL").select("id", "u", "day", "p.pattern", "p.rank", F.trunc("day", "month").alias("month"))
    # An open interval reaches to the last month fetched, so its months are bounded.
    end = F.lit(last).cast("date")
    first_month = F.trunc("since", "month")
    last_month = F.trunc(F.least(F.date_sub("until", 1), end), "month")
    valid = intervals(entries).filter(F.col("since") <= end).select(
        "list", "pattern", "action", "since", "until",
        F.explode(F.sequence(first_month, F.greatest(first_month, last_month), F.expr("INTERVAL 1 MONTH"))).alias("month"))
    hit = looked.join(valid, ["pattern", "month"]).filter("since <= day AND (until IS NULL OR day < until)")
    order = F.struct("rank", (F.col("action") == "block").cast("int").alias("blocks"), F.col("list"))
    decided = hit.groupBy("id", "u", "day").agg(
        F.max_by(F.struct("action", "list", "pattern", "since"), order).alias("hit"))
    same = (F.col("id").eqNullSafe(F.col("i"))) & (F.col("u") == F.col("uu")) & (F.col("day") == F.col("d"))
    found = decided.select(F.col("id").alias("i"), F.col("u").alias("uu"), F.col("day").alias("d"), "hit")
    return rows.join(found, same, "left").select(
        F.col("id").alias(id_col), F.col("u").alias(url), F.col("day").alias(fetched),
        F.coalesce("hit.action", F.lit("none")).alias("verdict"), F.col("hit.list").alias("list"),
        F.col("hit.pattern").alias("pattern"), F.col("hit.since").alias("since"))
