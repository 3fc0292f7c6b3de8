"""Repeatable draws.

Rows are chosen by a hash of their content and a seed, so a lost task that runs again,
or another partitioning, picks the same rows.
"""
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hash_uniform(keys, seed: int) -> Column:
    """A number in [0, 1) fixed by the key columns and the seed."""
    h = F.xxhash64(F.lit(seed), *[F.col(k) for k in keys])
    return F.shiftrightunsigned(h, 11) * F.lit(2.0 ** -53)


def bernoulli_sample(df: DataFrame, fraction: float, keys, seed: int = 42) -> DataFrame:
    """Keep each row with the given probability."""
    return df.filter(hash_uniform(keys, seed) < fraction)


def equal_size_sample(df: DataFrame, group: str, groups: list[str], size: int, keys,
                      seed: int = 42) -> DataFrame:
    """About ``size`` rows of each listed group, all rows of smaller groups."""
    rate = _rates(df, group, groups, lambda n: F.lit(float(size)) / n)
    return df.filter(hash_uniform(keys, seed) < F.try_element_at(rate, F.col(group)))


def first_by_hash(df: DataFrame, group: str, groups: list[str], size: int, keys,
                  seed: int = 42, distinct: bool = False) -> DataFrame:
    """Exactly ``size`` rows of each listed group (all rows of smaller groups).

    Adds ``draw``, the row's number in hash order within its group. The hash first
    thins each group to a little more than ``size`` rows, so the numbering window
    never sees a large group. ``keys`` must tell the rows of a group apart; if they do
    not, ``distinct`` keeps one row of each copy. Copies share a hash, so they are
    removed after the thinning: the texts of the whole table are never shuffled, only
    counted by an approximate distinct count, whose error the margin covers.
    """
    slack = size + 8 * math.sqrt(size) + 64
    if distinct:
        slack *= 1.5
        rate = _rates(df, group, groups, lambda n: F.lit(slack) / n, keys)
    else:
        rate = _rates(df, group, groups, lambda n: F.lit(slack) / n)
    thinned = (
        df.filter(F.col(group).isin(groups))
        .withColumn("_u", hash_uniform(keys, seed))
        .filter(F.col("_u") < F.try_element_at(rate, F.col(group)))
    )
    if distinct:
        thinned = thinned.dropDuplicates([group, *keys])
    w = Window.partitionBy(group).orderBy("_u", *keys)
    return (
        thinned.withColumn("draw", F.row_number().over(w))
        .filter(F.col("draw") <= size).drop("_u")
    )


def balanced_split(df: DataFrame, label: str, labels: list, train: int, test: int,
                   content: str, seed: int = 42) -> DataFrame:
    """Equal-size training and test draws per label with no content in both.

    Repeated contents count as one row. A label with fewer than ``train + test``
    different contents is divided in the same proportion. Adds ``part``: train or test.
    """
    drawn = first_by_hash(
        df.filter(F.col(content).isNotNull()), label, labels, train + test, [content], seed, distinct=True)
    available = F.count("*").over(Window.partitionBy(label))
    quota = F.least(F.lit(train), F.floor(available * train / (train + test)))
    return drawn.withColumn(
        "part", F.when(F.col("draw") <= quota, "train").otherwise("test")).drop("draw")


def hash_split(df: DataFrame, weights: dict[str, float], keys, seed: int = 42) -> DataFrame:
    """Assign every row to a named part with probability proportional to its weight."""
    total = sum(weights.values())
    u = hash_uniform(keys, seed)
    edge, part = 0.0, None
    names = list(weights)
    for name in names[:-1]:
        edge += weights[name] / total
        part = F.when(u < edge, name) if part is None else part.when(u < edge, name)
    last = F.lit(names[-1])
    return df.withColumn("part", last if part is None else part.otherwise(last))


def _rates(df: DataFrame, group: str, groups: list, rate, distinct_keys=None) -> Column:
    """Map from group to sampling rate, as a scalar subquery over one count pass."""
    entries = []
    for g in groups:
        member = F.col(group) == F.lit(g)
        if distinct_keys is None:
            n = F.count_if(member)
        else:
            content = F.xxhash64(*[F.col(k) for k in distinct_keys])
            n = F.approx_count_distinct(F.when(member, content), 0.02)
        entries += [F.lit(g), F.coalesce(F.try_divide(rate(F.lit(1.0)), n.cast("double")), F.lit(0.0))]
    return df.agg(F.create_map(*entries).alias("rates")).scalar()
