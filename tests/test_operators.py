import itertools
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from parlance.functions.numeric import normal_cdf
from parlance.functions.tails import bootstrap_interval, exact_u_tail, limiting_kolmogorov_tail
from parlance.operators import distributions, inference, lineage, ordering, ranking, sampling, shares


@pytest.fixture(scope="module")
def hot_rows():
    """Times of users, one of whom has a third of all rows and many equal seconds."""
    rng = random.Random(7)
    rows = [("hot", rng.randrange(20_000)) for _ in range(3000)]
    rows += [(f"u{rng.randrange(60)}", rng.randrange(2_000_000)) for _ in range(6000)]
    rows += [("single", 5), ("dateless", None), ("hot", None), (None, 7)]
    return rows


def test_gap_statistics_equal_a_plain_walk(spark, hot_rows):
    df = spark.createDataFrame(hot_rows, "k string, s long").repartition(8)
    got = {r.k: r for r in ordering.gap_statistics(df, "k", "s", 0.5).collect()}
    per_key = defaultdict(list)
    sizes = Counter(k for k, _ in hot_rows if k is not None)
    for k, s in hot_rows:
        if k is not None and s is not None:
            per_key[k].append(s)
    assert set(got) == set(sizes)
    for k, size in sizes.items():
        times = sorted(per_key[k])
        gaps = sorted(b - a for a, b in zip(times, times[1:]))
        assert got[k].rows == size
        if gaps:
            assert got[k].mean_gap == pytest.approx(sum(gaps) / len(gaps))
            assert got[k].quantile_gap == gaps[math.ceil(0.5 * len(gaps)) - 1]
        else:
            assert got[k].mean_gap is None and got[k].quantile_gap is None


def test_ordinal_within_equals_row_number(spark):
    rng = random.Random(3)
    rows = [("hot", p) for p in rng.sample(range(10_000), 4000)]
    rows += [(f"k{i}", p) for i in range(20) for p in rng.sample(range(5000), 50)]
    got = ordering.ordinal_within(spark.createDataFrame(rows, "k string, p long").repartition(8), "k", "p", "n")
    expected = {}
    for k in {k for k, _ in rows}:
        for n, p in enumerate(sorted(p for kk, p in rows if kk == k), 1):
            expected[k, p] = n
    assert {(r.k, r.p): r.n for r in got.collect()} == expected


def test_ordinal_within_splits_rows_without_a_position(spark, monkeypatch):
    monkeypatch.setattr(distributions, "RANGE_ROWS", 200)
    rng = random.Random(4)
    rows = [("hot", None)] * 700 + [("hot", rng.randrange(40) / 4) for _ in range(900)]
    rows += [(f"k{rng.randrange(30)}", rng.choice([None, 0.5, 1.5, 2.25])) for _ in range(500)] + [(None, 1.0)] * 300
    df = spark.createDataFrame(rows, "k string, p double")
    got = ordering.ordinal_within(df, "k", "p", "n")
    assert got.columns == ["k", "p", "n"]
    found = defaultdict(list)
    for r in got.collect():
        found[r.k].append((r.n, -1.0 if r.p is None else r.p))
    for k in {k for k, _ in rows}:
        numbered = sorted(found[k])
        assert [n for n, _ in numbered] == list(range(1, len(numbered) + 1))
        assert [p for _, p in numbered] == sorted(-1.0 if p is None else p for kk, p in rows if kk == k)
    ranged = distributions.in_ranges(lineage.settled(df).withColumn("i", F.monotonically_increasing_id()), "k", "p", "i")
    assert max(r["count"] for r in ranged.groupBy("_range").count().collect()) <= 200


def test_ordinal_within_keeps_null_keys_and_positions(spark):
    rows = [(None, 1), (None, 2), ("a", 1), ("a", None), ("b", 300)]
    got = ordering.ordinal_within(spark.createDataFrame(rows, "k string, p long"), "k", "p", "n").collect()
    assert {(r.k, r.p): r.n for r in got} == {(None, 1): 1, (None, 2): 2, ("a", None): 1, ("a", 1): 2, ("b", 300): 1}


def test_interpolated_quantiles(spark):
    values = [float(v) for v in np.random.default_rng(4).poisson(40, 500)] + [1e6, -3.5]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    grid = [i / 10 for i in range(11)]
    got = df.limit(1).select(distributions.interpolated_quantiles(df, "v", grid)).first()[0]
    assert got == pytest.approx(list(np.quantile(values, grid)))


def test_expand_ranges(spark):
    df = spark.createDataFrame([(0, 5, "a"), (10, 1, "b"), (3, 12, "c")], "start long, n long, v string")
    got = sorted((r.v, r.i) for r in ordering.expand_ranges(df, "start", "n", "i", chunk=4).collect())
    assert got == [("a", i) for i in range(1, 6)] + [("b", 11)] + [("c", i) for i in range(4, 16)]


def test_shares(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3), (None, 4)], "k string, count long")
    assert {r.k: r.percentage for r in shares.share_of_total(df).collect()} == {"a": 12.5, "b": 37.5, None: 50.0}
    kept = shares.share_within(df, "k", drop_null_group=True).collect()
    assert {r.k: r.percentage for r in kept} == {"a": 100.0, "b": 100.0}


def test_running_share_gives_ties_one_total(spark):
    df = spark.createDataFrame([("a", 40.0), ("b", 30.0), ("c", 30.0)], "k string, percentage double")
    assert {r.k: r.cumulative_percentage for r in shares.running_share(df).collect()} == {"a": 40, "b": 100, "c": 100}


def test_rank_keeps_ties_and_row_number_does_not(spark):
    rows = [("x", i, c) for i, c in enumerate([9, 8, 7, 6, 5, 5, 5, 1])]
    df = spark.createDataFrame(rows, "g string, h int, count long")
    assert sorted(r.h for r in ranking.top_ranks_per_group(df, "g", 5).collect()) == [0, 1, 2, 3, 4, 5, 6]
    assert sorted(r.h for r in ranking.top_rows_per_group(df, "g", 5, ties=["h"]).collect()) == [0, 1, 2, 3, 4]
    assert sorted(r.h for r in ranking.largest_per_group(df.filter("count <= 5"), "g").collect()) == [4, 5, 6]


def test_equal_width_histogram_matches_numpy(spark):
    rng = np.random.default_rng(1)
    values = rng.integers(0, 50, 500).astype(float).tolist()
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    got = distributions.equal_width_histogram(spark, df, "v", 7).orderBy("bin").collect()
    counts, edges = np.histogram(values, 7)
    assert [r["count"] for r in got] == counts.tolist()
    assert [r.low for r in got] == pytest.approx(edges[:-1].tolist())


def test_equal_width_histogram_of_one_value(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    got = distributions.equal_width_histogram(spark, df, "v", 2).orderBy("bin").collect()
    assert [(r.low, r.high, r["count"]) for r in got] == [(2.5, 3.0, 0), (3.0, 3.5, 2)]


def test_quantile_bins_with_repeated_cuts(spark):
    df = spark.createDataFrame([(1.0,)] * 8 + [(2.0,), (3.0,), (None,)], "v double")
    got = distributions.quantile_bin_histogram(df, "v", 10).collect()
    assert sum(r["count"] for r in got) == 10
    assert sum(r.percentage for r in got) == pytest.approx(100)


# --- tests -----------------------------------------------------------------------


def brute_mann_whitney(a, b):
    u = sum((x > y) + 0.5 * (x == y) for x in a for y in b)
    n1, n2 = len(a), len(b)
    n = n1 + n2
    ties = sum(t ** 3 - t for t in Counter(list(a) + list(b)).values())
    var = n1 * n2 / 12 * (n + 1 - ties / (n * (n - 1)))
    z = max(0.0, (max(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5) / math.sqrt(var))
    return u, z, min(1.0, math.erfc(z / math.sqrt(2)))


@pytest.mark.parametrize("kind", ["ties", "separate", "identical", "spread"])
def test_mann_whitney(spark, kind):
    rng = random.Random(5)
    a, b = {
        "ties": ([rng.randrange(5) for _ in range(80)], [rng.randrange(1, 6) for _ in range(60)]),
        "separate": (list(range(10, 20)), list(range(9))),
        "identical": ([1, 2, 3, 4], [1, 2, 3, 4]),
        "spread": ([rng.gauss(0, 1) for _ in range(300)], [rng.gauss(0.2, 1) for _ in range(250)]),
    }[kind]
    df = spark.createDataFrame(
        [(float(x), "a") for x in a] + [(float(x), "b") for x in b] + [(None, "a"), (1.0, "c")], "v double, g string")
    got = inference.mann_whitney(df, "v", "g", "a", "b").first()
    u, z, p = brute_mann_whitney(a, b)
    assert (got.n1, got.n2) == (len(a), len(b))
    assert got.u == pytest.approx(u)
    assert got.z == pytest.approx(z)
    assert got.p_value == pytest.approx(p)
    assert got.effect_size == pytest.approx(z / math.sqrt(len(a) + len(b)))


def test_mann_whitney_with_weights(spark):
    counted = spark.createDataFrame([(0, "a", 30), (1, "a", 4), (0, "b", 20), (1, "b", 9)], "v int, g string, n long")
    got = inference.mann_whitney(counted, "v", "g", "a", "b", weight="n").first()
    u, z, p = brute_mann_whitney([0] * 30 + [1] * 4, [0] * 20 + [1] * 9)
    assert (got.u, got.z, got.p_value) == (pytest.approx(u), pytest.approx(z), pytest.approx(p))


def test_ks_distance(spark):
    rng = random.Random(11)
    values = [rng.expovariate(1) for _ in range(400)] + [0.5] * 30
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = inference.ks_against_fitted_normal(df, "v").first()
    n, mean = len(values), sum(values) / len(values)
    std = math.sqrt(sum((v - mean) ** 2 for v in values) / (n - 1))
    distance = 0.0
    for v in set(values):
        c = 0.5 * math.erfc(-(v - mean) / std / math.sqrt(2))
        distance = max(distance, sum(x <= v for x in values) / n - c, c - sum(x < v for x in values) / n)
    assert (got.n, got.mean, got.std) == (n, pytest.approx(mean), pytest.approx(std))
    assert got.statistic == pytest.approx(distance)
    assert 0 <= got.p_value < 0.001


def test_mann_whitney_is_exact_for_small_samples(spark):
    a, b = [1.5, 3.0, 7.25, 9.0], [2.0, 4.0, 5.0, 6.0, 8.0, 10.0]
    df = spark.createDataFrame([(x, "a") for x in a] + [(x, "b") for x in b], "v double, g string")
    got = inference.mann_whitney(df, "v", "g", "a", "b").first()
    u = sum(x > y for x in a for y in b)
    places = [sum(p - i for i, p in enumerate(c)) for c in itertools.combinations(range(10), 4)]
    side = max(u, 24 - u)
    p = min(1.0, 2 * sum(x >= side for x in places) / len(places))
    assert got.u == u and got.p_value == pytest.approx(p) == exact_u_tail(4, 6, u)
    assert math.erfc(got.z / math.sqrt(2)) == pytest.approx(p)
    tied = inference.mann_whitney(df.union(df.limit(1)), "v", "g", "a", "b").first()
    plain = inference.mann_whitney(df, "v", "g", "a", "b", exact=False).first()
    assert plain.p_value == pytest.approx(brute_mann_whitney(a, b)[2]) != got.p_value
    assert tied.p_value == pytest.approx(brute_mann_whitney([a[0], *a], b)[2])


def test_ks_is_exact_for_small_samples(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4, 5, 6, 7, 8, 9, 30)], "v double")
    got = inference.ks_against_fitted_normal(df, "v").first()
    rng = np.random.default_rng(0)
    x = np.sort(rng.random((100_000, 10)), axis=1)
    i = np.arange(1, 11)
    distance = np.maximum(i / 10 - x, x - (i - 1) / 10).max(axis=1)
    assert got.p_value == pytest.approx((distance >= got.statistic).mean(), abs=0.006)


def test_bootstrap_interval_agrees_with_resampling(spark):
    rng = np.random.default_rng(2)
    a, b = rng.poisson(6, 201), rng.poisson(4, 150)
    df = spark.createDataFrame([(float(x), "a") for x in a] + [(float(x), "b") for x in b], "v double, g string")

    def run(frame):
        return inference.bootstrap_median_difference(
            spark, frame, "v", "g", "a", "b", replicates=3000, method="percentile").first()
    got = run(df)
    differences = [
        np.median(rng.choice(a, a.size)) - np.median(rng.choice(b, b.size)) for _ in range(3000)]
    low, high = np.quantile(differences, [0.025, 0.975])
    assert got.replicates == 3000
    assert abs(got.low - low) <= 0.5 and abs(got.high - high) <= 0.5
    assert run(df.repartition(5)) == got
    nothing = inference.bootstrap_median_difference(spark, df.filter("g = 'a'"), "v", "g", "a", "b").first()
    assert tuple(nothing) == (0, None, None)
    with pytest.raises(ValueError):
        inference.bootstrap_median_difference(spark, df, "v", "g", "a", "b", method="other")


def brute_accelerated(a, b, draws, confidence):
    """The corrected interval with every row left out in turn."""
    estimate = np.median(a) - np.median(b)
    cubes = squares = 0.0
    for sample, sign in ((a, 1), (b, -1)):
        left_out = np.array([sign * np.median(np.delete(sample, i)) for i in range(len(sample))])
        influence = (len(sample) - 1) * (left_out.mean() - left_out)
        cubes += (influence ** 3).sum() / len(sample) ** 3
        squares += (influence ** 2).sum() / len(sample) ** 2
    return bootstrap_interval(np.sort(draws), estimate, cubes / squares ** 1.5 / 6, confidence)


def test_corrected_interval_agrees_with_resampling(spark):
    rng = np.random.default_rng(3)
    a, b = rng.exponential(3, 120), rng.exponential(1, 81)
    df = spark.createDataFrame([(float(x), "a") for x in a] + [(float(x), "b") for x in b], "v double, g string")
    draws = [np.median(rng.choice(a, a.size)) - np.median(rng.choice(b, b.size)) for _ in range(20_000)]
    want = brute_accelerated(a, b, draws, 0.95)
    got = inference.bootstrap_median_difference(spark, df, "v", "g", "a", "b", replicates=20_000).first()
    plain = inference.bootstrap_median_difference(spark, df, "v", "g", "a", "b", replicates=20_000, method="percentile").first()
    assert (got.low, got.high) == pytest.approx(want, abs=0.06 * (want[1] - want[0]))
    assert (got.low, got.high) != (plain.low, plain.high)


def test_ranges_hold_a_bounded_number_of_values(spark):
    counts = spark.range(2_000_000).select((F.pmod(F.col("id") * 7919, F.lit(2_000_000)) / 2).alias("value"), F.lit(3).alias("n"))
    ranged = distributions.in_ranges(counts, "value")
    sizes = [r["count"] for r in ranged.groupBy("_range").count().collect()]
    assert sum(sizes) == 2_000_000 and max(sizes) <= distributions.RANGE_ROWS and len(sizes) >= 20
    below = distributions.with_counts_below(counts, ["n"])
    assert below.filter(F.col("n_below") != F.col("value") * 6).count() == 0 and below.count() == 2_000_000
    few = distributions.with_counts_below(counts.filter("value < 5"), ["n"])
    assert sorted((r.value, r.n_below) for r in few.collect()) == [(i / 2, 3 * i) for i in range(10)]
    assert distributions.with_counts_below(counts.limit(0), ["n"]).count() == 0


def test_distribution_functions(spark):
    df = spark.createDataFrame([(-1.96,), (0.0,), (1.6448536,), (None,)], "z double")
    got = [r[0] for r in df.select(normal_cdf(F.col("z"))).collect()]
    assert got[:3] == pytest.approx([0.0249979, 0.5, 0.95], abs=1e-6) and (got[3] is None or math.isnan(got[3]))
    # Critical values of the Kolmogorov distribution: 5 % at 1.3581, 1 % at 1.6276.
    assert [limiting_kolmogorov_tail(x) for x in (0.0, 0.5, 1.0, 1.3581, 1.6276)] == pytest.approx(
        [1.0, 0.9639452, 0.2699997, 0.05, 0.01], abs=2e-5)


def test_descriptives_and_moments(spark):
    df = spark.createDataFrame([("a", v) for v in (1, 2, 3, 4, 10)], "g string, v int")
    d = inference.descriptives(df, "v", "g").first()
    assert (d["count"], d["mean"], d.q1, d["median"], d.q3, d.iqr) == (5, 4.0, 2, 3, 4, 2)
    m = inference.moments(df, "v", "g").first()
    x = np.array([1, 2, 3, 4, 10.0]) - 4
    assert m.skewness == pytest.approx((x ** 3).mean() / (x ** 2).mean() ** 1.5)
    assert m.kurtosis == pytest.approx((x ** 4).mean() / (x ** 2).mean() ** 2 - 3)


# --- draws -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(f"no {i}", 0) for i in range(3000)] + [("no 1", 0)] * 500 + [(f"yes {i}", 1) for i in range(90)]
    return spark.createDataFrame(rows, "content string, label int")


def test_balanced_split(texts):
    got = sampling.balanced_split(texts, "label", [0, 1], 200, 50, "content").collect()
    sizes = Counter((r.label, r.part) for r in got)
    assert sizes == {(0, "train"): 200, (0, "test"): 50, (1, "train"): 72, (1, "test"): 18}
    assert len({r.content for r in got}) == len(got)


def test_draw_does_not_depend_on_partitioning(texts):
    def once(df):
        return {(r.content, r.part) for r in sampling.balanced_split(df, "label", [0, 1], 200, 50, "content").collect()}
    assert once(texts) == once(texts.repartition(13))


def test_first_by_hash_is_exact(spark):
    df = spark.range(20_000).withColumn("g", F.when(F.col("id") % 3 == 0, "x").otherwise("y"))
    sizes = sampling.first_by_hash(df, "g", ["x", "y", "z"], 5000, ["id"]).groupBy("g").count()
    assert {r.g: r["count"] for r in sizes.collect()} == {"x": 5000, "y": 5000}


def test_equal_size_sample_and_split(spark):
    df = spark.range(40_000).withColumn("g", F.when(F.col("id") % 4 == 0, "x").otherwise("y"))
    sizes = {r.g: r["count"] for r in sampling.equal_size_sample(df, "g", ["x", "y"], 2000, ["id"]).groupBy("g").count().collect()}
    assert all(1800 < n < 2200 for n in sizes.values())
    parts = {r.part: r["count"] for r in sampling.hash_split(df, {"a": 8, "b": 1, "c": 1}, ["id"]).groupBy("part").count().collect()}
    assert sum(parts.values()) == 40_000 and 31_500 < parts["a"] < 32_500


def test_settled_keeps_rows_and_cuts_lineage(spark):
    df = lineage.settled(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count())
    assert sorted(r["count"] for r in df.collect()) == [14] * 5 + [15] * 2
    assert "Range" not in df._jdf.queryExecution().optimizedPlan().toString()
