"""Approximate nearest neighbours by multiprobe p-stable hashing.

A table hashes a unit vector with ``projections`` Gaussian (2-stable) directions cut into
slots of ``width``; the slots together name a bucket. Besides its own bucket a query
visits perturbed buckets, one slot up or down on some directions, in the order of their
estimated chance to hold a neighbour: perturbation sets are scored once by the expected
squared distances to the slot borders, and a query maps their ranks to its own borders
from the nearest to the farthest. All candidates of all tables are reranked by their
cosine in double precision on the original vectors.

* Equal vectors are one class with its few smallest ids, as many as a result can use;
  equal queries are searched once. No result changes, and copies cost nothing.
* Buckets are dealt to shards, buckets above ``SHARD_ROWS`` entries are split over
  several. A task holds the points of one shard and lets queries pass in blocks.
* Every shard returns at most k + 1 classes a query, which is all that can survive.

There is no cap on buckets, probes of full buckets or candidates.
"""
import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import stored
from .words import mix

TABLES, WIDTH, PROBES, DIRECTIONS, SHARD_ROWS, BLOCK = 8, 3.0, 300, 14, 8192, 512


def directions(n: int) -> int:
    """Projections a table uses for ``n`` different vectors.

    No more than ``DIRECTIONS``: the share of all vectors that ``PROBES`` buckets hold falls
    with every direction, and with it the recall.
    """
    return min(DIRECTIONS, max(4, round(math.log2(max(n, 2))) - 2))


def perturbations(k: int, probes: int) -> np.ndarray:
    """Sets of border ranks, best first, as a 0/1 matrix of (probe, rank).

    Ranks order a query's 2k slot borders by distance; ranks j and 2k - 1 - j are the two
    borders of one direction and never go together.
    """
    j = np.arange(1, k + 1)
    near = j * (j + 1) / (4 * (k + 1) * (k + 2))
    far = 1 - (k + 1 - j)[::1] / (k + 1) + ((k + 1 - j) * (k + 2 - j)) / (4 * (k + 1) * (k + 2))
    cost = np.sort(np.concatenate([near, far]))
    sets, heap = [()], [(cost[0], (0,))]
    while heap and len(sets) < probes:
        score, ranks = heapq.heappop(heap)
        if all(2 * k - 1 - r not in ranks for r in ranks):
            sets.append(ranks)
        last = ranks[-1]
        if last + 1 < 2 * k:
            heapq.heappush(heap, (score - cost[last] + cost[last + 1], ranks[:-1] + (last + 1,)))
            heapq.heappush(heap, (score + cost[last + 1], ranks + (last + 1,)))
    out = np.zeros((len(sets), 2 * k), np.int64)
    for i, ranks in enumerate(sets):
        out[i, list(ranks)] = 1
    return out


class Tables:
    """Hash functions for vectors of one length."""

    def __init__(self, length: int, k: int, tables: int, width: float, seed: int):
        rng = np.random.default_rng([seed, length, k])
        self.k, self.tables, self.width = k, tables, width
        self.a = rng.standard_normal((length, tables * k))
        self.b = rng.uniform(0, 1, tables * k)
        self.length = length

    def _slots(self, vectors):
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        return (unit @ self.a / self.width + self.b).reshape(len(vectors), self.tables, self.k)

    def _named(self, slots, table):
        h = np.full(slots.shape[:-1], (table + 1) * 1_000_003 + self.length, np.uint64)
        for i in range(self.k):
            h = mix(h + slots[..., i].astype(np.int64).astype(np.uint64))
        return h.astype(np.int64)

    def buckets(self, vectors):
        """Bucket of each vector in each table."""
        slots = np.floor(self._slots(vectors))
        return np.stack([self._named(slots[:, t], t) for t in range(self.tables)], axis=1)

    def probed(self, vectors, sets):
        """Buckets each query visits, all tables, own bucket first."""
        exact = self._slots(vectors)
        slots, out = np.floor(exact), []
        for t in range(self.tables):
            down = exact[:, t] - slots[:, t]
            order = np.argsort(np.concatenate([down, 1 - down], axis=1), axis=1, kind="stable")
            moves = np.zeros((len(vectors), 2 * self.k, self.k))
            rows = np.arange(len(vectors))[:, None]
            moves[rows, np.arange(2 * self.k)[None, :], order % self.k] = np.where(order < self.k, -1, 1)
            out.append(self._named(slots[:, t][:, None, :] + sets @ moves, t))
        return np.concatenate(out, axis=1)


def _by_length(vectors):
    """Positions grouped by vector length, with their matrix."""
    lengths = np.array([len(v) for v in vectors])
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        yield at, np.array([vectors[i] for i in at], np.float64)


def nearest(df: DataFrame, queries, id_col: str = "vec_id", vector: str = "embedding", k: int = 5,
            tables: int = TABLES, width: float = WIDTH, probes: int = PROBES, seed: int = 7) -> DataFrame:
    """``query_id, rank, <id_col>, score``: the ``k`` nearest found of every query.

    ``queries`` is a condition on the rows of ``df``; candidates are all rows but the
    query's own. Nearest is the largest cosine, ties go to the smaller id. Vectors that
    are NULL, empty, zero or hold a NULL or non-finite number take no part, nor do NULL
    ids; only vectors of equal length meet. A query with fewer candidates returns those it
    has. Rows that repeat id and vector count once. Extra columns are not read. An empty
    table gives an empty one. Jobs run when called.
    """
    v = F.col(f"`{vector}`").cast("array<double>")
    sound = F.col(f"`{id_col}`").isNotNull() & v.isNotNull() & F.forall(
        v, lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))) & F.exists(v, lambda x: x != 0)
    rows = df.filter(sound).select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector}`").alias("v"),
                                   F.expr(queries).alias("asks") if isinstance(queries, str) else queries.alias("asks"))
    first = Window.partitionBy("v").orderBy("id")
    few = rows.select("id", "v").distinct().withColumn("place", F.row_number().over(first)).filter(F.col("place") <= k + 1)
    classes = stored(few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
                     .select(F.col("ids")[0].alias("rep"), "ids", "v"))
    asked = stored(rows.filter("asks").select(F.col("id").alias("query_id"), "v").distinct()
                   .join(classes.select("rep", "v"), "v").select("query_id", "rep"))
    n = classes.count()
    dims = directions(n)
    sets = perturbations(dims, probes)

    def hashed(batches):
        kept = {}
        for pdf in batches:
            found = np.zeros((len(pdf), tables), np.int64)
            for at, m in _by_length(pdf["v"].tolist()):
                t = kept.setdefault(m.shape[1], Tables(m.shape[1], dims, tables, width, seed))
                found[at] = t.buckets(m)
            yield pd.DataFrame({"rep": pdf["rep"], "v": pdf["v"], "buckets": list(found)})

    def probing(batches):
        kept = {}
        for pdf in batches:
            for s in range(0, len(pdf), 200):
                part = pdf.iloc[s:s + 200]
                for at, m in _by_length(part["v"].tolist()):
                    t = kept.setdefault(m.shape[1], Tables(m.shape[1], dims, tables, width, seed))
                    yield pd.DataFrame({"rep": part["rep"].to_numpy()[at], "buckets": list(t.probed(m, sets))})

    points = stored(classes.select("rep", "v").mapInPandas(
        hashed, f"rep long, v {classes.schema['v'].dataType.simpleString()}, buckets array<long>"))
    entries = points.select("rep", F.explode("buckets").alias("bucket"))
    shards = max(1, -(-n * tables // SHARD_ROWS))
    filled = stored(entries.groupBy("bucket").agg(F.ceil(F.count("*") / SHARD_ROWS).alias("splits")))
    shard = F.pmod(F.xxhash64("bucket", "split"), F.lit(shards)).cast("int")
    several = filled.filter("splits > 1")
    placed = (points.select("rep", "v", F.explode("buckets").alias("bucket")).join(several, "bucket", "left")
              .withColumn("split", F.when(F.col("splits") > 1, F.pmod(F.xxhash64("rep"), "splits")).otherwise(0).cast("long"))
              .select(shard.alias("shard"), F.lit(0).alias("kind"), "rep", "v", F.array("bucket").alias("buckets")))
    seekers = classes.join(asked.select("rep").distinct(), "rep", "left_semi").select("rep", "v")
    visits = (seekers.mapInPandas(probing, "rep long, buckets array<long>")
              .select("rep", F.explode("buckets").alias("bucket")).join(filled, "bucket")
              .withColumn("split", F.explode(F.sequence(F.lit(0).cast("long"), F.col("splits") - 1)))
              .groupBy("rep", shard.alias("shard")).agg(F.collect_set("bucket").alias("buckets")))
    coming = visits.join(seekers, "rep").select("shard", F.lit(1).alias("kind"), "rep", "v", "buckets")
    meeting = placed.union(coming).repartition(shards, "shard").sortWithinPartitions("shard", "kind", "rep")
    found = meeting.mapInPandas(_reranker(k + 1), "q long, c long, score double")
    best = Window.partitionBy("q").orderBy(F.col("score").desc(), "c")
    top = found.distinct().withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1)
    named = top.join(classes.select(F.col("rep").alias("c"), "ids"), "c").select("q", "score", F.explode("ids").alias(id_col))
    answers = asked.join(named, asked["rep"] == named["q"]).filter(F.col("query_id") != F.col(id_col))
    last = Window.partitionBy("query_id").orderBy(F.col("score").desc(), id_col)
    return answers.withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= k).select(
        "query_id", "rank", id_col, "score")


def _reranker(keep: int):
    """Rows sorted by shard, points before queries -> the best classes of each query."""

    def exact(m, q):
        return (m * q).sum(axis=1) / (np.sqrt((m * m).sum(axis=1)) * np.sqrt((q * q).sum()))

    def best_of(points, buckets, q, wanted):
        lo, hi = np.searchsorted(buckets, wanted), np.searchsorted(buckets, wanted, "right")
        size = hi - lo
        total = int(size.sum())
        if not total:
            return None
        at = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(total)
        rep = points["rep"][at]
        _, one = np.unique(rep, return_index=True)
        at = at[one]
        score = points["unit"][at] @ (q / np.linalg.norm(q))
        if len(at) > keep:
            near = score >= np.partition(score, len(at) - keep)[len(at) - keep] - 1e-9
            at = at[near]
        score = exact(points["raw"][at], q)
        order = np.lexsort((points["rep"][at], -score))[:keep]
        return points["rep"][at][order], score[order]

    def run(batches):
        now, held, points = None, [], {}
        for pdf in batches:
            out = []
            for (shard, kind), part in pdf.groupby(["shard", "kind"], sort=True):
                if shard != now:
                    now, held, points = shard, [], {}
                if kind == 0:
                    held.append((part["rep"].to_numpy(), [b[0] for b in part["buckets"]], part["v"].tolist()))
                    continue
                if held:
                    points, held = _laid_out(held), []
                for q, v, wanted in zip(part["rep"], part["v"], part["buckets"]):
                    q_vector = np.array(v, np.float64)
                    mine = points.get(len(q_vector))
                    got = mine and best_of(mine, mine["bucket"], q_vector, np.asarray(wanted))
                    if got:
                        out.append(pd.DataFrame({"q": q, "c": got[0], "score": got[1]}))
            if out:
                yield pd.concat(out, ignore_index=True)

    return run


def _laid_out(held):
    """The points of a shard by vector length, sorted by bucket."""
    rep = np.concatenate([h[0] for h in held])
    bucket = np.concatenate([np.array(h[1], np.int64) for h in held])
    vectors = [v for h in held for v in h[2]]
    out = {}
    for at, m in _by_length(vectors):
        order = np.argsort(bucket[at], kind="stable")
        at, m = at[order], m[order]
        out[m.shape[1]] = {"rep": rep[at], "bucket": bucket[at], "raw": m,
                           "unit": m / np.linalg.norm(m, axis=1, keepdims=True)}
    return out
