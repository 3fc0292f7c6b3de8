"""Near-duplicate documents by one-permutation MinHash.

A document is the set of its distinct word shingles. Two documents are linked when
``100 * intersection >= percent * union``; groups are the components of these links.

1. Texts become 64-bit shingle hashes. Equal sets form a class, represented by its
   smallest id; all later steps see one row per class.
2. One permutation hashes a set into ``BINS`` bins, each keeping its smallest value;
   empty bins copy a full bin found by their own probe sequence (optimal
   densification). Bins are joined to bands, a band's value names a bucket.
3. In each bucket the ``CENTRES`` most connected classes are centres of stars: candidates
   are (member, centre) pairs, so their number grows with the members and not with pairs
   of members. A member first tries its best centre only; after the first components are
   known, it tries the other centres of its buckets that lie in other components.
4. Stars see every pair of a bucket of up to ``CENTRES + 1`` classes. In larger buckets
   pairs without a centre, in different components still, are searched exactly: their
   classes are joined on the rarest shingles of their sets (prefix, position and parity filter).
5. A candidate must share two band values, and is then confirmed on the full sets.

A pair above the threshold shares fewer than two band values with a probability below
``MISS``; nothing else is lost, and no bucket, partner or candidate is capped.
"""
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .store import stored
from .words import Hasher, buffers, is_space, mix, owners, runs, windows

BINS = 120
MISS = 1e-5
CENTRES = 6
SHARED = 2
PARITY = 16  # longs of a set's parity bits
_PROBES = 64


def banding(percent: int, bins: int = BINS) -> tuple[int, int]:
    """(bands, rows): the longest rows for which a pair at the threshold is still found."""
    for rows in range(10, 1, -1):
        bands, hit = bins // rows, (percent / 100) ** rows
        missed = sum(math.comb(bands, k) * hit ** k * (1 - hit) ** (bands - k) for k in range(SHARED))
        if missed <= MISS:
            return bands, rows
    return bins, 1


def shingle_sets(texts, width: int):
    """Yield (index of the text, sorted array of its distinct shingle hashes) in order."""
    hasher = Hasher(lower=True)
    for at, buf, t0, t1 in buffers(texts):
        w0, w1 = runs(~is_space(buf))
        word_of = owners(t0, w0)
        h = hasher.spans(buf, w0, w1)
        shingle, owner, _ = windows(h, word_of, width)
        n = len(at)
        cuts = np.searchsorted(owner, np.arange(n + 1))
        words = np.searchsorted(word_of, np.arange(n + 1))
        for i in range(n):
            found = np.unique(shingle[cuts[i]:cuts[i + 1]])
            if not len(found) and words[i + 1] > words[i]:  # fewer words than a shingle: the whole sequence
                k = words[i + 1] - words[i]
                whole, _, _ = windows(h[words[i]:words[i + 1]], np.zeros(k, np.int64), k)
                found = mix(whole + np.uint64(k))
            yield at[i], found


def _probe(bins: int, start: int):
    """Bins that each empty bin tries, by attempt; the same for every document."""
    k, a = np.meshgrid(np.arange(bins), np.arange(start, start + _PROBES), indexing="ij")
    return (mix((k * 1_000_003 + a + 7).astype(np.uint64)) % np.uint64(bins)).astype(np.int64)


def bin_edges(bins: int) -> np.ndarray:
    """Smallest hash of each of equally wide bins."""
    return (((np.arange(bins, dtype=object) << 64) + bins - 1) // bins).astype(np.uint64)


def signature(values, edges, probes) -> np.ndarray:
    """Smallest value of each bin of one permutation, empty bins densified."""
    bins = len(edges)
    first = np.searchsorted(values, edges)
    sig = values[np.minimum(first, len(values) - 1)].copy()
    after = np.append(first[1:], len(values))
    full = after > first
    empty = np.flatnonzero(~full)
    start = 0
    while len(empty):
        tried = (probes if start == 0 else _probe(bins, start))[empty]
        hit = full[tried]
        found = hit.any(axis=1)
        pick = tried[np.arange(len(empty)), hit.argmax(axis=1)]
        sig[empty[found]] = sig[pick[found]]
        empty, start = empty[~found], start + _PROBES
    return sig


def _frame(rows, columns):
    return pd.DataFrame(rows, columns=columns)


def _signed(df: DataFrame, id_col: str, text: str, width: int, bands: int, rows: int) -> DataFrame:
    """(id, n, f1, f2, bands): set size, set fingerprint and band values; no bands if empty."""
    bins = bands * rows

    def run(batches):
        probes, edges = _probe(bins, 0), bin_edges(bins)
        salt = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        for pdf in batches:
            ids, out = pdf["id"].tolist(), []
            for i, s in shingle_sets(pdf["t"].tolist(), width):
                if not len(s):
                    out.append((ids[i], 0, 0, 0, None))
                    continue
                sig = mix(signature(s, edges, probes)).reshape(bands, rows)
                h = salt.copy()
                for r in range(rows):
                    h = mix(h + sig[:, r])
                out.append((ids[i], len(s), np.bitwise_xor.reduce(mix(s)).astype(np.int64),
                            mix(s + np.uint64(99)).sum(dtype=np.uint64).astype(np.int64), h.astype(np.int64)))
            yield _frame(out, ["id", "n", "f1", "f2", "bands"])

    # Ids pass Python as strings: longs beside a NULL would become doubles.
    return df.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text}`").alias("t")).mapInPandas(
        run, "id string, n long, f1 long, f2 long, bands array<long>").withColumn("id", F.col("id").cast("long"))


def parity(values) -> np.ndarray:
    """Whether each of ``64 * PARITY`` groups of hashes holds an odd number of them, as bits of longs.

    A group whose bits differ holds a value of one set only, so two sets differ in as many
    values, at least, as they do in bits.
    """
    odd = np.bincount((values % np.uint64(64 * PARITY)).astype(np.int64), minlength=64 * PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sets(df: DataFrame, id_col: str, text: str, width: int) -> DataFrame:
    """(id, items, parity) of every text."""
    columns = ["id", "items", "parity"]

    def run(batches):
        for pdf in batches:
            ids, out, held = pdf["id"].tolist(), [], 0
            for i, s in shingle_sets(pdf["t"].tolist(), width):
                out.append((ids[i], s.astype(np.int64), parity(s)))
                held += len(s)
                if held > 500_000:
                    yield _frame(out, columns)
                    out, held = [], 0
            yield _frame(out, columns)

    return df.select(F.col(id_col).alias("id"), F.col(text).alias("t")).mapInPandas(
        run, "id long, items array<long>, parity array<long>")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("id").alias("a"), F.col("items").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("items").alias("y"))
    near = F.expr(f"100 * least(size(x), size(y)) >= {percent} * greatest(size(x), size(y))")
    inter = F.size(F.array_intersect("x", "y"))
    return pairs.join(left, "a").join(right, "b").filter(near).filter(
        100 * inter >= percent * (F.size("x") + F.size("y") - inter)).select("a", "b")


def _alike(pairs: DataFrame, signs: DataFrame) -> DataFrame:
    """The pairs (a, b) with enough common band values."""
    left, right = [signs.select(F.col("rep").alias(c), F.col("bands").alias(f"bands_{c}")) for c in "ab"]
    return pairs.join(left, "a").join(right, "b").filter(
        F.size(F.array_intersect("bands_a", "bands_b")) >= SHARED).select("a", "b")


def _across(inside: DataFrame, centres: DataFrame, label: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of different components that no star has seen, by a prefix join.

    Two similar sets share a shingle among the rarest ``n - ceil(percent/100 * n) + 1`` of
    each, in one global order by frequency, and its places in both leave room for the
    wanted intersection. Shingles of one component only, which no pair shares, take no room.
    Sets whose parity bits differ too much for the wanted intersection are not paired, so that
    of families under the threshold few pairs come out, while their comparisons remain.
    """
    members = inside.filter(F.col("m") > CENTRES + 1).select("rep", "key").join(
        centres.select("key", F.col("centre").alias("rep")), ["key", "rep"], "left_anti")
    own = stored(_labelled(members, label, "rep", "p"))
    mixed = own.groupBy("key").agg(F.min("p").alias("lo"), F.max("p").alias("hi")).filter("lo < hi")
    unseen = stored(own.join(mixed.select("key"), "key").groupBy("rep", "p").agg(F.count("*").alias("k"))
                    .filter(F.col("k") >= SHARED).select(F.col("rep").alias("id"), "p"))
    items = sets.join(unseen, "id").select("id", "p", F.size("items").alias("n"), F.explode("items").alias("item"))
    often = items.groupBy("item").agg(F.count("*").alias("df"), F.min("p").alias("lo"), F.max("p").alias("hi")).filter("lo < hi")
    order = items.join(often.select("item", "df"), "item").groupBy("id", "p", "n").agg(
        F.sort_array(F.collect_list(F.struct("df", "item"))).alias("order")).withColumn("m", F.size("order"))
    prefix = F.expr(f"greatest(m - CAST(ceil({percent} * n / 100.0) AS INT) + 1, 0)")
    heads = stored(order.select("id", "p", "n", "m", F.posexplode(F.slice("order", F.lit(1), prefix)).alias("at", "o"))
                   .select("id", "p", "n", "m", "at", "o.item").join(sets.select("id", "parity"), "id"))
    a, b = [heads.select(F.col("id").alias(c), "item", *[F.col(k).alias(f"{k}_{c}") for k in ("p", "n", "m", "at", "parity")])
            for c in "ab"]
    room = "(least(at_a, at_b) + least(m_a - at_a, m_b - at_b))"
    apart = " + ".join(f"bit_count(parity_a[{k}] ^ parity_b[{k}])" for k in range(PARITY))
    return a.join(b, "item").filter(
        f"a < b AND p_a <> p_b AND 100 * {room} >= {percent} * (n_a + n_b - {room})"
        f" AND {100 + percent} * (n_a + n_b - ({apart})) >= {2 * percent} * (n_a + n_b)").select("a", "b").distinct()


def _labelled(rows: DataFrame, label: DataFrame, col: str, out: str) -> DataFrame:
    """Adds the component of ``col``; a class without links is its own component."""
    mapping = label.select(F.col("node").alias(col), F.col("component").alias(out))
    return rows.join(mapping, col, "left").withColumn(out, F.coalesce(out, col))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 3,
                    percent: int = 85) -> DataFrame:
    """``(id_col, n_shingles, component_id)`` for every row of ``df``.

    ``component_id`` is the smallest id reachable over links. NULL or wordless texts
    have no shingles and are their own component; a NULL id stays NULL and takes no part
    in links. Repeated rows give repeated results; rows that repeat an id with another text
    belong together, and the smallest text confirms their links. Extra columns are not read.
    Jobs run when called: intermediate tables are stored in the shared folder.
    """
    bands, rows = banding(percent)
    signed = stored(_signed(df, id_col, text, width, bands, rows))
    classes = stored(
        signed.filter("n > 0 AND id IS NOT NULL").groupBy("f1", "f2", "n")
        .agg(F.min("id").alias("rep"), F.first("bands").alias("bands")))
    bucket = classes.select("rep", F.explode("bands").alias("key"))
    shared = bucket.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1")
    inside = stored(bucket.join(shared, "key"))
    # Centres of a bucket: the classes with most company over all their buckets.
    company = inside.groupBy("rep").agg(F.sum("m").alias("c"))
    weighed = stored(inside.select("rep", "key").join(company, "rep"))
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.col("c").desc(), "rep"))
    centres = stored(weighed.withColumn("place", place).filter(F.col("place") <= CENTRES).select(
        "key", F.col("rep").alias("centre"), F.col("c").alias("cc"), "place"))
    involved = company.select(F.col("rep").alias("id_"))
    whole = df.select(F.col(f"`{id_col}`").cast("long").alias("id_"), F.col(f"`{text}`").alias("t_"))
    texts = whole.join(involved, "id_").groupBy("id_").agg(F.min("t_").alias("t_"))
    sets = stored(_sets(texts, "id_", "t_", width))
    signs = classes.select("rep", "bands")
    # The best centre of each class, then centres in components other than its own.
    best = inside.select("rep", "key").join(centres.filter("place = 1"), "key").filter("rep <> centre").groupBy(
        F.col("rep").alias("a")).agg(F.max(F.struct("cc", (-F.col("centre")).alias("minus"))).alias("top")).select(
        "a", (-F.col("top.minus")).alias("b"))
    links = stored(_confirmed(_alike(best, signs), sets, percent))
    label = components(links)
    own = _labelled(inside.select("rep", "key"), label, "rep", "p")
    others = _labelled(centres.select("key", "centre"), label, "centre", "q")
    rest = own.join(others, "key").filter("p <> q").select(
        F.least("rep", "centre").alias("a"), F.greatest("rep", "centre").alias("b")).distinct()
    more = stored(_confirmed(_alike(rest, signs), sets, percent))
    if not more.isEmpty():
        links = links.union(more)
        label = components(links)
    more = stored(_confirmed(_alike(_across(inside, centres, label, sets, percent), signs), sets, percent))
    if not more.isEmpty():
        label = components(links.union(more))
    named = _labelled(classes.select("f1", "f2", "n", "rep"), label, "rep", "component")
    return (
        signed.select("id", "n", "f1", "f2").join(named, ["f1", "f2", "n"], "left")
        .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id")))


def deduplicated(df: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 5,
                 percent: int = 80) -> DataFrame:
    """One document of each group: the one whose id names the group; NULL ids all stay.

    Where rows repeat an id, one of them stays, that with the smallest text. NULL and empty
    texts are linked with nothing and stay. Whole texts of any length are compared. Extra
    columns stay, whatever their names. An empty table gives an empty one.
    """
    groups = stored(near_duplicates(df, id_col, text, width, percent).filter(f"`{id_col}` IS NOT NULL"))
    heads = groups.filter(F.col(id_col) == F.col("component_id")).select(F.col(id_col).alias("head")).distinct()
    # Rows travel as one struct, so that no column of theirs meets a name used here.
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
                     F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("t"))
    known, unknown = rows.filter("id IS NOT NULL").select("row", "id", "t"), rows.filter("id IS NULL").select("row")
    if not groups.groupBy(id_col).count().filter("count > 1").isEmpty():
        known = known.groupBy("id").agg(F.min_by("row", F.coalesce("t", F.lit(""))).alias("row"))
    return known.join(heads, F.col("id") == F.col("head"), "left_semi").select("row").union(unknown).select("row.*")
