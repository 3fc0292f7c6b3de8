"""Spelling variants: words one edit apart, each led to its most frequent form.

A word's near words differ by exactly one inserted, deleted or replaced code point. One
edit leaves the first or the second half of the longer word whole, so a search scheme of
two parts finds all: match a half exactly, then extend across the other half allowing one
error. Both run on a bidirectional FM-index of the words, joined by a delimiter: the
suffix-rank intervals of the text and of its reversal are kept in step, so a match grows
to either side.

The vocabulary is too large for one index. Words are dealt to shards by length and half,
so that a word and all words it can match with that half exact meet in a shard: every
word is looked for with its halves, and stands as text under the halves of a word of its
own length and of one code point more (the longer word of a pair looks for the shorter).
Halves with more than ``HOT`` words are dealt by hash over several shards, all of which
see the words that look there, so the words of a shard stay bounded and none is left out.
"""
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import small, stored

SHARD, HOT = 50_000, 2000  # code points of a shard on average, words of a half that stay together
FRONT, BACK = 0, 1


class Index:
    """Bidirectional FM-index over a list of different words, none of them empty."""

    def __init__(self, words: list[str]):
        text = np.array([0, *[c for w in words for c in (*map(ord, w), 0)]], np.int64)
        self.alphabet, codes = np.unique(text, return_inverse=True)  # the delimiter is 0, the smallest
        self.n, self.letters, self.words = len(codes), len(self.alphabet), len(words)
        self.word_at = np.cumsum(text == 0) - 1  # for a delimiter, number of the word behind it
        self.order = _suffix_order(codes)
        self.first = np.searchsorted(np.sort(codes), np.arange(self.letters + 1))
        back = _suffix_order(codes[::-1].copy())
        self.below = [_counts(codes[self.order - 1], self.letters), _counts(codes[::-1][back - 1], self.letters)]

    def code(self, points):
        """Numbers of code points in the alphabet, -1 for those no word has."""
        at = np.searchsorted(self.alphabet, points)
        at = np.minimum(at, self.letters - 1)
        return np.where(self.alphabet[at] == points, at, -1)

    def start(self, n):
        """``n`` states that match everything: rank in the text, rank in its reversal, size."""
        return np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, self.n, np.int64)

    def extended(self, state, c, side):
        """States after one more symbol in front (``side`` 0) or behind (1)."""
        near, far, size = state if side == 0 else (state[1], state[0], state[2])
        low, high = self.below[side][near], self.below[side][near + size]
        k = np.arange(len(near))
        before = low[k, c]
        inside = high[k, c + 1] - low[k, c + 1] - (high[k, c] - before)
        near = self.first[c] + low[k, c + 1] - before
        far = far + high[k, c] - before
        return (near, far, inside) if side == 0 else (far, near, inside)

    def fan(self, state, side):
        """(index of the state, symbol) of every extension by a symbol but the delimiter."""
        near, size = (state[0] if side == 0 else state[1]), state[2]
        more = self.below[side][near + size] - self.below[side][near]
        at, symbol = np.nonzero(np.diff(more, axis=1)[:, 1:])
        return at, symbol + 1

    def words_of(self, state):
        """Numbers of the words matched with both their delimiters."""
        return self.word_at[self.order[state[0]]]


def _suffix_order(codes):
    """Starts of the rotations of the text in order, by doubling."""
    n, width, rank = len(codes), 1, codes
    while True:
        order = np.lexsort((np.roll(rank, -width), rank))
        step = (rank[order][1:] != rank[order][:-1]) | (np.roll(rank, -width)[order][1:] != np.roll(rank, -width)[order][:-1])
        new = np.zeros(n, np.int64)
        new[order[1:]] = np.cumsum(step)
        width *= 2
        rank = new
        if step.all() or width >= n:
            return order


def _counts(last, letters):
    """Row i, column c: symbols smaller than ``c`` among the first ``i`` of the transform."""
    out = np.zeros((len(last) + 1, letters + 1), np.int32)
    out[np.arange(1, len(last) + 1), last + 1] = 1
    np.cumsum(out, axis=0, out=out)
    np.cumsum(out, axis=1, out=out)
    return out


def _take(state, at):
    return tuple(x[at] for x in state)


def _grown(index, group, column, side):
    """The states of a group that go on with their query's symbol of a column, or the delimiter."""
    query, codes, state = group
    c = np.zeros(len(query), np.int64) if column is None else codes[:, column]
    live = np.flatnonzero(c >= 0)
    state = index.extended(_take(state, live), c[live], side)
    keep = np.flatnonzero(state[2] > 0)
    return query[live[keep]], codes[live[keep]], _take(state, keep)


def _joined(groups):
    return (np.concatenate([g[0] for g in groups]), np.concatenate([g[1] for g in groups]),
            tuple(np.concatenate([g[2][i] for g in groups]) for i in range(3)))


def near_in(index: Index, queries: list[str], half: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of the query, number of the word): one code point of the query replaced or left out.

    Finds the words that keep the first (``FRONT``) or the second half (``BACK``) of the
    query: the first n // 2 code points of its n, or the others. Pairs may repeat.
    """
    found = [np.zeros((0, 2), np.int64)]
    lengths = np.array([len(q) for q in queries], np.int64)
    for n in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == n)
        codes = index.code(np.array([list(map(ord, queries[i])) for i in at], np.int64))
        first, second = [*range(n // 2 - 1, -1, -1)], [*range(n // 2, n)]  # outwards from the middle
        exact, rest, side = (first, second, 1) if half == FRONT else (second, first, 0)
        clean = (at, codes, index.start(len(at)))
        for column in [*exact, None]:
            clean = _grown(index, clean, column, 1 - side)
        wrong = _take(clean[:2], slice(0, 0)) + (_take(clean[2], slice(0, 0)),)
        for column in [*rest, None]:
            fresh = [_grown(index, wrong, column, side)]
            if column is not None:
                query, codes, state = clean
                k, symbol = index.fan(state, side)
                other = np.flatnonzero(symbol != codes[k, column])
                k, symbol = k[other], symbol[other]
                fresh += [(query[k], codes[k], index.extended(_take(state, k), symbol, side)), clean]  # replaced, left out
            clean = _grown(index, clean, column, side)
            wrong = _joined(fresh)
        found.append(np.stack([wrong[0], index.words_of(wrong[2])], axis=1))
    pairs = np.concatenate(found)
    pairs = pairs[pairs[:, 1] < index.words]  # the last delimiter has no word behind it
    return pairs[:, 0], pairs[:, 1]


def _part(n, a, b):
    """SQL for code points ``a`` to ``b`` (exclusive) of a word of ``n``."""
    return f"substring(word, CAST({a} AS INT) + 1, CAST(({b}) - ({a}) AS INT))"


def _keys(vocabulary: DataFrame) -> DataFrame:
    """Four rows a word: the halves that it is looked for with, and stands as text under.

    ``m`` is the length of the word that looks. ``key`` names the exact half; ``finer`` are
    the keys with half of the other half as well, one of which an error leaves whole.
    """
    rows = vocabulary.withColumn("l", F.char_length("word")).select(
        "word", "n", "l", F.explode(F.array(*[
            F.struct(F.lit(half).alias("half"), (F.col("l") + more).alias("m"), F.lit(more == 0).alias("looks"))
            for half in (FRONT, BACK) for more in (0, 1)])).alias("role")).select("word", "n", "l", "role.*")
    a, quarter = "(m div 2)", "(m div 4)"  # ends of the first half and of its first part
    rear = "((m - m div 2) div 2)"  # size of the first part of the second half
    front = _part("l", "0", a)
    back = _part("l", f"l - (m - {a})", "l")
    rows = rows.withColumn("key", F.expr(f"concat_ws('/', half, m, CASE WHEN half = {FRONT} THEN {front} ELSE {back} END)"))
    return rows.withColumn("finer", F.expr(f"""CASE WHEN half = {FRONT} THEN array(
        concat_ws('/', half, m, 'a', {_part("l", "0", f"{a} + {rear}")}),
        concat_ws('/', half, m, 'b', {front}, {_part("l", f"l - (m - {a} - {rear})", "l")}))
      ELSE array(concat_ws('/', half, m, 'a', {_part("l", "0", quarter)}, {back}),
        concat_ws('/', half, m, 'b', {_part("l", f"l - (m - {quarter})", "l")})) END"""))


def _crowded(rows: DataFrame) -> DataFrame:
    """Keys with more than ``HOT`` words and the blocks to deal them to."""
    counts = rows.groupBy("key").agg(F.count("*").alias("words")).filter(F.col("words") > HOT)
    return small(stored(counts.select("key", F.ceil(F.col("words") / HOT).cast("int").alias("blocks"))))


def _dealt(rows: DataFrame, shards: int) -> DataFrame:
    """Rows with their shard. Crowded halves are told apart by finer keys, then by blocks.

    Words of a crowded finer key are dealt to blocks by hash, and each block of words that
    look meets each block of words that stand as text.
    """
    marked = stored(rows.join(_crowded(rows), "key", "left"))
    plain = marked.filter("blocks IS NULL").select("word", "n", "half", "key", "looks", F.lit(True).alias("stands"))
    fine = marked.filter("blocks IS NOT NULL").drop("key", "blocks").withColumn("key", F.explode("finer"))
    fine = fine.join(_crowded(fine), "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    fine = fine.withColumn("own", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    seats = F.array_union(
        F.when(F.col("looks"), F.transform(every, lambda b: F.struct(F.col("own").alias("q"), b.alias("t")))).otherwise(
            F.expr("CAST(array() AS array<struct<q:int,t:int>>)")),
        F.transform(every, lambda b: F.struct(b.alias("q"), F.col("own").alias("t"))))
    fine = fine.withColumn("seat", F.explode(seats)).select(
        "word", "n", "half", F.concat_ws("/", "key", "seat.q", "seat.t").alias("key"),
        (F.col("looks") & (F.col("seat.q") == F.col("own"))).alias("looks"), (F.col("seat.t") == F.col("own")).alias("stands"))
    shard = F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int") * 2 + F.col("half")
    return plain.unionByName(fine).select(shard.alias("shard"), "half", "word", "n", "looks", "stands")


def near_words(vocabulary: DataFrame) -> DataFrame:
    """``word, near, near_n``: the words that are one edit from each word; pairs may repeat.

    ``vocabulary`` has different words and their counts ``n``. The empty word is left out. An
    empty vocabulary has no pairs.
    """
    vocabulary = vocabulary.select("word", "n").filter("word <> ''")
    points = vocabulary.agg(F.sum(F.char_length("word") + 1)).first()[0] or 0
    shards = max(1, -(-2 * points // SHARD))

    def run(pdf):
        texts = pdf[pdf["stands"]].drop_duplicates("word")
        queries = pdf[pdf["looks"]].drop_duplicates("word")
        words, asked = texts["word"].tolist(), queries["word"].tolist()
        q, t = near_in(Index(words), asked, int(pdf["half"].iloc[0]))
        a, b = queries.iloc[q].reset_index(drop=True), texts.iloc[t].reset_index(drop=True)
        out = pd.DataFrame({"word": a["word"], "near": b["word"], "near_n": b["n"]})
        shorter = (a["word"].str.len() != b["word"].str.len()).to_numpy()
        back = pd.DataFrame({"word": b["word"], "near": a["word"], "near_n": a["n"]})[shorter]
        return pd.concat([out, back]).drop_duplicates()

    return _dealt(_keys(vocabulary), shards).groupBy("shard").applyInPandas(run, "word string, near string, near_n long")


def rooted(forms: DataFrame) -> DataFrame:
    """``word, root`` of ``word, form``: forms followed to the last, by doubling the steps.

    Forms must not lead back to a word. NULL forms are dropped.
    """
    step = stored(forms.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        further = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = stored(step.join(further, "root", "left"))
        if not joined.filter("next IS NOT NULL").head(1):
            return joined.select("word", "root")
        step = joined.select("word", F.coalesce("next", "root").alias("root"))


def variants(vocabulary: DataFrame, times: int = 10) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word of ``vocabulary`` (``word, n``).

    ``form`` is the near word of largest ``n`` (of equals the smallest by code point) if that
    is at least ``times`` (more than 1) the word's own, else NULL; ``root`` follows forms to
    the last and is the word itself if it has none. Rows with a NULL word or count are
    dropped, repeated words are summed, other columns are not read. The empty word has no near
    words; an empty vocabulary gives no rows.
    """
    if times <= 1:
        raise ValueError("times must be more than 1, or forms could lead back")
    words = stored(vocabulary.filter("word IS NOT NULL AND n IS NOT NULL").groupBy("word").agg(F.sum("n").cast("long").alias("n")))
    near = near_words(words).groupBy("word").agg(
        F.size(F.collect_set("near")).cast("long").alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("w"))).alias("best"))
    full = -F.col("best.m") >= times * F.col("n")
    found = stored(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(full, F.col("best.w")).alias("form"), F.when(full, -F.col("best.m")).alias("form_n")))
    return found.join(rooted(found), "word", "left").withColumn("root", F.coalesce("root", "word"))


def letter_runs(text: str, least: int = 1) -> Column:
    """Maximal runs of Latin letters of ``least`` or more, A-Z made small; none for NULL."""
    small_letters = F.translate(F.col(f"`{text}`"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(small_letters, F.lit(f"[a-z\u00C0-\u00FF]{{{least},}}"), 0)


def counted(words: DataFrame, least_length: int = 7, least_n: int = 2) -> DataFrame:
    """``word, n``: how often each word of the column ``word`` occurs; rare and short ones go."""
    return (words.filter(F.char_length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n"))
            .filter(F.col("n") >= least_n))
