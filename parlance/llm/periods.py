"""Periodic runs of words inside a text, and texts with the repetition taken out.

A run is a stretch of words with smallest period q that holds at least three periods and
that no neighbouring word extends. The longest common extensions that bound a run are
read from two suffix trees, of the words and of the words reversed, built by Ukkonen's
algorithm: two leaves agree up to their lowest common ancestor, found in constant time
as the least depth of the Euler tour between them. Every run has a Lyndon word (in the
order of the words or in the reversed order) as a root, so the longest Lyndon words that
start at each place are all candidates; each is extended in both directions.

Trees are built only where a run can be. With three periods and 24 words or more, every
window of ``WINDOW`` words inside a run stands in that run again, one period apart, so
only stretches whose windows all come twice or more in the stretch are looked at. This
leaves no run out: windows are compared by hash, and equal words have equal hashes.
"""
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import Hasher, buffers, is_space, owners, runs, windows

LEAST, TIMES, WINDOW = 24, 3, 8
RUN = "struct<start:bigint,length:bigint,period:bigint>"


def suffix_tree(symbols: list[int]) -> tuple[np.ndarray, ...]:
    """Edges of the suffix tree of ``symbols``, which end with a symbol found nowhere else.

    Ukkonen's algorithm. Returns parent, first symbol, start and end of the label of each
    node's edge; node 0 is the root.
    """
    n, wide = len(symbols), max(symbols) + 1
    start, stop, link, edges = [0], [0], [0], {}
    node = edge = length = waiting = 0
    for i, symbol in enumerate(symbols):
        waiting += 1
        inner = 0  # inner node of this step that still lacks its link
        while waiting:
            if not length:
                edge = i
            key = node * wide + symbols[edge]
            child = edges.get(key)
            if child is None:
                edges[key] = len(start)
                start.append(i)
                stop.append(n)
                link.append(0)
                if inner:
                    link[inner] = node
                inner = 0
            else:
                s = start[child]
                span = stop[child]
                span = (span if span <= i else i + 1) - s
                if length >= span:
                    node = child
                    edge += span
                    length -= span
                    continue
                if symbols[s + length] == symbol:
                    length += 1
                    if inner:
                        link[inner] = node
                    break
                middle = len(start)
                edges[key] = middle
                start += (s, i)
                stop += (s + length, n)
                link += (0, 0)
                edges[middle * wide + symbol] = middle + 1
                start[child] = s + length
                edges[middle * wide + symbols[s + length]] = child
                if inner:
                    link[inner] = middle
                inner = middle
            waiting -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - waiting + 1
    keys = np.fromiter(edges.keys(), np.int64, len(edges))
    child = np.fromiter(edges.values(), np.int64, len(edges))
    parent, first = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
    parent[child], first[child] = keys // wide, keys % wide
    return parent, first, np.array(start), np.array(stop)


def euler_tour(tree, n: int, descending: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Rank of every suffix, and the least depth of the tour between neighbouring leaves.

    Children are visited by first symbol, the end symbol (0) first also if ``descending``.
    """
    parent, first, start, stop = tree
    nodes = np.arange(1, len(parent))
    order = nodes[np.lexsort((-first[nodes] if descending else first[nodes], first[nodes] != 0, parent[nodes]))]
    bounds = np.searchsorted(parent[order], np.arange(len(parent) + 1)).tolist()
    order, label = order.tolist(), (stop - start).tolist()
    ranks, gaps = np.zeros(n, np.int64), np.zeros(n, np.int32)
    depth, stack, low, seen = [0] * len(parent), [0], 0, 0
    cursor = bounds[:-1]
    while stack:
        node = stack[-1]
        at = cursor[node]
        if at < bounds[node + 1]:
            cursor[node] = at + 1
            child = order[at]
            depth[child] = depth[node] + label[child]
            stack.append(child)
            continue
        stack.pop()
        if bounds[node] == bounds[node + 1]:  # a leaf
            ranks[n - depth[node]] = seen
            gaps[seen] = low
            seen += 1
            low = n
        if stack:
            low = min(low, depth[stack[-1]])
    return ranks, gaps


class Extensions:
    """Longest common extensions of suffixes, each in constant time."""

    def __init__(self, ranks, gaps):
        self.ranks, self.least = ranks, [gaps]
        while 2 << (len(self.least) - 1) <= len(gaps):
            half = 1 << (len(self.least) - 1)
            last = self.least[-1]
            self.least.append(np.minimum(last[:-half], last[half:]))

    def of(self, a, b):
        """Words that the suffixes at ``a`` and ``b`` have in common; ``a != b``."""
        x, y = self.ranks[a], self.ranks[b]
        low, high = np.minimum(x, y) + 1, np.maximum(x, y)
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        out = np.zeros(len(low), np.int64)
        for k in np.unique(level):
            at = level == k
            table = self.least[k]
            out[at] = np.minimum(table[low[at]], table[high[at] - (1 << int(k)) + 1])
        return out


def next_smaller(ranks) -> np.ndarray:
    """End of the longest Lyndon word that starts at each place but the last."""
    ranks = ranks.tolist()
    ends, stack = [0] * (len(ranks) - 1), [len(ranks) - 1]
    for i in range(len(ranks) - 2, -1, -1):
        rank = ranks[i]
        while ranks[stack[-1]] > rank:
            stack.pop()
        ends[i] = stack[-1]
        stack.append(i)
    return np.array(ends, np.int64)


def find_runs(words, least: int = 2, times: int = 2) -> np.ndarray:
    """Rows (start, length, period) of all runs of a list of hashable words, by start and period.

    Only runs of at least ``least`` words and ``times`` periods, ``times`` at least 2.
    """
    n = len(words)
    if n < 2:
        return np.zeros((0, 3), np.int64)
    number = {}
    symbols = [number.setdefault(w, len(number) + 1) for w in words]
    tree = suffix_tree(symbols + [0])
    ranks, gaps = euler_tour(tree, n + 1)
    first = np.tile(np.arange(n), 2)
    end = np.concatenate([next_smaller(ranks), next_smaller(euler_tour(tree, n + 1, True)[0])])
    del tree
    right = Extensions(ranks, gaps).of(first, end)
    back = euler_tour(suffix_tree(symbols[::-1] + [0]), n + 1)
    left = Extensions(*back).of(n - first, n - end)
    period = end - first
    found = np.stack([first - left, period + left + right, period], axis=1)
    found = found[(found[:, 1] >= times * period) & (found[:, 1] >= least)]
    found = np.unique(found, axis=0)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _repeated(h, owner):
    """True for the windows that come twice or more under one owner."""
    order = np.lexsort((h, owner))
    same = (h[order][1:] == h[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    twice = np.zeros(len(h), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    return twice


def stretches(hashes, owner, least: int = LEAST) -> list[tuple[int, int]]:
    """(start, end) of the stretches of words that can hold a run of ``least`` words."""
    h, of, at = windows(hashes, owner, WINDOW)
    fewest = least - WINDOW + 1
    while len(h):
        # neighbouring windows of one text that all come again
        part = np.cumsum(np.concatenate([[True], (np.diff(at) != 1) | (np.diff(of) != 0)])) - 1
        keep = _repeated(h, part) & (np.bincount(part)[part] >= fewest)
        if keep.all():
            break
        h, of, at = h[keep], of[keep], at[keep]
    if not len(h):
        return []
    cut = np.flatnonzero((np.diff(at) != 1) | (np.diff(of) != 0))
    firsts, lasts = np.concatenate([[0], cut + 1]), np.concatenate([cut, [len(at) - 1]])
    return [(int(at[a]), int(at[b]) + WINDOW) for a, b in zip(firsts, lasts)]


def _of_texts(texts, least, times):
    """Runs and collapsed text of every text of a batch."""
    hasher = Hasher()
    found, collapsed = [[] for _ in texts], [""] * len(texts)
    for at, buf, t0, t1 in buffers(texts):
        w0, w1 = runs(~is_space(buf))
        owner = owners(t0, w0)
        first_word = np.searchsorted(owner, np.arange(len(at) + 1))
        raw = buf.tobytes()
        per_text = {}
        for a, b in stretches(hasher.spans(buf, w0, w1), owner, least):
            words = [raw[x:y] for x, y in zip(w0[a:b].tolist(), w1[a:b].tolist())]
            here = find_runs(words, least, times)
            if len(here):
                of = int(owner[a])
                here[:, 0] += a - first_word[of]
                per_text.setdefault(of, []).append(here)
        for of, place in enumerate(at.tolist()):
            words = raw[t0[of]:t1[of]].split()
            if of in per_text:
                every = np.concatenate(per_text[of])
                every = every[np.lexsort((every[:, 2], every[:, 0]))]
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, every[:, 0] + every[:, 2], 1)
                np.add.at(edge, every[:, 0] + every[:, 1], -1)
                words = [w for w, over in zip(words, np.cumsum(edge[:-1]).tolist()) if not over]
                found[place] = every.tolist()
            collapsed[place] = b" ".join(words).decode("utf-8", "replace")
    return found, collapsed


def collapsed_runs(df: DataFrame, text: str = "text", keep=("doc_id",), least: int = LEAST, times: int = TIMES) -> DataFrame:
    """``keep`` columns, ``runs`` of the whole text and the text ``collapsed`` to one period each.

    ``runs`` holds (start, length, period) in words from 0 by start, then period: all runs of
    ``least`` words or more (at least 24) with ``times`` periods or more (at least 3). A word
    is dropped if a run holds it after that run's first period; the words left are joined by
    one space. Words are ``[^\\x20\\x09-\\x0D]+``.

    NULL, empty and blank texts have no runs and collapse to an empty text. Rows are neither
    merged nor dropped, so repeated rows and NULL ids stay; other columns are not read, and
    kept ones may have any name but ``runs`` and ``collapsed``. A text is worked on whole;
    the trees take about 500 bytes for each word of its longest periodic stretch.
    """
    if least < LEAST or times < TIMES:
        raise ValueError(f"runs of fewer than {LEAST} words or {TIMES} periods need find_runs")
    keep = list(keep)
    inner = df.select(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keep)], F.col(f"`{text}`").alias("t"))
    kept = inner.drop("t").schema.fields
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in kept] + [f"runs array<{RUN}>", "collapsed string"])
    names = [f.name for f in kept]
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches):
        for batch in batches:
            found, collapsed = _of_texts(batch.column("t").to_pylist(), least, times)
            flat = np.array([r for each in found for r in each], np.int64).reshape(-1, 3)
            ends = np.cumsum([0] + [len(each) for each in found]).astype(np.int32)
            spans = pa.ListArray.from_arrays(
                pa.array(ends), pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], fields=list(run_type)))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], spans, pa.array(collapsed, pa.string())], names=[*names, "runs", "collapsed"])

    out = inner.mapInArrow(run, schema)
    return out.select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(keep)], "runs", "collapsed")


def strongest(runs_col: str = "runs") -> Column:
    """The run with the greatest length / period; of equals the first by start, then period."""
    no_run = F.lit(None).cast(RUN)
    return F.aggregate(runs_col, no_run, lambda best, r: F.when(
        best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))
