"""Periodic runs: every run by comparing words at every distance."""
import random

import numpy as np
import pytest

from parlance.llm import periods

CLASHING = "t string, w string, h long, k0 string, runs_ long, doc_id long, text string, n_chars long"


def plain_runs(words, least, times):
    """(start, length, smallest period) by brute force."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i >= q:
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items() if n >= max(least, times * q))


def patchwork(rng):
    """Words with periodic parts of all kinds."""
    words = []
    for _ in range(rng.randint(0, 6)):
        if rng.random() < 0.5:
            words += [rng.choice("abcdefgh") for _ in range(rng.randint(0, 30))]
        else:
            block = [rng.choice("ab") for _ in range(rng.randint(1, 12))]
            words += [block[i % len(block)] for i in range(rng.randint(1, 60))]
    return words


def test_runs_of_random_words():
    rng = random.Random(1)
    for _ in range(600):
        words = [rng.choice("abcde"[:rng.choice([1, 2, 3, 5])]) for _ in range(rng.randint(0, 40))]
        assert [tuple(r) for r in periods.find_runs(words).tolist()] == plain_runs(words, 2, 2)


def test_extensions_equal_a_plain_comparison():
    rng = random.Random(2)
    words = [rng.choice("ab") for _ in range(60)]
    symbols = [1 + (w == "b") for w in words] + [0]
    reach = periods.Extensions(*periods.euler_tour(periods.suffix_tree(symbols), len(symbols)))
    for i in range(len(symbols)):
        for j in range(len(symbols)):
            if i != j:
                same = 0
                while max(i, j) + same < len(symbols) and symbols[i + same] == symbols[j + same]:
                    same += 1
                assert reach.of(np.array([i]), np.array([j]))[0] == same


def test_stretches_lose_no_run():
    rng = random.Random(3)
    docs = [patchwork(rng) for _ in range(800)]
    found, collapsed = periods._of_texts([" ".join(d) for d in docs], 24, 3)
    for words, got, text in zip(docs, found, collapsed):
        want = plain_runs(words, 24, 3)
        assert [tuple(r) for r in got] == want
        gone = {i for s, n, q in want for i in range(s + q, s + n)}
        assert text == " ".join(w for i, w in enumerate(words) if i not in gone)


def test_edges(spark):
    block = " ".join(f"w{i}" for i in range(5000))
    rows = [(None, None), (1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "x " * 24), (5, "x " * 24), (6, "x " * 23),
            (7, "a\u00a0b c " * 13), (8, f"{block} {block} {block}"), (9, "A a " * 12)]
    df = spark.createDataFrame([("t", "w", 1, "k", 2, i, t, 3) for i, t in rows], CLASHING)
    out = periods.collapsed_runs(df, keep=["doc_id", "k0", "t"])
    assert out.columns == ["doc_id", "k0", "t", "runs", "collapsed"]
    got = [(r["doc_id"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in out.collect()]
    assert sorted(g[0] or 0 for g in got) == sorted(i or 0 for i, _ in rows)
    by_id = {g[0]: g[1:] for g in got}
    assert by_id[None] == by_id[1] == by_id[2] == by_id[3] == ([], "")
    assert by_id[4] == ([], "one two") and by_id[6][0] == []
    assert by_id[5] == ([(0, 24, 1)], "x") and by_id[7] == ([(0, 26, 2)], "a\u00a0b c")
    assert by_id[8] == ([(0, 15000, 5000)], block) and by_id[9] == ([(0, 24, 2)], "A a")
    assert periods.collapsed_runs(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periods.collapsed_runs(df, least=10)


def test_strongest_run(spark):
    rows = [(1, [(0, 24, 8), (30, 48, 16), (90, 30, 10)]), (2, [(5, 24, 3), (40, 80, 10)]), (3, [])]
    df = spark.createDataFrame(rows, f"i int, runs array<{periods.RUN}>")
    best = {r["i"]: r["b"] and tuple(r["b"]) for r in df.select("i", periods.strongest().alias("b")).collect()}
    assert best == {1: (0, 24, 8), 2: (5, 24, 3), 3: None}
