"""Spelling variants: every pair by comparing all words, shards and halves made small."""
import random

import pytest

from parlance.llm import spelling

CLASHING = "key string, l int, m int, shard int, word string, n long, near string, root string, blocks int"


def near(a, b):
    """Exactly one code point inserted, deleted or replaced."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def some_words(rng, n, letters, low, high):
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(low, high))) for _ in range(n)}
    return sorted(words)


def test_one_index_finds_all_pairs():
    rng = random.Random(1)
    for letters, low, high in [("ab", 1, 9), ("abcé", 2, 7), ("aüß😀", 3, 6)]:
        words = some_words(rng, 250, letters, low, high)
        index = spelling.Index(words)
        asked = words + some_words(rng, 60, letters + "z", low, high)
        found = set()
        for half in (spelling.FRONT, spelling.BACK):
            q, t = spelling.near_in(index, asked, half)
            got = {(asked[i], words[j]) for i, j in zip(q, t)}
            for a, b in got:
                cut = len(a) // 2
                assert b.startswith(a[:cut]) if half == spelling.FRONT else b.endswith(a[cut:])
            found |= got
        assert found == {(a, b) for a in asked for b in words if near(a, b) and len(a) >= len(b)}


def test_intervals_are_the_places_of_a_pattern():
    words = ["banana", "ananas", "nab", "an"]
    index = spelling.Index(words)
    text = "$" + "$".join(words) + "$"
    for pattern in ("an", "ana", "nan", "a", "$an", "an$", "bab"):
        for order in (0, 1):
            state = index.start(1)
            for ch in pattern[::-1] if order == 0 else pattern:
                state = index.extended(state, index.code([0 if ch == "$" else ord(ch)]), order)
            places = [i for i in range(len(text)) if (text + text)[i:i + len(pattern)] == pattern]
            assert sorted(index.order[state[0][0]:state[0][0] + state[2][0]]) == places


def expected(counts, times=10):
    near_to = {w: [v for v in counts if near(w, v)] for w in counts}
    form = {}
    for w, found in near_to.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= times * counts[w] else None
    def root(w):
        return w if form[w] is None else root(form[w])
    return sorted((w, n, len(near_to[w]), form[w], counts[form[w]] if form[w] else None, root(w)) for w, n in counts.items())


@pytest.mark.parametrize("shard,hot", [(50_000, 2000), (600, 25), (400, 4)])
def test_variants_equal_brute_force(spark, monkeypatch, shard, hot):
    monkeypatch.setattr(spelling, "SHARD", shard)
    monkeypatch.setattr(spelling, "HOT", hot)
    rng = random.Random(shard)
    # a third of the words share their first half, and many of these also the next letters
    words = some_words(rng, 120, "abcé", 2, 9) + ["common" + w for w in some_words(rng, 60, "ab", 4, 7)]
    words += [w + "ending" for w in some_words(rng, 40, "xy", 4, 7)]
    counts = {w: rng.choice([1, 2, 10, 25, 100, 1000, 30000]) for w in words}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = sorted((tuple(r) for r in spelling.variants(df).collect()), key=lambda r: r[0])
    assert got == expected(counts)


def test_chains_are_followed(spark):
    words = ["a" * k for k in range(3, 20)]
    counts = {w: 10 ** i for i, w in enumerate(words)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert {r["root"] for r in spelling.variants(df).collect()} == {words[-1]}


def test_edges(spark):
    rows = [("k", 1, 2, 3, w, n, "x", "y", 4) for w, n in [
        ("aaaaaaa", 5), ("aaaaaaa", 5), (None, 3), ("bb", None), ("a", 7), ("b", 700), ("", 900), ("x" * 3000, 1), ("x" * 2999, 50),
        ("tieaaaa", 100), ("tiebaaa", 1), ("tiecaaa", 100)]]
    got = {r["word"]: tuple(r)[1:] for r in spelling.variants(spark.createDataFrame(rows, CLASHING)).collect()}
    assert got == {
        "aaaaaaa": (10, 0, None, None, "aaaaaaa"), "a": (7, 1, "b", 700, "b"), "b": (700, 1, None, None, "b"),
        "": (900, 0, None, None, ""), "x" * 3000: (1, 1, "x" * 2999, 50, "x" * 2999), "x" * 2999: (50, 1, None, None, "x" * 2999),
        "tieaaaa": (100, 2, None, None, "tieaaaa"), "tiecaaa": (100, 2, None, None, "tiecaaa"),
        "tiebaaa": (1, 2, "tieaaaa", 100, "tieaaaa")}
    assert spelling.variants(spark.createDataFrame([], CLASHING)).count() == 0
    with pytest.raises(ValueError):
        spelling.variants(spark.createDataFrame([], CLASHING), times=1)


def test_words_of_texts(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "Öl ABCDEFG abcdefg1hijklmnop ÉÉÉÉÉÉÉ×÷"), (4, "abcdefg x")], "i int, t string")
    runs = {r["i"]: r["w"] for r in df.select("i", spelling.letter_runs("t", 7).alias("w")).collect()}
    assert runs == {1: None, 2: [], 3: ["abcdefg", "abcdefg", "hijklmnop", "ÉÉÉÉÉÉÉ×÷"], 4: ["abcdefg"]}
    words = df.selectExpr("explode(split(lower(t), '[^a-z]')) AS word")
    assert [tuple(r) for r in spelling.counted(words).collect()] == [("abcdefg", 3)]
