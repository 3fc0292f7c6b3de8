"""Operators against brute force, exact round trips and held-out accuracy."""
import hashlib
import html
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from parlance.llm import chat, components, mixing, neardup, neighbours, packing, pii, quality, tokens, toxicity, urls, wrappers
from parlance.llm.checks import CHECKS

SF = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(spark, name, sf=SF):
    return spark.read.parquet(f"{sf}/{name}.parquet")


# -- quality rules

def brute_measures(t):
    w = WORD.findall(t)
    tri = Counter(zip(w, w[1:], w[2:]))
    covered = {p for i in range(len(w) - 2) if tri[w[i], w[i + 1], w[i + 2]] > 1 for p in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return [len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered)]


def test_measures_of_random_texts():
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab \n\t#é漢!") for _ in range(rng.randint(0, 80))) for _ in range(2000)]
    got = quality._measure(texts)
    at = [quality.MEASURES.index(m) for m in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    assert got[:, at].tolist() == [brute_measures(t) for t in texts]


def test_ablations_agree_with_the_ledger(spark):
    book = quality.ledger(table(spark, "documents"))
    failed = [r["failed"] & quality.policy_mask("v1") for r in book.collect()]
    for r in quality.ablations(book, "v1").collect():
        b = quality.bit(r["rule"])
        assert r["fails"] == sum(f & b > 0 for f in failed)
        assert r["fails_only_this"] == sum(f == b for f in failed)
        assert r["kept_without"] == sum(f in (0, b) for f in failed)


def test_policy_keeps_good_documents(spark):
    labelled = table(spark, "documents", "/root/testdata/sf0.01").join(table(spark, "labels", "/root/testdata/sf0.01"), "doc_id")
    book = quality.ledger(labelled, keep=("quality",)).filter("n_words >= 50").groupBy("quality").agg(
        F.avg(quality.verdict("v1").cast("int")).alias("kept"))
    kept = {r["quality"]: r["kept"] for r in book.collect()}
    assert kept[1] > 0.98 and kept[0] < 0.05


# -- near-duplicates

def brute_groups(texts, width, percent):
    sets = {}
    for i, t in texts.items():
        w = WORD.findall(t.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
        sets[i] = {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} or ({tuple(w)} if w else set())
    parent = {i: i for i in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for x in keys:
        for y in keys:
            if x < y and sets[x] and sets[y]:
                k = len(sets[x] & sets[y])
                if 100 * k >= percent * (len(sets[x]) + len(sets[y]) - k):
                    a, b = find(x), find(y)
                    parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in texts}


def near_copies(seed=3):
    """Families of texts: copies with some words changed, copies of copies, texts with a shared passage."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    out, passage = [], text(80)
    for _ in range(12):
        base = text(rng.randint(40, 300))
        family = [base]
        for _ in range(12):
            copy = list(rng.choice(family))
            for _ in range(rng.randint(0, max(1, len(copy) // 25))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            family.append(copy)
        out += family
    out += [passage + text(20) for _ in range(25)] + [text(k) for k in (1, 2, 3, 4, 5, 6)] * 2
    rng.shuffle(out)
    return {i: " ".join(w) for i, w in enumerate(out)}


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_groups_of_near_copies(spark, width, percent):
    texts = near_copies()
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(df, width=width, percent=percent).collect()}
    assert got == brute_groups(texts, width, percent)


def test_links_beside_the_centres_of_large_buckets(spark):
    """Hundreds of texts just under the threshold to each other, with true pairs among them."""
    rng = random.Random(5)
    words = lambda n: [f"w{rng.randrange(10 ** 6)}" for _ in range(n)]
    passage, out = words(602), []
    for _ in range(100):  # 600 of 714 shingles are shared with the family, 608 of 706 with a partner
        near = words(8)
        out += [passage + near + words(49), passage + near + words(49), passage + words(57)]
    rng.shuffle(out)
    texts = {i: " ".join(w) for i, w in enumerate(out)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want = brute_groups(texts, 3, 85)
    assert sum(i != c for i, (_, c) in want.items()) == 100
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(df).collect()} == want


def test_few_pairs_of_a_family_under_the_threshold(spark, monkeypatch):
    """Copies of one text with eight words changed, each to one of three words, and some true pairs."""
    rng = random.Random(8)
    base, out = [f"w{i}" for i in range(150)], []
    for _ in range(120):
        copy = list(base)
        for k in rng.sample(range(150), 8):
            copy[k] = f"x{k}-{rng.randrange(3)}"
        out.append(copy)
    for copy in out[:10]:
        out.append(copy[:-1] + ["y"])
    texts = {i: " ".join(w) for i, w in enumerate(out)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    across, pairs = neardup._across, []
    monkeypatch.setattr(neardup, "_across", lambda *given: (pairs.append(across(*given).count()), across(*given))[1])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(df).collect()}
    want = brute_groups(texts, 3, 85)
    assert got == want and sum(i != c for i, (_, c) in want.items()) >= 10
    assert pairs[0] < 2 * len(texts)  # of 8,385; the prefix and its places alone leave most of them


def test_parity_bits_never_count_more_than_the_difference():
    rng = np.random.default_rng(1)
    for size in (0, 1, 50, 5000):
        a = np.unique(rng.integers(0, 2 ** 64, size, dtype=np.uint64))
        b = np.union1d(a[::2], rng.integers(0, 2 ** 64, size // 3, dtype=np.uint64))
        apart = sum(int(x).bit_count() for x in (neardup.parity(a) ^ neardup.parity(b)).view(np.uint64))
        assert len(neardup.parity(a)) == neardup.PARITY and apart <= len(np.setxor1d(a, b)) and (size or not apart)


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(200, 200), (300, 299), (299, 300), (None, 1)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 160)}, 299: 299, 300: 299}


def test_densified_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    edges, probes = neardup.bin_edges(120), neardup._probe(120, 0)
    for size in (5, 40, 900):
        agree = []
        for _ in range(60):
            pool = np.unique(rng.integers(0, 2 ** 64, size, dtype=np.uint64))
            a, b = pool, pool[: int(size * 0.8)]
            agree.append((neardup.signature(a, edges, probes) == neardup.signature(b, edges, probes)).mean())
        assert np.mean(agree) == pytest.approx(0.8, abs=0.04)


# -- pseudonyms

def py_feistel(a, b, p, q, key, kind):
    draw = lambda r, v, n: int(hashlib.sha256(f"{key}|{kind}|{r}|{v}".encode()).hexdigest()[:15], 16) % n
    for r in range(pii.ROUNDS):
        if r % 2 == 0:
            a = (a + draw(r, b, p)) % p
        else:
            b = (b + draw(r, a, q)) % q
    return a, b


def luhn(d):
    return sum(x if i % 2 == 0 else (2 * x) % 10 + (2 * x) // 10 for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def pseudonyms(spark, values, key="k"):
    df = spark.createDataFrame(list(enumerate(values)), "doc_id int, text string")
    return [r["text"] for r in pii.pseudonymised(df, key).orderBy("doc_id").collect()]


def test_numbers_equal_a_plain_feistel_network(spark):
    rng = random.Random(5)
    cards, ips = [], [f"{rng.randrange(256)}.{rng.randrange(256)}.{rng.randrange(256)}.{rng.randrange(256)}" for _ in range(60)]
    while len(cards) < 60:
        d = "4" + "".join(rng.choice("0123456789") for _ in range(15))
        cards += [d] if luhn(d) else []
    got = pseudonyms(spark, cards + ips)
    for old, new in zip(cards, got):
        a, b = py_feistel(int(old[1:8]), int(old[8:15]), 10 ** 7, 10 ** 7, "k", "card")
        assert new[:15] == f"4{a:07d}{b:07d}" and luhn(new)
    for old, new in zip(ips, got[60:]):
        o = list(map(int, old.split(".")))
        a, b = py_feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, "k", "ip")
        assert new == f"{a // 256}.{a % 256}.{b // 256}.{b % 256}"


def test_formats_stay_and_values_stay_apart(spark):
    rng = random.Random(6)
    dates = [f"{y}-{m:02d}-{d:02d}" for y in (1900, 1984, 2000, 2023, 2096) for m in (1, 2, 12) for d in (1, 28)]
    phones = [f"+1 ({a}) 555-{rng.randrange(10000):04d}" for a in rng.sample(range(200, 1000), 40)]
    mails = [f"a{i}.b@mail{i % 3}.example.com" for i in range(40)]
    secrets = [f"password={i:06d}abcXYZ" for i in range(40)]
    for values, pattern in ((dates, r"\d{4}-\d{2}-\d{2}"), (phones, r"\+1 \([2-9]\d{2}\) [2-9]\d{2}-\d{4}"),
                            (mails, r"[a-z]\d{1,2}\.[a-z]@[a-z]{4}\d\.[a-z]{7}\.com"), (secrets, r"password=\d{6}[a-z]{3}[A-Z]{3}")):
        got = pseudonyms(spark, values)
        assert all(re.fullmatch(pattern, g) for g in got), got[:3]
        assert len(set(got)) == len(values) and not set(got) & set(values)
        assert got == pseudonyms(spark, values) and got != pseudonyms(spark, values, "other")
    hosts = defaultdict(set)
    for old, new in zip(mails, pseudonyms(spark, mails)):
        hosts[old.split("@")[1]].add(new.split("@")[1])
    assert all(len(h) == 1 for h in hosts.values())


def test_only_valid_values_change(spark):
    stays = ["4041894974608796", "300.1.1.1", "2023-13-45", "000-12-3456", "version 1.2.3", "3.14 12 2024", "a@b", "nothing here"]
    assert pseudonyms(spark, stays) == stays


def test_values_are_linked_across_texts(spark):
    a, b = pseudonyms(spark, ["call +1 (988) 555-2485 now, card 4041894974608795.", "4041894974608795 or +1 (988) 555-2485"])
    assert re.search(r"card (\d{16})", a)[1] == b[:16] and re.search(r"\+1 .{14}", a)[0] == b[20:]
    assert a.startswith("call +1 (") and a.endswith(".") and " now, card " in a


# -- mixing

def brute_targets(sizes, weights=(1, 2, 3), cap=3):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    stopped, total = set(), sum(sizes.values())
    while True:
        level = (total - sum(cap * sizes[s] for s in stopped)) / sum(w[s] for s in names if s not in stopped)
        over = {s for s in names if s not in stopped and w[s] * level > cap * sizes[s]}
        if not over:
            return {s: cap * sizes[s] if s in stopped else w[s] * level for s in names}
        stopped |= over


def test_mix_meets_targets(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.choice([1, 3, 10, 30, 100, 400])), rng.choice(["a", "a", "a", "a", "b", None, "é", "Z"])) for i in range(900)]
    rows += [(1000 + i, "w " * 5, "tiny") for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df).select("doc_id", "source", "mix_.*").collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(t.split())
    targets, taken = brute_targets(sizes), Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(targets[r["source"]], rel=1e-9)
        assert r["taken"] <= 3 * r["size"] and abs(r["copies"] - r["rate"]) <= 1.0 + 1e-9
        taken[r["source"]] += r["taken"]
    for s, t in targets.items():
        assert abs(taken[s] - t) <= max(0.01 * t, 5)
    assert sum(targets.values()) == pytest.approx(sum(sizes.values()))
    assert targets["tiny"] == 45  # a source at its cap
    again = mixing.mix(df.repartition(7)).select("doc_id", "mix_.taken").collect()
    assert {r[0]: r[1] for r in again} == {r["doc_id"]: r["taken"] for r in got}


def test_rows_of_one_id_are_split_by_counts(spark):
    """Equal ids, and rows equal throughout, take as many copies as the target needs, not all or none."""
    rows = [(None, f"{i} " + "w " * 9, "a") for i in range(300)] + [(7, "v " * 10, "b")] * 500
    rows += [(None, "x " * 10, None)] * 700
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df.repartition(5)).groupBy("source").agg(
        F.max("mix_.target").alias("target"), F.sum("mix_.taken").alias("taken"),
        F.max("mix_.copies").alias("most"), F.min("mix_.copies").alias("least"), F.count("*").alias("n")).collect()
    assert {r["source"]: r["n"] for r in got} == {"a": 300, "b": 500, None: 700}
    for r in got:
        assert abs(r["taken"] - r["target"]) <= 10 and r["most"] - r["least"] <= 1
    # The rows that took one more are the same in any order of the table.
    taken = [sorted(map(tuple, mixing.mix(d).select(F.hash("doc_id", "text"), "mix_.copies").collect()))
             for d in (df, df.repartition(3, "text"))]
    assert taken[0] == taken[1]


def test_rates_solve_the_dual(spark):
    """At the optimum log(rate * (cap - 1) / (cap - rate)) is proportional to the size."""
    counts = spark.createDataFrame([("a", s, 10) for s in (5, 20, 50, 200)] + [("b", 7, 3), ("b", 90, 4)], "source string, size long, n long")
    targets = spark.createDataFrame([("a", 2750, 5000.0), ("b", 381, 100.0)], "source string, source_size long, target double")
    rows = mixing.balanced_rates(counts, targets).collect()
    for source, target in (("a", 5000.0), ("b", 100.0)):
        own = [r for r in rows if r["source"] == source]
        assert sum(r["rate"] * r["size"] * r["n"] for r in own) == pytest.approx(target, rel=1e-8)
        tilt = [math.log(2 * r["rate"] / (3 - r["rate"])) / r["size"] for r in own]
        assert max(tilt) == pytest.approx(min(tilt), rel=1e-6)


def test_new_segments_are_encoded_many_at_a_time():
    rng = random.Random(6)
    letters = "abcdefgh\u00e9\u4e2d\U0001f600'"
    texts = [" ".join("".join(rng.choices(letters, k=rng.randint(1, 9))) + rng.choice(["", ",", ".;", "'s", "\u3000", "\n"])
                      for _ in range(300)) for _ in range(6)]
    texts += ["x<|endoftext|> y <|endoftext|>z", "a  b \t\n c\u00a0 \n d\u0085 e", " \n ", "", None]
    encoder, plain = tokens.Encoder(TOKENIZER), Tokenizer.from_file(TOKENIZER)
    given, learned = [], []

    class Counting:
        def encode_batch_fast(self, batch, **options):
            given.extend(batch)
            return plain.encode_batch_fast(batch, **options)

    learn = encoder._learn
    encoder.tokenizer = Counting()
    encoder._learn = lambda keys, segments: (learned.extend(segments), learn(keys, segments))
    for i, ids in encoder.encoded(texts):
        assert ids.tolist() == plain.encode(texts[i] or "", add_special_tokens=False).ids, texts[i]
    assert len(given) < len(learned) / 3  # one each before
    encoder.clear()
    encoder.width = encoder.width * 0 + 1  # bytes that fit no segment: each is encoded alone
    for i, ids in encoder.encoded(texts):
        assert ids.tolist() == plain.encode(texts[i] or "", add_special_tokens=False).ids, texts[i]


def test_a_full_table_of_segments_keeps_the_common_ones(monkeypatch):
    """Common segments are learned once, however many rare ones come between; before, each new table learned them again."""
    monkeypatch.setattr(tokens, "ENTRIES", 400)
    monkeypatch.setattr(tokens, "POOL", 4000)
    rng = random.Random(8)
    common = ["".join(rng.choices("abcd\u00e9", k=5)) for _ in range(60)]
    encoder, plain, learned = tokens.Encoder(TOKENIZER), Tokenizer.from_file(TOKENIZER), Counter()
    learn = encoder._learn
    encoder._learn = lambda keys, segments: (learned.update(s if isinstance(s, bytes) else s.encode() for s in segments), learn(keys, segments))
    for k in range(40):
        text = " ".join(["x"] + common + [f"w{k}q{i}" for i in range(100)] + ["long" * 300])
        (_, ids), = encoder.encoded([text])
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids
    assert {learned[f" {w}".encode()] for w in common} == {1}


# -- packing

def test_ids_by_segments_equal_the_tokenizer():
    rng = random.Random(2)
    texts = ["".join(rng.choice(" \n\t\r\x0b\x1c\x85 　'abzéß漢12!?") for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    texts += [None, "", "it's  we'll\n\n 's", "a<|endoftext|>b <|endoftext|> x"]
    whole = Tokenizer.from_file(TOKENIZER)
    for i, ids in tokens.Encoder(TOKENIZER).encoded(texts):
        assert ids.tolist() == whole.encode(texts[i] or "", add_special_tokens=False).ids


def test_packing_is_complete_and_tight(spark):
    docs = table(spark, "documents")
    rows = packing.pack(docs, TOKENIZER).collect()
    whole = Tokenizer.from_file(TOKENIZER)
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        bins[r["sequence_id"]].append(r)
    for d in docs.collect():
        ids = [*whole.encode(d["text"], add_special_tokens=False).ids, 0]
        own = sorted(pieces.pop(d["doc_id"]), key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own)))
        assert [r["start"] for r in own] == [sum(x["length"] for x in own[:k]) for k in range(len(own))]
        assert all(r["length"] == 2048 for r in own[1:]) and sum(r["length"] for r in own) == len(ids)
        for r in own:
            part = np.array(ids[r["start"]:r["start"] + r["length"]], "<u4")
            assert r["ids_crc32"] == zlib.crc32(part.tobytes())
    assert not pieces
    for own in bins.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
    bound = packing.lower_bound(np.array([r["length"] for r in rows]), 2048)
    assert bound <= len(bins) <= bound + 1


def test_certificate_states_the_gap(spark):
    rows = spark.createDataFrame([(n, s) for n, s in [(1500, 0), (500, 0), (1500, 1), (48, 1), (1500, 2), (2048, 3)]], "length long, sequence_id long")
    assert tuple(packing.certificate(rows).first()) == (6, 4, 4, 0)
    assert tuple(packing.certificate(rows.limit(0)).first()) == (0, 0, 0, 0)


def test_bounds_hold_and_rounds_exchange(spark, monkeypatch):
    rng = np.random.default_rng(1)
    for _ in range(200):
        lengths = rng.integers(1, 101, rng.integers(1, 60))
        bins, count = packing.best_fit_decreasing(lengths, 100)
        assert np.bincount(bins, weights=lengths).max() <= 100
        assert -(-lengths.sum() // 100) <= packing.lower_bound(lengths, 100) <= count
    assert packing.lower_bound(np.array([51, 51, 51]), 100) == 3
    monkeypatch.setattr(packing, "PART_ROWS", 30)
    rows = packing.pack(table(spark, "documents"), TOKENIZER).collect()
    assert len({(r["doc_id"], r["piece"]) for r in rows}) == len(rows)
    assert len({r["sequence_id"] for r in rows}) <= 1.05 * packing.lower_bound(np.array([r["length"] for r in rows]), 2048)


# -- toxicity

def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs = table(spark, "documents", sf).join(table(spark, "labels", sf).select("doc_id"), "doc_id").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, "labels", sf))
    rows = toxicity.scored(docs, model).join(table(spark, "labels", sf), "doc_id").filter("held_out").collect()
    y, s = np.array([r["toxic"] for r in rows]), np.array([r["score"] for r in rows])
    order = np.argsort(s, kind="stable")
    n1 = y.sum()
    auc = (np.flatnonzero(y[order]).sum() - n1 * (n1 - 1) / 2) / (n1 * (len(y) - n1))
    assert auc > 0.93 and ((s >= 0.5) == y).mean() > 0.95
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)


def test_pieces_are_chosen_by_compressed_length(spark):
    """Unknown words of toxic texts train the toxic dictionary, also in runs of 1,000 characters and more."""
    rng = random.Random(5)
    common = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(40)]
    docs, labels = [], []
    for i in range(400):
        words = rng.choices(common, k=60)
        if i % 4 == 0:
            words[rng.randrange(60)] = words[rng.randrange(60)] = "zwyxquvk"
        if i % 50 == 0:
            words[3] = "x" * 3000
        docs.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert b"zwyxquvk" in model.toxic and b"zwyxquvk" not in model.ordinary
    rows = toxicity.scored(docs, model).collect()
    assert all(r["predicted"] == (r["doc_id"] % 4 == 0) for r in rows)
    assert [w for t in ("a " * 7, "x" * 250, "", None) for w in toxicity.windows(t)] == [
        ["a"] * 6, ["a"], ["x" * 100, "x" * 100, "x" * 50]]


# -- web pages

def test_articles_of_pages(spark):
    pages = table(spark, "pages", "/root/testdata/sf0.01")
    got = {r["page_id"]: r["text"] for r in wrappers.extracted(pages).collect()}
    for r in pages.collect():
        body = r["html"].split("<article>", 1)[1].split("</article>", 1)[0]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", body)]
        assert got[r["page_id"]] == "\n\n".join(b for b in blocks if b)


def test_constant_nodes_become_template(spark):
    rows = []
    for i in range(40):
        rows.append((i, f"https://site.example/{i}", f"""<html><body><div class="top-{i}">Welcome to our site</div>
<div class="story"><h2>Title {i}</h2><p>Text number {i} &eacute; with <i>words</i>.<p>More {i * i}</p></div>
<div class="comments">I disagree {i}</div><div id="sidebar{i}">See also {i}</div><form>Search {i}</form></body></html>"""))
    got = {r["page_id"]: r["text"] for r in wrappers.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"Title {i}\n\nText number {i} é with words.\n\nMore {i * i}" for i in range(40)}


@pytest.mark.parametrize("page", [
    '<html class="has-sidebar"><body class="right-sidebar">{}</body></html>',
    '<body><div id="page" class="has-comments">{}</div></body>',
    '<body><div class="no-sidebar"><article class="post comments-open">{}</article></div><p>else</p></body>',
    '<body><div class="page-with-widget"><main id="share">{}</main></div><p>else</p></body>',
    '<body><article>{}<div class="comments-area"><article class="comment-body">no</article></div></article></body>',
    '<body><article>{}</article><div id="comments" class="comments-area"><article class="comment">no</article></div></body>',
])
def test_names_on_containers_do_not_drop_the_page(page):
    text = '<p>Story</p><div class="social-links">no</div>'
    assert wrappers.main_text(page.format(text)) == "Story" or "has-comments" in page
    assert "Story" in wrappers.main_text(page.format(text))
    assert wrappers.main_text('<body><div class="sidebar">no</div></body>') == ""


@pytest.mark.parametrize("page,text", [
    ('<form id="aspnetForm"><div><p>One.</p><p>Two.</p></div><input value="x"></form>', "One.\n\nTwo."),
    ('<form id="aspnetForm"><article><p>One.</p></article></form><form><p>Mail</p></form>', "One."),
    ('<article><p>One.</p><section class="related-work"><p>Two by <a href="#">her</a>, in full.</p></section>'
     '<div class="social-science"><p>Three.</p></div><div class="related-posts"><p><a href="#">Other page</a></p></div>'
     '<div class="social"><p>Follow us.</p></div></article>', "One.\n\nTwo by her, in full.\n\nThree."),
    ('<article class="post comments-open"><p>One.</p></article><div class="comment-area">'
     '<article class="comment-item"><p>Nice!</p></article></div>', "One."),
    ('<article class="comment-item"><p>One.</p></article>', "One."),
])
def test_forms_topics_and_comments(page, text):
    assert wrappers.main_text(f"<html><body>{page}</body></html>") == text


def test_copies_of_a_page_do_not_fill_a_block(spark, monkeypatch):
    votes = wrappers._votes

    def bounded(pdf):
        if len(pdf) > 100:
            raise ValueError(f"{len(pdf)} pages in a block")
        return votes(pdf)

    monkeypatch.setattr(wrappers, "_votes", bounded)
    page = "<html><body><div class='top'>Welcome</div><div class='story'>Text {}</div></body></html>"
    rows = [(f"https://site.example/{i}", page.format(max(i, 500))) for i in range(540)]
    got = wrappers.induced(spark.createDataFrame(rows, "url string, html string")).collect()
    assert [(r["host"], r["template"]) for r in got] == [("site.example", ["//html/body/div.top"])]


def test_simple_tree_matching_skips_inserted_nodes():
    a = ["", 0, 0, [["div", 1, 1, []], ["p", 2, 1, []], ["ul", 3, 1, []]]]
    b = ["", 0, 0, [["table", 9, 1, []], ["div", 1, 1, []], ["h1", 8, 1, []], ["ul", 4, 1, []]]]
    weight, pairs = wrappers.matched(a, b)
    assert [(x[0], y[0]) for x, y in pairs] == [("", ""), ("ul", "ul"), ("div", "div")] or {x[0] for x, _ in pairs} == {"", "div", "ul"}
    assert weight >= 3


# -- nearest neighbours

def test_recall_against_brute_force(spark):
    rows = table(spark, "embeddings", "/root/testdata/sf0.1").collect()
    got = defaultdict(list)
    for r in neighbours.nearest(table(spark, "embeddings", "/root/testdata/sf0.1"), "vec_id % 50 = 0").orderBy("rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    ids = np.array([r["vec_id"] for r in rows])
    v = np.array([r["embedding"] for r in rows], np.float64)
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    hits = 0
    for q in np.flatnonzero(ids % 50 == 0):
        score = unit @ unit[q]
        score[q] = -2
        best = sorted(range(len(ids)), key=lambda i: (-score[i], ids[i]))[:5]
        found = got[ids[q]]
        assert len(found) == 5 and [s for _, s in found] == sorted((s for _, s in found), reverse=True)
        hits += len({ids[i] for i in best} & {i for i, _ in found})
    assert hits / (5 * len(got)) >= 0.9


def test_many_copies_lose_nothing(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((30, 8)).astype(np.float32)
    rows = [(i, base[0 if i % 3 == 0 else i % 30].tolist()) for i in range(600)]
    got = defaultdict(list)
    for r in neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), "vec_id % 50 = 0").orderBy("rank").collect():
        got[r["query_id"]].append(r["vec_id"])
    for q in range(0, 600, 50):
        v = np.array(rows[q][1])
        cos = {i: round(float(np.dot(v, x) / np.linalg.norm(v) / np.linalg.norm(x)), 9) for i, x in rows if i != q}
        assert got[q] == sorted(cos, key=lambda i: (-cos[i], i))[:5]


@pytest.mark.parametrize("n", [50_000, 800_000, 3_000_000, 100_000_000])
def test_neighbours_are_visited_however_many_vectors(n):
    """Pairs with a cosine of 0.41, the fifth neighbour among 51,282 vectors; it is nearer among more."""
    rng = np.random.default_rng(n)
    q, other = rng.standard_normal((2, 600, 64))
    q /= np.linalg.norm(q, axis=1, keepdims=True)
    other -= (other * q).sum(axis=1, keepdims=True) * q
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    k = neighbours.directions(n)
    t = neighbours.Tables(64, k, neighbours.TABLES, neighbours.WIDTH, 7)
    probed = t.probed(q, neighbours.perturbations(k, neighbours.PROBES))
    held = t.buckets(0.41 * q + math.sqrt(1 - 0.41 ** 2) * other)
    assert np.mean([bool(set(a) & set(b)) for a, b in zip(probed.tolist(), held.tolist())]) >= 0.9


def test_perturbations_are_in_order_of_success():
    sets = neighbours.perturbations(6, 50)
    assert len(sets) == 50 and not sets[0].any() and sets[1].nonzero()[0].tolist() == [0]
    assert len({tuple(s) for s in sets}) == 50
    assert not (sets[:, :6] & sets[:, 6:][:, ::-1]).any()


# -- chats

def brute_cost(roles):
    best = {chat.START: 0}
    for role in roles:
        then = {}
        for state, cost in best.items():
            for a, b, more, *_ in chat.MOVES[role]:
                if a == state:
                    then[b] = min(then.get(b, math.inf), cost + more)
        best = then
    return min(cost + chat.ENDING[state] for state, cost in best.items())


def test_repairs_are_cheapest_and_legal(spark, monkeypatch):
    rng = random.Random(8)
    rows, want = [], {}
    for c in range(60):
        roles = [rng.choice(["system", "user", "assistant", None]) for _ in range(rng.randint(1, 14))]
        want[c] = brute_cost(roles)
        rows += [(c, t, r, f"t{t}") for t, r in enumerate(roles)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")

    def run():
        got = defaultdict(list)
        for r in chat.formatted(df).orderBy("conv_id", "part").collect():
            got[r["conv_id"]].append(r)
        return {c: ("".join(p["rendered"] for p in parts), parts[0]) for c, parts in got.items()}

    whole = run()
    for c, (text, r) in whole.items():
        assert r["cost"] == want[c]
        assert r["cost"] == r["n_merged"] + 3 * r["n_relabelled"] + 2 * r["n_inserted"]
        roles = re.findall(r"<\|(system|user|assistant)\|>\n", text)
        assert re.fullmatch(r"(s)?(ua)+|s?", "".join(x[0] for x in roles)), roles
        assert re.findall(r"t\d+", text) == [f"t{t}" for t in range(r["n_turns"])]
        assert text.count("<|end|>") == len(roles)
    monkeypatch.setattr(chat, "CHUNK", 3)
    cut = run()
    assert {c: (t, r["cost"]) for c, (t, r) in cut.items()} == {c: (t, r["cost"]) for c, (t, r) in whole.items()}


def test_legal_chats_stay(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "q"), (1, 2, "assistant", "a")]
    r, = chat.formatted(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert r["cost"] == 0
    assert r["rendered"] == "<|system|>\ns\n<|end|>\n<|user|>\nq\n<|end|>\n<|assistant|>\na\n<|end|>\n"


# -- URL filters

def test_most_specific_valid_entry_decides(spark):
    entries = spark.createDataFrame([
        ("a", "Example.org", "block", "2023-01-01"), ("a", "example.org", "remove", "2023-03-01"), ("a", "example.org", "block", "2023-06-15"),
        ("b", "good.example.org", "allow", "2023-01-10"), ("b", "good.example.org/x/y", "block", "2023-02-01")],
        "list string, pattern string, action string, since string")
    seen = [(1, "https://u:p@www.EXAMPLE.org:80/", "2023-02-28", "block"), (2, "https://example.org", "2023-03-01", "none"),
            (3, "https://example.org/", "2023-06-14", "none"), (4, "https://example.org/", "2025-06-15", "block"),
            (5, "http://good.example.org/x", "2023-02-15", "allow"), (6, "http://good.example.org//x/y/z?q", "2023-02-15", "block"),
            (7, "http://good.example.org/x/yy", "2023-02-15", "allow"), (8, "http://notexample.org/", "2023-02-15", "none"),
            (9, "http://good.example.org/", "2022-12-31", "none"), (10, "http://example.org./", "2023-01-01", "block")]
    df = spark.createDataFrame([r[:3] for r in seen], "page_id long, url string, fetched_at string")
    got = {r["page_id"]: r["verdict"] for r in urls.filtered(df, entries).collect()}
    assert got == {r[0]: r[3] for r in seen}


# -- pipeline

def test_pipeline_stages(spark):
    docs = table(spark, "documents")
    old = {r["doc_id"]: r for r in docs.collect()}
    stages = {name: f for name, f in corpus_pipeline.STAGES}
    ruled = stages["quality rules"](spark, docs, SF)
    kept = {r["doc_id"] for r in ruled.collect()}
    book = {r["doc_id"]: r["failed"] for r in quality.ledger(docs).collect()}
    assert kept == {i for i, f in book.items() if not f & quality.policy_mask("v1")}
    single = stages["near duplicates"](spark, ruled, SF)
    groups = brute_groups({i: old[i]["text"] for i in kept}, 5, 80)
    assert sorted(r["doc_id"] for r in single.collect()) == sorted({g for _, g in groups.values()})
    hidden = stages["pii"](spark, single, SF)
    for r in hidden.collect():
        assert not (set(re.findall(r"\b[\w.]+@[\w.]+\b|\b\d{16}\b", old[r["doc_id"]]["text"])) & set(re.findall(r"\b[\w.]+@[\w.]+\b|\b\d{16}\b", r["text"]))
                    - {d for d in re.findall(r"\b\d{16}\b", r["text"]) if not luhn(d)})
    rows = Counter(r["doc_id"] for r in stages["mixing"](spark, hidden, SF).collect())
    copies = {r["doc_id"]: r["c"] for r in mixing.mix(hidden).select("doc_id", F.col("mix_.copies").alias("c")).collect()}
    assert rows == Counter({i: c for i, c in copies.items() if c})
    packed = corpus_pipeline.run(spark, SF).groupBy("doc_id").agg(F.count_if(F.col("piece") == 0).alias("n")).collect()
    assert {r["doc_id"]: r["n"] for r in packed} == dict(rows)


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in CHECKS) == list(range(1, 14))
