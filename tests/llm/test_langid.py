"""Language by nearest centroid: held-out accuracy, plain vectors, edge cases."""
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from parlance.llm import langid
from parlance.llm.checks import CHECKS

SF = "/root/testdata/sf0.1"
CLASHING = "id string, t string, lang string, key long, texts long, i int, score double, doc_id long, text string, k0 int"


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_held_out_accuracy(spark):
    rows = CHECKS["op12_language_centroids"][0](spark, SF).join(documents(spark).select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == documents(spark).count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.995 * len(held)
    wrong = [r for r in rows if r["lang"] != r["lang_pred"]]
    assert np.mean([r["score"] for r in wrong]) < np.mean([r["score"] for r in rows])


def test_labels_of_held_out_rows_are_not_read(spark):
    docs = documents(spark).limit(300)
    other = docs.withColumn("lang", F.when(langid.held_out(), "xx").otherwise(F.col("lang")))
    a, b = langid.fit(docs), langid.fit(other)
    assert a.languages == b.languages and np.array_equal(a.centroids, b.centroids)


def plain_counts(text):
    """Counts of the places of all n-grams, one by one."""
    codes = langid._codes(langid._clean(text))
    grams = langid._grams(codes)
    return Counter(int(grams[k, i]) for k in range(langid.GRAMS) for i in range(len(codes) - k))


def test_vectors_equal_plain_counts(monkeypatch):
    texts = ["Ab c", None, "", "12 !", "Größe", "a" * 50, "日本 語 x", "one two three " * 30]
    for buffer in (40, 150_000):
        monkeypatch.setattr(langid, "BUFFER", buffer)
        seen = {}
        for group, owner, places, counts in langid.counted(texts):
            for o, p, c in zip(owner, places, counts):
                seen.setdefault(int(group[o]), Counter())[int(p)] += int(c)
        assert seen == {i: plain_counts(t) for i, t in enumerate(texts) if i not in (1, 2, 3)}
    w = langid._weighted(1, np.zeros(2, int), np.array([0, 1]), np.array([1, 3]), np.array([1.0, 2.0]))
    assert math.isclose(w[0] ** 2 + w[1] ** 2, 1) and math.isclose(w[1] / w[0], 2 * (1 + math.log(3)))


def test_same_words_share_places_wherever_they_stand():
    a, b = langid._grams(langid._codes(" abc ")), langid._grams(langid._codes("zz abc "))
    assert all((a[k, :5 - k] == b[k, 2:7 - k]).all() for k in range(langid.GRAMS))


def test_means_find_groups_and_ignore_odd_rows():
    rng = np.random.default_rng(0)
    centers = np.eye(6)[:3]
    x = np.concatenate([c + 0.05 * rng.normal(size=(60, 6)) for c in centers] + [np.eye(6)[5:]])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    found, at = langid.spherical_means(x, 4)
    assert set(np.argmax(found, axis=1)) == {0, 1, 2}
    assert np.bincount(at).min() >= langid.FEWEST * len(x)
    assert (at == np.argmax(x @ found.T, axis=1)).all()


def test_edges(spark):
    words = {"aa": "la le li lo lu mano pane", "bb": "th sh wh then when that with"}
    rows = [(i, " ".join(w.split()[j % 5:] * (1 + j % 3)), lang) for lang, w in words.items() for j in range(40) for i in [j * 2 + (lang == "bb")]]
    rows += [(None, words["aa"], "bb"), (500, None, "aa"), (501, "", "aa"), (502, "12 34 !?", "bb"), (503, "la le li", None),
             (503, "la le li", None), (504, "then when " * 40_000, None), (505, "中文", None)]
    df = spark.createDataFrame([("i", "t", lang, 1, 2, 3, 0.5, i, t, 4) for i, t, lang in rows], CLASHING)
    model = langid.fit(df)
    assert set(model.languages) == {"aa", "bb"}
    out = langid.identified(df, model)
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score", "rejected"]
    got = out.collect()
    assert sorted(r["doc_id"] or -1 for r in got) == sorted(i if i else -1 if i is None else 0 or -1 for i, _, _ in rows)
    by_id = {r["doc_id"]: r for r in got}
    for i in (500, 501, 502):
        assert (by_id[i]["lang_pred"], by_id[i]["score"], by_id[i]["rejected"]) == ("und", 0.0, True)
    assert by_id[None]["lang_pred"] == "aa" and by_id[None]["held_out"]
    assert by_id[503]["lang_pred"] == "aa" and by_id[504]["lang_pred"] == "bb"
    assert by_id[505]["rejected"] and by_id[505]["lang_pred"] in ("aa", "bb")
    assert langid.identified(df.limit(0), model).count() == 0
    nothing = langid.fit(df.limit(0))
    assert nothing.languages == []
    assert {r["lang_pred"] for r in langid.identified(df, nothing).collect()} == {"und"}


def test_copies_do_not_crowd_out_a_language(spark):
    rows = [(i, "la le li lo lu", "aa") for i in range(3000)] + [(5000 + i, f"mano pane vino sale n{'abcdefgh'[i % 8] * 3}", "aa") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    drawn = langid._drawn(df.select("lang", F.col("text").alias("t")), 20).collect()
    assert len(drawn) == 9
    with pytest.raises(Exception):
        langid.fit(df.drop("lang"))
