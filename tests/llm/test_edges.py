"""NULLs, empty and long texts, ties, repeated rows, empty tables, clashing names."""
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from parlance.llm import chat, mixing, neardup, neighbours, packing, pii, quality, toxicity, urls, wrappers

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
LONG = "word " * 30_000 + "x" * 50_000
BIG = 2 ** 60 + 1  # not exact as a double
CLASHING = ("id string, t string, k long, row string, found long, n long, rank long, mix_x string, doc_id long, text string, "
            "lang string, source string, n_chars long, failed long, rep long, key long, v string, c0 long, k0 long")
DOCS = [(None, None, None, None), (BIG, "one two three four five", "a", "en"), (BIG, "one two three four five", "a", "en"),
        (3, "", "b", None), (4, " \n\t ", None, "en"), (None, "One two three four five", "b", "en"), (6, LONG, "a", "en"),
        (7, "ünïcödé " * 60, "c", "de"), (8, None, "c", "fr")]


def documents(spark, rows=DOCS):
    full = [("i", "t", 1, "r", 2, 3, 4, "m", i, t, g, s, 5, 6, 7, 8, "v", 9, 10) for i, t, s, g in rows]
    return spark.createDataFrame(full, CLASHING)


def ids(rows):
    return sorted((-1 if r["doc_id"] is None else r["doc_id"]) for r in rows)


ALL = sorted(-1 if r[0] is None else r[0] for r in DOCS)


def test_quality(spark):
    rows = quality.ledger(documents(spark)).collect()
    assert ids(rows) == ALL
    empty = [r for r in rows if r["doc_id"] in (3, 4, 8)]
    assert all(r["n_words"] == r["word_chars"] == r["n_repeat_words"] == 0 for r in empty)
    kept = quality.apply_policy(documents(spark))
    assert kept.columns == documents(spark).columns
    assert not {r["doc_id"] for r in kept.collect()} & {3, 4, 8}
    assert quality.ledger(documents(spark, [])).count() == 0


def test_neardup(spark):
    rows = neardup.near_duplicates(documents(spark), width=3, percent=85).collect()
    assert ids(rows) == ALL
    assert all(r["component_id"] == r["doc_id"] for r in rows)  # no NULL id names a group
    assert {r["doc_id"]: r["n_shingles"] for r in rows if r["doc_id"] in (3, 4, 8, BIG)} == {3: 0, 4: 0, 8: 0, BIG: 3}
    kept = neardup.deduplicated(documents(spark))
    assert kept.columns == documents(spark).columns
    assert ids(kept.collect()) == [-1, -1, 3, 4, 6, 7, 8, BIG]
    assert neardup.near_duplicates(documents(spark, [])).count() == 0
    assert neardup.deduplicated(documents(spark, [])).count() == 0


def test_pii(spark):
    out = pii.pseudonymised(documents(spark, DOCS + [(9, "x@mail.example.org " * 3, "s", "en")]), "key")
    assert out.columns == documents(spark).columns + ["pii_"]
    rows = {r["doc_id"]: r for r in out.collect()}
    assert rows[8]["text"] is None and rows[3]["text"] == "" and rows[6]["text"] == LONG
    assert rows[9]["pii_"]["found"] == 3 and "mail.example" not in rows[9]["text"]
    assert pii.pseudonymised(documents(spark, []), "key").count() == 0


def test_columns_named_as_inside_the_operators_stay(spark):
    names = ["kept_", "k_", "r_", "t_", "id_", "mix_", "pii_", "mix", "copy", "head", "h", "size", "u", "place", "new", "seen", "map"]
    docs = documents(spark, [(1, "one two", "a", "en"), (1, "one two", "a", "en"), (None, "mail a@b.org", None, None)])
    docs = docs.withColumns({n: F.lit(n) for n in names}).withColumn("map", F.create_map(F.lit("k"), F.lit("v")))
    for out in (neardup.deduplicated(docs), mixing.mixed(docs), pii.rewritten(docs, "key")):
        assert out.columns == docs.columns
        assert all(r["kept_"] == "kept_" and r["mix_"] == "mix_" and r["pii_"] == "pii_" for r in out.collect())
    assert neardup.deduplicated(docs).count() == 2


def test_mixing(spark):
    rows = mixing.mix(documents(spark)).select("doc_id", "source", "mix_").collect()
    assert ids(rows) == ALL
    for r in rows:
        m = r["mix_"]
        assert 0 <= m["copies"] <= 3 and m["taken"] == m["copies"] * m["size"]
    same = [r["mix_"] for r in rows if r["doc_id"] == BIG]
    assert same[0]["rate"] == same[1]["rate"] and abs(same[0]["copies"] - same[1]["copies"]) <= 1
    assert mixing.mixed(documents(spark)).columns == documents(spark).columns
    assert mixing.mix(documents(spark, [])).count() == 0
    only_empty = mixing.mix(documents(spark, [(1, "", "a", "en"), (2, None, None, "en")])).collect()
    assert [r["mix_"]["taken"] for r in only_empty] == [0, 0]


def test_packing(spark):
    rows = packing.pack(documents(spark), TOKENIZER).collect()
    assert {-1 if r["doc_id"] is None else r["doc_id"] for r in rows} == set(ALL)
    assert [r["length"] for r in rows if r["doc_id"] in (3, 8)] == [1, 1]
    assert sum(r["doc_id"] == BIG for r in rows) == 2
    assert packing.pack(documents(spark, []), TOKENIZER).count() == 0


def test_toxicity(spark):
    labels = spark.createDataFrame([(None, 1), (BIG, None), (3, 0), (4, 7), (3, 1)], "doc_id long, toxic int")
    model = toxicity.fit(documents(spark), labels)
    rows = toxicity.scored(documents(spark), model).collect()
    assert ids(rows) == ALL and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.fit(documents(spark, []), labels.filter("false")).prior == 0
    assert toxicity.scored(documents(spark, []), model).count() == 0


def test_wrappers(spark):
    page = "<html><body><article><p>a &amp; b</p></article></body></html>"
    full = [("t", "k", 1, None, "http://a.example/x", None), ("t", "k", 2, BIG, None, page), ("t", "k", 3, BIG, None, page),
            ("t", "k", 4, 4, "nonsense", ""), ("t", "k", 5, 5, "http://a.example/", "<p>" * 3000 + "deep")]
    frame = lambda rows: spark.createDataFrame(rows, "id string, host string, u long, page_id long, url string, html string")
    rows = wrappers.extracted(frame(full)).collect()
    assert len(rows) == 5
    assert sorted(r["text"] for r in rows if r["page_id"] == BIG) == ["a & b", "a & b"]
    assert {r["page_id"]: r["text"] for r in rows}[5] == "deep"
    assert wrappers.extracted(frame([])).count() == 0


def test_neighbours(spark):
    v = [1.0, 2.0]
    full = [("x", None, v), ("x", 0, v), ("x", 0, v), ("x", 1, None), ("x", 2, [0.0, 0.0]), ("x", 3, [1.0, None]),
            ("x", 4, [float("nan"), 1.0]), ("x", 5, []), ("x", 6, [2.0, 4.0]), ("x", 7, [1.0, 2.0, 3.0]), ("x", 8, v), ("x", BIG, v)]
    frame = lambda rows: spark.createDataFrame(rows, "rep string, vec_id long, embedding array<float>")
    rows = neighbours.nearest(frame(full), "vec_id % 50 = 0").orderBy("rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in rows] == [(0, 1, 6), (0, 2, 8), (0, 3, BIG)]
    assert all(r["score"] == pytest.approx(1) for r in rows)
    assert neighbours.nearest(frame([]), "vec_id % 50 = 0").count() == 0


def test_chat(spark):
    full = [("x", None, 0, "user", "hi"), ("x", BIG, 1, "assistant", None), ("x", BIG, None, "USER ", "q"), ("x", BIG, 1, "assistant", None),
            ("x", 3, 0, None, "who"), ("x", 4, 0, "tool", LONG)]
    frame = lambda rows: spark.createDataFrame(rows, "part string, conv_id long, turn long, role string, text string")
    rows = {r["conv_id"]: r for r in chat.formatted(frame(full)).collect()}
    assert set(rows) == {None, BIG, 3, 4}
    assert rows[BIG]["n_turns"] == 3 and rows[BIG]["n_merged"] == 1
    assert rows[None]["rendered"] == "<|user|>\nhi\n<|end|>\n<|assistant|>\n\n<|end|>\n"
    assert LONG in rows[4]["rendered"]
    assert chat.formatted(frame([])).count() == 0


def test_urls(spark):
    entries = spark.createDataFrame([("l", None, "block", "2023-01-01"), ("l", "a.example", None, "2023-01-01"), ("l", "b.example", "block", None),
                                     ("l", "c.example", "block", "2023-01-05"), ("l", "c.example", "block", "2023-01-05")],
                                    "list string, pattern string, action string, since string")
    captures = lambda rows: spark.createDataFrame(rows, "list string, page_id long, url string, fetched_at string").withColumn(
        "fetched_at", F.col("fetched_at").cast("date"))
    full = [("x", None, None, None), ("x", BIG, "http://c.example/", "2023-02-01"), ("x", BIG, "http://c.example/", "2023-02-01"),
            ("x", 3, "http://c.example/", None), ("x", 4, "no url", "2023-02-01"), ("x", 5, "http://c.example/", "2023-01-01")]
    rows = urls.filtered(captures(full), entries).collect()
    assert sorted((r["page_id"] or -1, r["verdict"]) for r in rows) == [
        (-1, "none"), (3, "none"), (4, "none"), (5, "none"), (BIG, "block"), (BIG, "block")]
    assert urls.filtered(captures(full), entries.filter("false")).filter("verdict <> 'none'").count() == 0
    assert urls.filtered(captures([]), entries).count() == 0


def test_pipeline(spark):
    docs = documents(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, None)
        assert out.columns == docs.columns
        docs = out
    assert corpus_pipeline.STAGES[-1][1](spark, documents(spark, []), None).count() == 0
    nothing = documents(spark, [])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        nothing = stage(spark, nothing, None)
    assert nothing.count() == 0
