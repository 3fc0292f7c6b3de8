"""Language of texts by the nearest of several centroids.

A text becomes a TF-IDF vector of its character n-grams of one to three code points,
hashed to ``SIZE`` places and normalised. Each language has up to ``CLUSTERS`` centroids,
found by spherical k-means, and a text takes the language of the centroid with the
greatest cosine. A text farther from its centroid than all but ``REJECT`` of the sample
texts of that centroid is marked as rejected.

Document frequencies cover all learnable rows and are summed by Spark. The centroids are
fitted on at most ``sample`` different texts a language, drawn by the hash of the text, so
a group of copies counts once and reruns agree.
"""
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import small, stored

SIZE, GRAMS, CLUSTERS, FEWEST, SAMPLE, REJECT = 1 << 15, 3, 4, 0.05, 800, 0.01
BUFFER = 150_000  # code points that are worked on at once
UNKNOWN = "und"


@dataclass
class Model:
    """Languages and vectors of the centroids, weights of the n-grams, least cosines."""
    languages: list
    centroids: np.ndarray
    idf: np.ndarray
    least: np.ndarray


def held_out(id_col: str = "doc_id") -> Column:
    """True for the quarter of the ids that nothing is learnt from; a NULL id is held out."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 4 == 2, F.lit(True))


def _clean(text) -> str:
    """Lower-case words of letters and marks between single blanks; empty without a letter."""
    import regex
    if not text or not regex.search(r"\p{L}", text):
        return ""
    return f" {regex.sub(r'[^\p{L}\p{M}]+', ' ', text.lower()).strip()} "


def _grams(codes):
    """Place of every n-gram that starts at each code point, -1 where it would run out."""
    n = len(codes)
    out = np.full((GRAMS, n), -1, np.int64)
    h = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(GRAMS):
            m = max(n - k, 0)
            h[:m] = (h[:m] + codes[k:]) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k + 1)
            out[k, :m] = ((h[:m] ^ (h[:m] >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(49)).astype(np.int64) % SIZE
    return out


def _codes(text):
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)


def _long_counts(codes):
    """Counts of one long text, part by part."""
    total = np.zeros(SIZE, np.int64)
    for a in range(0, len(codes), BUFFER):
        part = _grams(codes[a:a + BUFFER + GRAMS - 1])[:, :BUFFER]
        total += np.bincount(part[part >= 0], minlength=SIZE)
    places = np.flatnonzero(total)
    return places, total[places]


def counted(texts):
    """Yield (indices of texts, owner of each entry among them, place, count), buffer by buffer.

    Texts without a letter are left out.
    """
    group, codes, size = [], [], 0
    for i, text in enumerate(texts):
        clean = _clean(text)
        if not clean:
            continue
        if len(clean) > BUFFER:
            places, counts = _long_counts(_codes(clean))
            yield np.array([i]), np.zeros(len(places), np.int64), places, counts
            continue
        if size + len(clean) > BUFFER:
            yield _together(group, codes)
            group, codes, size = [], [], 0
        group.append(i)
        codes.append(clean)
        size += len(clean)
    if group:
        yield _together(group, codes)


def _together(group, cleaned):
    lengths = np.fromiter(map(len, cleaned), np.int64, len(cleaned))
    places = _grams(_codes("".join(cleaned)))
    owner = np.repeat(np.arange(len(group)), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(owner))  # code points up to the text's end
    keys = np.concatenate([(owner * SIZE + places[k])[left > k] for k in range(GRAMS)])
    keys.sort()
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    counts = np.diff(np.concatenate([first, [len(keys)]]))
    return np.array(group), keys[first] // SIZE, keys[first] % SIZE, counts


def _weighted(n, owner, places, counts, idf):
    """Normalised weights of the entries of ``n`` texts."""
    w = (1 + np.log(counts)) * idf[places]
    return w / np.sqrt(np.bincount(owner, w * w, n))[owner]


def _frequencies(rows: DataFrame) -> tuple[int, np.ndarray]:
    """Number of texts with a letter and, for each place, the texts that hold it."""
    def run(batches):
        total, n = np.zeros(SIZE, np.int64), 0
        for batch in batches:
            for group, _, places, _ in counted(batch.column("t").to_pylist()):
                n += len(group)
                total += np.bincount(places, minlength=SIZE)
        at = np.concatenate([[-1], np.flatnonzero(total)])
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.concatenate([[n], total[at[1:]]]))], names=["place", "n"])

    sums = rows.select("t").mapInArrow(run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toPandas()
    texts, frequency = 0, np.zeros(SIZE, np.int64)
    for place, n in zip(sums["place"], sums["n"]):
        if place < 0:
            texts = int(n)
        else:
            frequency[place] = n
    return texts, frequency


def _drawn(rows: DataFrame, sample: int) -> DataFrame:
    """At most ``sample`` different texts a language, the first by hash."""
    rows = rows.withColumn("key", F.xxhash64("t"))
    different = rows.groupBy("lang").agg(F.approx_count_distinct("key", 0.02).alias("texts"))
    share = F.lit(2.0 * sample) / F.col("texts")
    thin = (F.pmod("key", F.lit(1 << 40)) < share * (1 << 40)) | (F.col("texts") <= 2 * sample)
    # a row a language, so texts do not move to be thinned
    once = rows.join(small(stored(different)), "lang").filter(thin).groupBy("lang", "key").agg(F.min("t").alias("t"))
    numbered = once.withColumn("i", F.expr(f"row_number() OVER (PARTITION BY lang ORDER BY pmod(key, {1 << 40}), key)"))
    return numbered.filter(F.col("i") <= sample).select("lang", "key", "t")


def spherical_means(x: np.ndarray, clusters: int, rounds: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """Unit centroids of unit rows and the centroid of each row.

    Seeds are rows at even ranks of nearness to the mean. A centroid with fewer than
    ``FEWEST`` of the rows is given up and its rows go elsewhere, so that a few odd or
    wrongly labelled rows form none.
    """
    rank = np.argsort(-(x @ x.mean(axis=0)), kind="stable")
    centroids = x[rank[(np.arange(clusters) * 2 + 1) * len(x) // (2 * clusters)]]
    while True:
        at = None
        for _ in range(rounds):
            new = np.argmax(x @ centroids.T, axis=1)
            if at is not None and (new == at).all():
                break
            at = new
            sums = np.stack([x[at == k].sum(axis=0) if (at == k).any() else centroids[k] for k in range(len(centroids))])
            centroids = sums / np.linalg.norm(sums, axis=1, keepdims=True)
        at = np.argmax(x @ centroids.T, axis=1)
        size = np.bincount(at, minlength=len(centroids))
        if len(centroids) == 1 or size.min() >= FEWEST * len(x):
            return centroids, at
        centroids = np.delete(centroids, int(np.argmin(size)), axis=0)


def _centroids(drawn: DataFrame, idf, clusters: int):
    """(language, vector, least cosine) of every centroid, one bounded group a language."""
    def run(pdf):
        import pandas as pd
        pdf = pdf.sort_values("key", kind="stable")
        texts = pdf["t"].tolist()
        x, seen = np.zeros((len(texts), SIZE), np.float32), np.zeros(len(texts), bool)
        for group, owner, places, counts in counted(texts):
            x[group[owner], places] = _weighted(len(group), owner, places, counts, idf)
            seen[group] = True
        x = x[seen]
        out = {"lang": [], "vector": [], "least": []}
        if len(x):
            found, at = spherical_means(x, min(clusters, 1 + len(x) // 20))
            near = np.einsum("ij,ij->i", x, found[at])
            for k in np.unique(at):
                out["lang"].append(pdf["lang"].iloc[0])
                out["vector"].append(found[k].astype(np.float32).tobytes())
                out["least"].append(float(np.quantile(near[at == k], REJECT)))
        return pd.DataFrame(out)

    return drawn.groupBy("lang").applyInPandas(run, "lang string, vector binary, least double").collect()


def fit(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang",
        clusters: int = CLUSTERS, sample: int = SAMPLE) -> Model:
    """Centroids of the languages of the rows that are not held out.

    Rows with a NULL text or language, or without a letter, are not learnt from; equal
    texts of a language are drawn once. Repeated and NULL ids do not matter otherwise, other
    columns are not read. Without learnable rows the model knows no language.
    """
    rows = docs.filter(~held_out(id_col)).select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").alias("t"))
    rows = rows.filter("lang IS NOT NULL AND t IS NOT NULL")
    texts, frequency = _frequencies(rows)
    idf = np.log((1 + texts) / (1 + frequency)) + 1
    found = sorted(_centroids(_drawn(rows, sample), idf, clusters), key=lambda r: (r["lang"], bytes(r["vector"])))
    vectors = np.array([np.frombuffer(r["vector"], np.float32) for r in found], np.float32).reshape(-1, SIZE)
    return Model([r["lang"] for r in found], vectors, idf, np.array([r["least"] for r in found]))


def _nearest(texts, model: Model):
    """Number of the nearest centroid (-1: no letter, or no centroid) and its cosine."""
    best, score = np.full(len(texts), -1), np.zeros(len(texts))
    if not model.languages:
        return best, score
    for group, owner, places, counts in counted(texts):
        w = _weighted(len(group), owner, places, counts, model.idf)
        cosines = np.stack([np.bincount(owner, w * vector[places], len(group)) for vector in model.centroids])
        best[group] = np.argmax(cosines, axis=0)
        score[group] = cosines.max(axis=0)
    return best, np.clip(score, 0.0, 1.0)


def identified(df: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id_col, held_out, lang_pred, score, rejected`` of every row.

    ``score`` is the cosine to the nearest centroid, ``rejected`` is true where it is below
    that centroid's least. NULL texts and those without a letter are ``und`` with score 0 and
    rejected, as is every text if no language is known; of equally near centroids the first by
    language is taken. Only the text enters. Ids may be NULL or repeated, whole texts of any
    length are read, other columns are not.
    """
    inner = df.select(F.col(f"`{id_col}`").alias("id"), held_out(id_col).alias("held_out"), F.col(f"`{text}`").alias("t"))
    kind = inner.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            best, score = _nearest(batch.column("t").to_pylist(), model)
            low = [b < 0 or s < model.least[b] for b, s in zip(best, score)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("held_out"), pa.array([model.languages[b] if b >= 0 else UNKNOWN for b in best], pa.string()),
                 pa.array(score), pa.array(low, pa.bool_())], names=["id", "held_out", "lang_pred", "score", "rejected"])

    out = inner.mapInArrow(run, f"id {kind}, held_out boolean, lang_pred string, score double, rejected boolean")
    return out.withColumnRenamed("id", id_col)
