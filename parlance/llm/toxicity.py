"""Toxicity by compression distance.

Two zstandard dictionaries stand for ordinary and for toxic language. A text is cut into
windows of ``WINDOW`` words; a window that the toxic dictionary compresses to fewer
bytes than the ordinary one sounds toxic. The gains of all windows of a text are
summarised and turned into a probability by a calibrated logistic curve.

The ordinary dictionary is trained by zstandard on windows of ordinary texts. The toxic one
is trained on pieces of toxic texts, followed by the ordinary content, so that ordinary
windows gain nothing. All windows of toxic texts would fill it with the common words of both
classes, so its pieces are chosen by compressed length only:

1. Hard pieces are words whose removal from a window saves about as many bytes as they have:
   the ordinary dictionary does not know them.
2. Toxic texts are dealt to two halves with a dictionary each. A piece stays if the other half's
   dictionary saves bytes on it in its place. ``ROUNDS`` rounds train on what stayed.
3. Pieces that stay in fewer than ``SHARE`` of the toxic texts, or that gain nearly as often in
   ordinary texts, leave.

Calibration gives every toxic text the dictionary of the half it is not in.

Fitting uses a bounded sample of labelled rows, ``sample`` of each class drawn by hash,
``TRAIN_WINDOWS`` ordinary windows and at most ``PIECES`` different pieces a half; only
these bounded tables reach the driver.
"""
import math
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import stored

WINDOW, LEVEL = 6, 12
SAMPLE, TRAIN_WINDOWS, PIECES = 4000, 40_000, 100_000
ORDINARY_BYTES, FIRST_BYTES, TOXIC_BYTES = 110 << 10, 16 << 10, 4 << 10
HARD_BYTES, HARD_SHARE, GAIN, ROUNDS, SHARE, TELLING = 2, 0.6, 1, 2, 0.01, 3
FEATURES = 12
# A longer run without white space is cut, so that no window grows with it.
WORD = re.compile(r"\S{1,100}")


@dataclass
class Model:
    """Dictionaries and calibration; without weights every text scores ``prior``."""
    ordinary: bytes
    toxic: bytes
    mean: np.ndarray | None
    scale: np.ndarray | None
    weights: np.ndarray | None
    prior: float


def held_out(id_col: str = "doc_id") -> Column:
    """True for the fifth of the ids that no label is learnt from; a NULL id is held out."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 5 == 0, F.lit(True))


def windows(text) -> list[list[str]]:
    """The words of a text, ``WINDOW`` at a time; none for NULL."""
    words = WORD.findall((text or "").lower())
    return [words[i:i + WINDOW] for i in range(0, len(words), WINDOW)]


def as_bytes(words: list[str]) -> bytes:
    return f" {' '.join(words)} ".encode("utf-8", "replace")


def compressor(content: bytes):
    """Compressor with a dictionary's content and frames without headers."""
    import zstandard
    kept = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    kept.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=kept, write_content_size=False,
                                    write_checksum=False, write_dict_id=False)


def saved(z, words: list[str], j: int) -> int:
    """Bytes that a window needs for its word ``j``."""
    return len(z.compress(as_bytes(words))) - len(z.compress(as_bytes(words[:j] + words[j + 1:])))


class Gains:
    """Summaries of the gains of a text's windows."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        self.ordinary, self.toxic = compressor(ordinary), compressor(toxic)

    def of(self, text) -> np.ndarray:
        gains = []
        for words in windows(text):
            raw = as_bytes(words)
            gains.append(len(self.ordinary.compress(raw)) - len(self.toxic.compress(raw)))
        d = np.array(gains or [0], np.float64)
        top = np.sort(d)[::-1]
        total, n = d.sum(), len(d)
        return np.array([
            d.mean(), top[0], top[1] if n > 1 else 0.0, (d >= 2).mean(), (d >= 3).mean(), min((d >= 3).sum(), 8),
            min((d >= 4).sum(), 8), math.log(n), math.log1p(max(total, 0)), total / math.sqrt(n),
            min(max(total, -3), 20), d[d > 0].sum() / n])


def _probability(x, mean, scale, weights):
    z = np.concatenate([(x - mean) / scale, np.ones((len(x), 1))], axis=1) @ weights
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _calibrated(x, y, w, ridge=1e-2, steps=50):
    """Weighted logistic regression by Newton's method."""
    mean, scale = np.average(x, axis=0, weights=w), x.std(axis=0) + 1e-9
    a = np.concatenate([(x - mean) / scale, np.ones((len(x), 1))], axis=1)
    beta = np.zeros(a.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        gradient = a.T @ (w * (y - p)) - ridge * beta
        step = np.linalg.solve((a * (w * p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(beta)), gradient)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return mean, scale, beta


def trained(size: int, samples: list[bytes]) -> bytes:
    """Dictionary of about ``size`` bytes; the samples themselves if too few to train on."""
    import zstandard
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _ordinary_windows(rows: DataFrame) -> list[bytes]:
    def cut(batches):
        for pdf in batches:
            yield pd.DataFrame({"w": [" ".join(w) for t in pdf["t"] for w in windows(t)]}, dtype=object)

    drawn = rows.filter("y = 0").select("t").mapInPandas(cut, "w string").distinct().orderBy(
        F.xxhash64("w"), "w").limit(TRAIN_WINDOWS)
    return [as_bytes([r["w"]]) for r in drawn.collect()]


def hard_pieces(rows: DataFrame, base: bytes) -> DataFrame:
    """``(id, y, half, words, j, bytes)``: words that the ordinary dictionary does not know, in
    their windows, with the bytes it needs for them."""
    def run(batches):
        z = compressor(base)
        for pdf in batches:
            out = []
            for i, y, t in zip(pdf["id"], pdf["y"], pdf["t"]):
                half = zlib.crc32(t.encode("utf-8", "replace")) % 2
                for words in windows(t):
                    whole = len(z.compress(as_bytes(words)))
                    for j, word in enumerate(words):
                        n = whole - len(z.compress(as_bytes(words[:j] + words[j + 1:])))
                        if n >= max(HARD_BYTES, HARD_SHARE * len(word.encode("utf-8", "replace"))):
                            out.append((i, y, half, words, j, n))
            yield pd.DataFrame(out, columns=["id", "y", "half", "words", "j", "bytes"])

    return rows.select(F.col("id").cast("string").alias("id"), "y", "t").mapInPandas(
        run, "id string, y int, half int, words array<string>, j int, bytes int")


def _gaining(pieces: DataFrame, contents: list[bytes]) -> DataFrame:
    """Pieces on which the dictionary of the other half saves at least ``GAIN`` bytes."""
    def run(batches):
        z = [compressor(c) for c in contents]
        for pdf in batches:
            stays = [n - saved(z[1 - half], list(words), j) >= GAIN
                     for half, words, j, n in zip(pdf["half"], pdf["words"], pdf["j"], pdf["bytes"])]
            yield pdf[np.array(stays, bool)]

    return pieces.mapInPandas(run, pieces.schema)


def _counted(pieces: DataFrame) -> DataFrame:
    """``(piece, half, y, n)``: in how many texts of a half a piece is."""
    return pieces.select("id", "y", "half", F.element_at("words", F.col("j") + 1).alias("piece")).distinct().groupBy(
        "piece", "half", "y").agg(F.count("*").alias("n"))


def _samples(counts, half: int | None = None) -> list[bytes]:
    """Every piece as often as texts have it, in an order that spreads copies."""
    copies = [(as_bytes([r["piece"]]), k) for r in counts if half in (None, r["half"]) for k in range(r["n"])]
    return [p for p, _ in sorted(copies, key=lambda c: (zlib.crc32(c[0] + str(c[1]).encode()), c))]


def _toxic_pieces(hard: DataFrame, base: bytes, n0: int, n1: int) -> list:
    """Rows ``(piece, half, n)`` that the toxic dictionary is trained on."""
    def bounded(counts):
        return counts.withColumn("place", F.row_number().over(Window.partitionBy("half").orderBy(
            F.col("n").desc(), F.xxhash64("piece"), "piece"))).filter(F.col("place") <= PIECES).collect()

    toxic, size = hard.filter("y = 1"), FIRST_BYTES
    chosen = bounded(_counted(toxic))
    for _ in range(ROUNDS):
        stays = _gaining(toxic, [trained(size, _samples(chosen, h)) + base for h in (0, 1)])
        chosen, size = bounded(_counted(stays)), TOXIC_BYTES
    total = {}
    for r in chosen:
        total[r["piece"]] = total.get(r["piece"], 0) + r["n"]
    total = {p: n for p, n in total.items() if n >= max(2, math.ceil(SHARE * n1))}
    chosen = [r for r in chosen if r["piece"] in total]
    # Ordinary texts have no half: both are held against the dictionary of all that is left.
    whole = trained(TOXIC_BYTES, _samples(chosen)) + base
    known = hard.filter("y = 0").filter(F.element_at("words", F.col("j") + 1).isin(list(total))) if total else hard.limit(0)
    ordinary = {}
    for r in _counted(_gaining(known, [whole, whole])).collect():
        ordinary[r["piece"]] = ordinary.get(r["piece"], 0) + r["n"]
    return [r for r in chosen if total[r["piece"]] / n1 > TELLING * ordinary.get(r["piece"], 0) / n0]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic",
        sample: int = SAMPLE) -> Model:
    """Learn from the labelled rows that are not held out, at most ``sample`` per class.

    Rows that repeat an id count once (the larger label), equal texts count once. NULL
    labels and other labels than 0 and 1 are ignored, NULL ids are held out, NULL texts left
    out; empty texts have no windows. Long texts are used whole. Extra columns are not read.
    If a class has no row, as in empty tables, the model scores the share of class 1. Jobs run when called.
    """
    known = labels.filter(~held_out(id_col)).filter(F.col(label).isin(0, 1)).groupBy(
        F.col(f"`{id_col}`").alias("id")).agg(F.max(label).cast("int").alias("y"))
    drawn = [known.filter(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(sample) for y in (0, 1)]
    sizes = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    total = sum(sizes.values())
    prior = sizes.get(1, 0) / total if total else 0.0
    rows = stored(
        docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("t")).filter("t IS NOT NULL")
        .join(drawn[0].union(drawn[1]), "id").groupBy("t").agg(F.max("y").alias("y"), F.min("id").alias("id")))
    counts = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not counts.get(0) or not counts.get(1):
        return Model(b"", b"", None, None, None, prior)
    n0, n1 = counts[0], counts[1]
    # Few rows, much work on each: as many tasks as the cluster runs at a time.
    rows = stored(rows.repartition(docs.sparkSession.sparkContext.defaultParallelism))
    base = trained(ORDINARY_BYTES, _ordinary_windows(rows))
    chosen = _toxic_pieces(stored(hard_pieces(rows, base)), base, n0, n1)
    halves = [trained(TOXIC_BYTES, _samples(chosen, h)) + base for h in (0, 1)]
    model = Model(base, trained(TOXIC_BYTES, _samples(chosen)) + base, None, None, None, prior)
    known_rows = _features(rows, model, halves).toPandas()
    y = known_rows["y"].to_numpy(np.float64)
    weight = np.where(y == 1, prior / n1, (1 - prior) / n0) * len(y)
    model.mean, model.scale, model.weights = _calibrated(
        np.array(known_rows["x"].tolist(), np.float64).reshape(-1, FEATURES), y, weight)
    return model


def _features(rows: DataFrame, model: Model, halves: list[bytes]) -> DataFrame:
    def run(batches):
        other = [Gains(model.ordinary, h) for h in reversed(halves)]
        whole = Gains(model.ordinary, model.toxic)
        for pdf in batches:
            yield pd.DataFrame({"y": pdf["y"], "x": [
                (other[zlib.crc32(t.encode("utf-8", "replace")) % 2] if y == 1 else whole).of(t)
                for y, t in zip(pdf["y"], pdf["t"])]})

    return rows.select("y", "t").mapInPandas(run, "y int, x array<double>")


def scored(df: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id_col, held_out, score, predicted`` of every row; NULL and empty texts too.

    Only the text enters the score. Ids may be NULL or repeated; extra columns are not read.
    """
    inner = df.select(F.col(f"`{id_col}`").cast("string").alias("id"), held_out(id_col).alias("held_out"), F.col(f"`{text}`").alias("t"))

    def run(batches):
        gains = None if model.weights is None else Gains(model.ordinary, model.toxic)
        for pdf in batches:
            if gains is None:
                score = np.full(len(pdf), model.prior)
            else:
                x = np.array([gains.of(t) for t in pdf["t"]]).reshape(-1, FEATURES)
                score = _probability(x, model.mean, model.scale, model.weights)
            yield pd.DataFrame({"id": pdf["id"], "held_out": pdf["held_out"], "score": score,
                                "predicted": (score >= 0.5).astype(np.int32)})

    out = inner.mapInPandas(run, "id string, held_out boolean, score double, predicted int")
    return out.withColumn("id", F.col("id").cast(df.schema[id_col].dataType)).withColumnRenamed("id", id_col)
