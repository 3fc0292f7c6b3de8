"""One network with several yes/no outputs, trained on gradients summed over partitions.

The labels share the hidden layers and have an output each. In every step the tasks
compute the gradient of the log loss on their own rows, sums meet in a tree, and the
driver moves the weights by Adam. Rows never leave their tasks; what travels are the
weights and one gradient per task, whose size depends on the layers only. The loss on the
validation rows is computed in the same pass, and the weights with the lowest one are kept.
"""
import sys
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lineage import settled

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK, TASK_ROWS = 4096, 16_384  # rows that are multiplied at once, rows of a task


@dataclass
class Network:
    """Weights and biases in turn, names of the outputs, losses per step."""
    weights: list
    labels: list
    steps: list = field(default_factory=list)

    def chances(self, x) -> np.ndarray:
        """Probability of every label for every row."""
        for w, b in zip(self.weights[:-2:2], self.weights[1:-2:2]):
            x = np.maximum(x @ w + b, 0)
        return _sigmoid(x @ self.weights[-2] + self.weights[-1])


def _sigmoid(z):
    return 0.5 * (1 + np.tanh(0.5 * z))


def initial_weights(widths: list[int], seed: int) -> list:
    """Uniform weights scaled to the width of both layers, biases of 0."""
    rng = np.random.default_rng(seed)
    out = []
    for a, b in zip(widths, widths[1:]):
        limit = np.sqrt(6 / (a + b))
        out += [rng.uniform(-limit, limit, (a, b)), np.zeros(b)]
    return out


def losses(logits, y):
    """Log loss of every known label of every row; 0 where the label is unknown (NaN)."""
    known = ~np.isnan(y)
    truth = np.where(known, y, 0.0)
    return np.where(known, np.maximum(logits, 0) - logits * truth + np.log1p(np.exp(-np.abs(logits))), 0.0)


def summed_gradient(weights, x, y, drop=(), rng=None) -> tuple[list, np.ndarray]:
    """Gradient of the summed loss over some rows, and the loss of each label.

    ``drop`` are the shares of hidden units left out at random, per hidden layer.
    """
    inputs, masks, h = [], [], x
    for k, (w, b) in enumerate(zip(weights[:-2:2], weights[1:-2:2])):
        inputs.append(h)
        h = np.maximum(h @ w + b, 0)
        share = drop[k] if k < len(drop) else 0.0
        mask = (rng.random(h.shape) >= share) / (1 - share) if share else 1.0
        masks.append((h > 0) * mask)
        h = h * mask
    inputs.append(h)
    logits = h @ weights[-2] + weights[-1]
    back = np.where(np.isnan(y), 0.0, _sigmoid(logits) - y)
    gradient = []
    for k in range(len(inputs) - 1, -1, -1):
        gradient = [inputs[k].T @ back, back.sum(axis=0)] + gradient
        if k:
            back = (back @ weights[2 * k].T) * masks[k - 1]
    return gradient, losses(logits, y).sum(axis=0)


def _blocks(rows: DataFrame, features: str, labels: list[str]):
    """RDD of (part, number, features, labels) blocks of numpy arrays."""
    def to_blocks(batches):
        parts = {}
        for batch in batches:
            x = np.stack([np.asarray(v, np.float64) for v in batch.column("x").to_pylist()]) if len(batch) else None
            if x is None:
                continue
            y = np.stack([np.array([np.nan if v is None else v for v in batch.column(f"y{i}").to_pylist()], np.float64)
                          for i in range(len(labels))], axis=1)
            part = np.array(batch.column("part").to_pylist())
            for p in np.unique(part):
                parts.setdefault(str(p), []).append((x[part == p], y[part == p]))
            for p, found in parts.items():
                if sum(len(a) for a, _ in found) >= BLOCK:
                    yield _record(p, parts[p])
                    parts[p] = []
        for p, found in parts.items():
            if found:
                yield _record(p, found)

    def _record(part, found):
        x, y = np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])
        return pa.RecordBatch.from_arrays(
            [pa.array([part]), pa.array([len(x)]), pa.array([x.tobytes()]), pa.array([y.tobytes()])], names=["part", "n", "x", "y"])

    def opened(index, found):
        for k, r in enumerate(found):
            yield (r["part"], (index, k), np.frombuffer(r["x"], np.float64).reshape(r["n"], -1),
                   np.frombuffer(r["y"], np.float64).reshape(r["n"], -1))

    plain = rows.select("part", F.col(features).alias("x"), *[F.col(c).cast("double").alias(f"y{i}") for i, c in enumerate(labels)])
    return plain.mapInArrow(to_blocks, "part string, n long, x binary, y binary").rdd.mapPartitionsWithIndex(opened)


def fit_network(rows: DataFrame, features: str, labels: list[str], hidden=(256, 128), drop=(0.3, 0.2),
                steps: int = 300, rate: float = 0.01, patience: int = 60, seed: int = 42) -> Network:
    """Train on rows with ``part`` = 'train', stop by those with 'validation'.

    ``features`` is an array of doubles, all of one width, ``labels`` hold 0, 1 or NULL
    (unknown: no loss). Training ends after ``steps`` passes, or when the validation loss
    has not fallen for ``patience`` of them; without validation rows the training loss
    stands for it. Rows with NULL features are left out. The rows are stored first, so that
    a pass that is repeated for a lost task reads the same rows in the same blocks.
    """
    rows = settled(rows.filter(F.col(features).isNotNull() & F.col("part").isin("train", "validation"))
                   .select("part", F.col(features), *labels))
    seen = rows.agg(F.count("*").alias("n"), F.max(F.size(features)).alias("width")).first()
    if not seen["n"]:
        raise ValueError("no rows to train on")
    sc = rows.sparkSession.sparkContext
    tasks = max(1, -(-seen["n"] // TASK_ROWS))
    blocks = _blocks(rows.coalesce(tasks), features, labels).persist(StorageLevel.MEMORY_AND_DISK)
    weights = initial_weights([seen["width"], *hidden, len(labels)], seed)
    network = Network(weights, list(labels))
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    best, best_loss, since = [w.copy() for w in weights], np.inf, 0
    try:
        for step in range(1, steps + 1):
            sent = sc.broadcast(weights)

            def one(total, block, sent=sent, step=step):
                part, number, x, y = block
                known = (~np.isnan(y)).sum(axis=0)
                if part == "validation":
                    model = Network(sent.value, labels)
                    logits = x
                    for w, b in zip(model.weights[:-2:2], model.weights[1:-2:2]):
                        logits = np.maximum(logits @ w + b, 0)
                    logits = logits @ model.weights[-2] + model.weights[-1]
                    return _added(total, (None, None, None, losses(logits, y).sum(axis=0), known))
                rng = np.random.default_rng([seed, step, *number])
                gradient, loss = summed_gradient(sent.value, x, y, drop, rng)
                return _added(total, (gradient, loss, known, None, None))

            gradient, loss, known, held_loss, held_known = blocks.treeAggregate((None,) * 5, one, _added)
            sent.destroy()
            if gradient is None:
                raise ValueError("no rows to train on")
            train_loss = float((loss / np.maximum(known, 1)).sum())
            held = train_loss if held_loss is None else float((held_loss / np.maximum(held_known, 1)).sum())
            network.steps.append((train_loss, held))
            if held < best_loss:
                best, best_loss, since = [w.copy() for w in weights], held, 0
            else:
                since += 1
                if since >= patience:
                    break
            scale = max(float(known.max()), 1.0)
            moved = []
            for w, g, m, v in zip(weights, gradient, first, second):
                g = g / scale
                m *= 0.9
                m += 0.1 * g
                v *= 0.999
                v += 0.001 * g * g
                moved.append(w - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8))
            weights = moved
    finally:
        blocks.unpersist()
    network.weights = best
    return network


def _added(a, b):
    """Sum of two partial results, element by element; None is nothing."""
    out = []
    for x, y in zip(a, b):
        if x is None or y is None:
            out.append(y if x is None else x)
        elif isinstance(x, list):
            out.append([p + q for p, q in zip(x, y)])
        else:
            out.append(x + y)
    return tuple(out)


def with_chances(df: DataFrame, network: Network, features: str, prefix: str = "chance_") -> DataFrame:
    """Add the probability of every label; NULL where the features are."""
    import pandas as pd

    def run(x: pd.Series) -> pd.Series:
        out = pd.Series([None] * len(x), dtype=object)
        known = np.flatnonzero(x.notna().to_numpy())
        if len(known):
            found = network.chances(np.stack([np.asarray(v, np.float64) for v in x.iloc[known]]))
            for i, row in zip(known, found):
                out.iloc[i] = row.tolist()
        return out

    said = F.pandas_udf(run, "array<double>")(F.col(features))
    scored = df.withColumn("_chances", said)
    return scored.select(
        *[F.col(f"`{c}`") for c in df.columns], *[F.col("_chances")[i].alias(f"{prefix}{c}") for i, c in enumerate(network.labels)])
