"""Best-fit packing of tokenized documents with certified bin counts.

1. Documents become ids (``tokens``) and an end id; those longer than a sequence are cut
   into full pieces, the first of which may be shorter.
2. Pieces are dealt evenly to partitions of about ``PART_ROWS`` and each partition packs
   its own by best-fit decreasing.
3. Dual feasible functions bound from below how many sequences a partition's pieces
   need. A partition that reaches its bound is certified and done.
4. Partitions with a gap keep their exactly full sequences and give all other pieces
   back; these are dealt anew, to half as many partitions for their number, and packed
   again, down to one partition or to ``MOST`` times ``PART_ROWS`` pieces in each. A round
   that saves no sequence is dropped, and the next one starts from the best so far.
"""
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import stored
from .tokens import encoder

PART_ROWS, MOST = 20_000, 32  # pieces of a partition in the first round, times as many in the last
ROUNDS = 8
PIECE = "row_id string, piece int, start long, length long, ids_crc32 long"


def cut(length: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document."""
    if length <= size:
        return [(0, length)]
    head = length % size or size
    return [(0, head)] + [(s, size) for s in range(head, length, size)]


def pieces(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text", size: int = 2048,
           end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """``row_id, piece, start, length, ids_crc32`` and, on demand, ``ids`` of every piece.

    ``row_id`` is the id as a string, as longs beside a NULL would become doubles in Python.
    """
    schema = PIECE + (", ids array<int>" if with_ids else "")

    def run(batches):
        encode = encoder(tokenizer)
        for pdf in batches:
            out, names = [], pdf["row_id"].tolist()
            for i, ids in encode.encoded(pdf["t"].tolist()):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for k, (start, length) in enumerate(cut(len(ids), size)):
                    part = ids[start:start + length]
                    out.append((names[i], k, start, length, zlib.crc32(part.tobytes()),
                                *([part.astype(np.int32)] if with_ids else [])))
                if len(out) >= 20_000:
                    yield pd.DataFrame(out, columns=columns)
                    out = []
            yield pd.DataFrame(out, columns=columns)

    columns = ["row_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    return df.select(F.col(f"`{id_col}`").cast("string").alias("row_id"), F.col(f"`{text}`").alias("t")).mapInPandas(run, schema)


def best_fit_decreasing(lengths, size: int):
    """(bin of each item, number of bins): longest first, into the fullest bin that has room."""
    order = np.argsort(-lengths, kind="stable")
    bins = np.empty(len(lengths), np.int64)
    open_bins = [[] for _ in range(size + 1)]  # by room left
    rooms, count = 0, 0  # bit r: some bin has room r
    for i, length in zip(order.tolist(), lengths[order].tolist()):
        fit = rooms >> length
        if fit:
            room = length + (fit & -fit).bit_length() - 1
            b = open_bins[room].pop()
            if not open_bins[room]:
                rooms ^= 1 << room
        else:
            room, b, count = size, count, count + 1
        bins[i] = b
        left = room - length
        open_bins[left].append(b)
        rooms |= 1 << left
    return bins, count


def lower_bound(lengths, size: int) -> int:
    """Sequences that the items need at least."""
    return bound_of_counts(np.bincount(lengths, minlength=size + 1)[:size + 1], size)


def bound_of_counts(count, size: int) -> int:
    """The bound for ``count[x]`` items of length x, by two families of dual feasible functions."""
    x = np.arange(size + 1)
    number, total = np.cumsum(count), np.cumsum(count * x)
    low = np.arange(0, size // 2 + 1)  # items under it count nothing, items over size - low count full
    below = np.where(low > 0, total[np.maximum(low - 1, 0)], 0)
    middle = total[size - low] - below
    best = int(np.max(-(-(middle + size * (number[-1] - number[size - low])) // size)))
    for k in range(1, 41):
        scaled = (k + 1) * x
        exact = scaled % size == 0
        worth = np.where(exact, x * k, (scaled // size) * size)  # times k
        best = max(best, -(-int((worth * count).sum()) // (size * k)))
    return best


def certificate(packed: DataFrame, size: int = 2048) -> DataFrame:
    """One row: pieces, sequences, ``bound`` that no packing can be under, and ``gap``.

    Lengths are counted by Spark; what reaches the driver is a number per length. Nothing
    packed gives zeros.
    """
    lengths = packed.groupBy("length").agg(F.count("*").alias("n")).collect()
    count = np.zeros(size + 1, np.int64)
    for r in lengths:
        count[r["length"]] = r["n"]
    bound = bound_of_counts(count, size) if count.any() else 0
    return packed.agg(F.count("*").alias("pieces"), F.count_distinct("sequence_id").alias("sequences")).withColumns(
        {"bound": F.lit(bound).cast("long"), "gap": F.col("sequences") - F.lit(bound)})


def _packed(items: DataFrame, parts: int, size: int, round_no: int) -> DataFrame:
    """One round: items with sequence, offset and whether their place is final."""
    schema = PIECE + ", sequence_id long, offset long, final boolean, excess long"

    def run(batches):
        import pyspark
        pdf = pd.concat([b for b in batches] or [pd.DataFrame()], ignore_index=True)
        if not len(pdf):
            return
        part = pyspark.TaskContext.get().partitionId()
        pdf = pdf.sort_values(["length", "row_id", "piece", "start", "ids_crc32"], ascending=False, ignore_index=True)
        lengths = pdf["length"].to_numpy()
        bins, count = best_fit_decreasing(lengths, size)
        excess = count - lower_bound(lengths, size)
        order = np.argsort(bins, kind="stable")
        upto = np.cumsum(lengths[order])
        begin = np.searchsorted(bins[order], np.arange(count))
        base = np.concatenate([[0], upto])[begin]
        offset = np.empty(len(pdf), np.int64)
        offset[order] = upto - lengths[order] - base[bins[order]]
        full = np.bincount(bins, weights=lengths, minlength=count)[bins] == size
        yield pdf.assign(sequence_id=(round_no << 56) + (part << 32) + bins, offset=offset,
                         final=full | (excess == 0), excess=excess)

    return items.repartition(parts).mapInPandas(run, schema)


def pack(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text", size: int = 2048,
         end_id: int = 0) -> DataFrame:
    """``id_col, piece, start, length, ids_crc32, sequence_id, offset`` of every piece.

    NULL and empty texts are the end id alone. NULL ids and repeated rows are packed like
    any other row; an empty table gives an empty one; extra columns are not read. Pieces
    are dealt by row, so no id makes a partition large. Jobs run when called.
    """
    all_pieces = stored(pieces(df, tokenizer, id_col, text, size, end_id))
    columns = ["row_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    alone = all_pieces.filter(F.col("length") == size).select(
        "*", (F.lit(127 << 56) + F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    done, items = [alone], all_pieces.filter(F.col("length") < size)
    count, width, best = items.count(), PART_ROWS, None
    for round_no in range(ROUNDS):
        if not count:
            break
        parts = -(-count // width)
        now = stored(_packed(items, parts, size, round_no))
        sequences, = now.agg(F.count_distinct("sequence_id")).first()
        if best is None or sequences < best[1]:
            done.append(now.filter("final").select(columns))
            rest = now.filter("NOT final")
            count, open_sequences = rest.agg(F.count("*"), F.count_distinct("sequence_id")).first()
            best, items = (rest.select(columns), open_sequences), rest.drop("sequence_id", "offset", "final", "excess")
        if parts == 1 or width == MOST * PART_ROWS:
            break
        width *= 2
    if count:
        done.append(best[0])
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out.withColumn("row_id", F.col("row_id").cast(df.schema[id_col].dataType)).withColumnRenamed("row_id", id_col)
