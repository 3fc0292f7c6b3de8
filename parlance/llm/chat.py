"""Chat formatting with minimum-cost repair of the roles.

Legal conversations are those an automaton accepts: an optional system turn, then user
and assistant turns in alternation, ending with an assistant turn. A conversation's
turns pass through the automaton by edits, each with a cost: keep a turn, give it
another role, merge it into the turn before it, or insert an empty turn before it or at
the end. Dynamic programming finds the cheapest repair; equal costs are decided by the
order of the edits in ``EDITS``. The repaired sequence is rendered by a template.

A turn is a step from state to state, so a run of turns is a matrix of cheapest costs
and runs combine by min-plus products. Conversations are cut into chunks of at most
``CHUNK`` turns: one pass makes the matrices, one walks over the few matrices of each
conversation, and a last one repairs every chunk on its own, given its first state and the
cost of going on from each last state. So a conversation with a third of all turns is
shared by many tasks, and the repair does not depend on where it is cut.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import stored

CHUNK = 1000
# States: what the rendered text ends with.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
AFTER = {"system": SYSTEM, "user": USER, "assistant": ASSISTANT}
NAMES = {v: k for k, v in AFTER.items()}
# State -> roles that may follow it.
LEGAL = {START: ("system", "user"), SYSTEM: ("user",), USER: ("assistant",), ASSISTANT: ("user",)}
COSTS = {"keep": 0, "merge": 1, "relabel": 3, "insert": 2}
EDITS = ("keep", "merge", "insert", "relabel")
INSERTED = ""
TEMPLATE = ("<|{role}|>\n", "\n<|end|>\n")
_BIG = 1 << 40


def _moves(role):
    """All edits of a turn: (from, to, cost, edit, roles of inserted turns, role of the turn)."""
    out = []
    for state in range(STATES):
        for inserted in _insertions(state):
            now = AFTER[inserted[-1]] if inserted else state
            cost = COSTS["insert"] * len(inserted)
            for new in LEGAL[now]:
                same = new == role
                out.append((state, AFTER[new], cost + (COSTS["keep"] if same else COSTS["relabel"]),
                            "insert" if inserted else "keep" if same else "relabel", inserted, new))
        if state != START:  # merged into the turn before, which costs the same for any role but is right for an equal one
            out.append((state, state, COSTS["merge"] + (0 if NAMES[state] == role else COSTS["relabel"]), "merge", (), None))
    order = {e: i for i, e in enumerate(EDITS)}
    return sorted(out, key=lambda m: (m[2], order[m[3]], m[1], len(m[4])))


def _insertions(state):
    """Sequences of empty turns that can come before a turn: none or one."""
    return [()] + [(r,) for r in LEGAL[state]]


MOVES = {role: _moves(role) for role in (*AFTER, None)}
# What it costs to end in a state: an assistant turn is missing after a user's.
ENDING = [0, 2 * COSTS["insert"], COSTS["insert"], 0]


def _step(role):
    m = np.full((STATES, STATES), _BIG, np.int64)
    for a, b, cost, *_ in MOVES[role]:
        m[a, b] = min(m[a, b], cost)
    return m


STEPS = {role: _step(role) for role in MOVES}


def chunk_matrix(roles) -> np.ndarray:
    """Cheapest cost from each state to each state over a run of turns."""
    out = np.full((STATES, STATES), _BIG, np.int64)
    np.fill_diagonal(out, 0)
    for role in roles:
        out = np.minimum((out[:, :, None] + STEPS[role][None, :, :]).min(axis=1), _BIG)
    return out


def costs_after(matrices, ending=tuple(ENDING)):
    """Cheapest cost from each state to the end: before the first run, and after every run."""
    out = [np.array(ending, np.int64)]
    for m in reversed(matrices):
        out.append(np.minimum((m + out[-1][None, :]).min(axis=1), _BIG))
    return out[::-1]


def repaired(roles, first: int, after):
    """(one ``(edit, inserted roles, role, role before)`` per turn, last state) of the
    cheapest way from ``first``; ``after`` is the cost of going on from each last state.
    Turn by turn, the first of equally good edits is taken."""
    rest = costs_after([STEPS[r] for r in roles], after)
    out, state = [], first
    for i, role in enumerate(roles):
        for a, b, cost, edit, inserted, new in MOVES[role]:
            if a == state and cost + rest[i + 1][b] == rest[i][state]:
                out.append((edit, inserted, new, NAMES.get(state)))
                state = b
                break
    return out, state


def known_role(role):
    """A role in lower case; any other than the three, and NULL, is unknown."""
    role = role.strip().lower() if isinstance(role, str) else None
    return role if role in AFTER else None


def ending_turns(last: int):
    """Roles of the empty turns that a conversation ending in a state still needs."""
    return {SYSTEM: ("user", "assistant"), USER: ("assistant",)}.get(last, ())


def chunked(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``(conv, chunk, roles, texts)``: turns in order, one row per chunk of at most ``CHUNK``.

    Order is turn (NULL first), then role and text. Rows are dealt to partitions by range of
    that order, so that a long conversation spans several; where a partition begins, so
    does a chunk. A task holds one chunk at a time.
    """
    rows = turns.select(F.col(f"`{conv}`").cast("string").alias("conv"), F.col(f"`{turn}`").alias("turn"),
                        F.col(f"`{role}`").alias("role"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), "text"]
    longest = CHUNK

    def cut(batches):
        import pyspark
        number = pyspark.TaskContext.get().partitionId() << 32
        now, roles, texts = object(), [], []
        for pdf in batches:
            out = []
            for c, r, t in zip(pdf["conv"].tolist(), pdf["role"].tolist(), pdf["text"].tolist()):
                if c != now or len(roles) == longest:
                    if roles:
                        out.append((now, number, roles, texts))
                        number += 1
                    now, roles, texts = c, [], []
                roles.append(known_role(r) or "")
                texts.append(t)
            yield pd.DataFrame(out, columns=["conv", "chunk", "roles", "texts"])
        if roles:
            yield pd.DataFrame([(now, number, roles, texts)], columns=["conv", "chunk", "roles", "texts"])

    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(
        cut, "conv string, chunk long, roles array<string>, texts array<string>")


def _roles(values):
    return [r or None for r in values]


def formatted(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
              text: str = "text") -> DataFrame:
    """``conv, n_turns, cost, n_merged, n_relabelled, n_inserted, part, rendered``.

    One row per conversation and, for conversations of more than one chunk, per chunk
    (``part`` from 0; the texts of the parts in a row are the whole); counts and cost are
    those of the whole conversation. NULL texts are empty, unknown and NULL roles cost a
    relabel, a NULL conversation is one of its own, repeated rows are turns of their own
    (equal neighbours merge). Extra columns are not read. An empty table gives an empty one.
    """
    chunks = stored(chunked(turns, conv, turn, role, text))
    # Only conversations of several chunks hand costs and states on from chunk to chunk.
    long = stored(chunks.groupBy("conv").agg(F.count("*").alias("parts")).filter("parts > 1"))
    beside = lambda rows, names, how: rows.join(
        names.withColumnRenamed("conv", "l_conv"), F.col("conv").eqNullSafe(F.col("l_conv")), how)
    several = beside(chunks, long, "left_semi")
    alone = beside(chunks, long, "left_anti").withColumns({
        "part": F.lit(0), "parts": F.lit(1), "first": F.lit(START), "after": F.array(*[F.lit(c) for c in ENDING]).cast("array<long>")})

    def matrices(batches):
        for pdf in batches:
            yield pd.DataFrame({"conv": pdf["conv"], "chunk": pdf["chunk"],
                                "matrix": [chunk_matrix(_roles(r)).ravel().tolist() for r in pdf["roles"]]})

    def back(pdf):
        pdf = pdf.sort_values("chunk")
        after = costs_after([np.array(m).reshape(STATES, STATES) for m in pdf["matrix"]])
        return pd.DataFrame({"chunk": pdf["chunk"], "part": range(len(pdf)), "parts": len(pdf),
                             "after": [a.tolist() for a in after[1:]]})

    def through(batches):
        for pdf in batches:
            yield pd.DataFrame({"conv": pdf["conv"], "chunk": pdf["chunk"], "to": [
                [repaired(_roles(r), s, np.array(a))[1] for s in range(STATES)] for r, a in zip(pdf["roles"], pdf["after"])]})

    def forth(pdf):
        pdf = pdf.sort_values("chunk")
        first = [START]
        for to in pdf["to"]:
            first.append(int(to[first[-1]]))
        return pd.DataFrame({"chunk": pdf["chunk"], "first": first[:-1]})

    # Chunk numbers are unique in the whole table, so joins need no conversation.
    ways = stored(several.select("conv", "chunk", "roles").mapInPandas(
        matrices, "conv string, chunk long, matrix array<long>").groupBy("conv").applyInPandas(
        back, "chunk long, part int, parts int, after array<long>"))
    firsts = stored(several.select("conv", "chunk", "roles").join(ways, "chunk").mapInPandas(
        through, "conv string, chunk long, to array<int>").groupBy("conv").applyInPandas(forth, "chunk long, first int"))
    begun = several.join(ways.join(firsts, "chunk"), "chunk").select(*alone.columns)

    def render(batches):
        for pdf in batches:
            out = [_rendered(*row) for row in zip(pdf["roles"], pdf["texts"], pdf["first"], pdf["after"],
                                                  pdf["part"] == pdf["parts"] - 1)]
            yield pd.concat([pdf[["conv", "part"]], pd.DataFrame(
                out, columns=["n", "paid", "merged", "relabelled", "inserted", "rendered"], index=pdf.index)], axis=1)

    shape = "conv string, part int, n long, paid long, merged long, relabelled long, inserted long, rendered string"
    one = alone.mapInPandas(render, shape)
    many = stored(begun.mapInPandas(render, shape))
    counts = ["n", "paid", "merged", "relabelled", "inserted"]
    sums = many.groupBy("conv").agg(*[F.sum(c).alias(f"s_{c}") for c in counts]).withColumnRenamed("conv", "s_conv")
    summed = many.join(sums, F.col("conv").eqNullSafe(F.col("s_conv"))).select(
        "conv", "part", *[F.col(f"s_{c}").alias(c) for c in counts], "rendered")
    return one.union(summed).select(
        F.col("conv").cast(turns.schema[conv].dataType).alias(conv), F.col("n").alias("n_turns"), F.col("paid").alias("cost"),
        F.col("merged").alias("n_merged"), F.col("relabelled").alias("n_relabelled"), F.col("inserted").alias("n_inserted"),
        "part", "rendered")


def _rendered(roles, texts, first, after, ends):
    """(turns, cost, merges, relabels, insertions, text) of one chunk."""
    roles, first = _roles(roles), int(first)
    edits, last = repaired(roles, first, np.array(after))
    out, merged, relabelled, inserted = [], 0, 0, 0
    opened = first != START  # the turn of the chunk before may still go on
    for (edit, added, new, before), value, known in zip(edits, texts, roles):
        if edit == "merge":
            merged += 1
            relabelled += known != before
            out.append("\n" + value)
            continue
        inserted += len(added)
        relabelled += known != new
        for r in (*added, new):
            out.append((TEMPLATE[1] if opened else "") + TEMPLATE[0].format(role=r))
            opened = True
        out.append(value)
    if ends:
        for r in ending_turns(last):
            inserted += 1
            out.append(TEMPLATE[1] + TEMPLATE[0].format(role=r))
        out.append(TEMPLATE[1])
    paid = COSTS["merge"] * merged + COSTS["relabel"] * relabelled + COSTS["insert"] * inserted
    return len(roles), paid, merged, relabelled, inserted, "".join(out)
