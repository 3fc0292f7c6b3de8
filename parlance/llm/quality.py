"""Quality rules as a ledger of failure bits, applied by versioned policies.

Every rule is evaluated once per document: the ledger keeps the measurements and one
bit per failed rule. A policy is a mask of the bits that matter, so a new version of a
policy, or the effect of leaving a rule out, is read from the ledger without the texts.
"""
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import Hasher, buffers, is_space, owners, runs, windows

MEASURES = ["n_chars_seen", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
            "n_repeat_words", "n_letters", "n_marks", "n_capitals"]


@dataclass(frozen=True)
class Rule:
    """A named SQL condition over the measures that is true when a document fails."""
    name: str
    fails: str


# Conditions compare whole numbers only, so that every engine decides alike.
RULES = [
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("long_words", "word_chars > 10 * n_words"),
    Rule("short_words", "2 * word_chars < 5 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("repeated_lines", "2 * n_dup_lines > n_lines"),
    Rule("few_letters", "10 * n_letters < 6 * word_chars"),
    Rule("exclamations", "10 * n_marks > 3 * n_words"),
    Rule("capitals", "10 * n_capitals > 6 * n_words"),
]

# Version -> names of the rules a document must not fail.
POLICIES = {
    "base": ["few_words", "repeated_words"],
    "v1": [r.name for r in RULES],
}


def bit(name: str, rules=RULES) -> int:
    return 1 << [r.name for r in rules].index(name)


def policy_mask(version: str, rules=RULES, policies=POLICIES) -> int:
    """The bits of all rules of one version of the policy."""
    return sum(bit(name, rules) for name in policies[version])


def _measure(texts) -> np.ndarray:
    out = np.zeros((len(texts), len(MEASURES)), np.int64)
    hasher = Hasher()
    symbol = np.zeros(256, bool)
    symbol[list(b"#*$%&|<>")] = True
    letter = np.zeros(256, bool)
    letter[65:91] = letter[97:123] = letter[0xC3:] = True  # Latin letters with marks and beyond
    capital = np.zeros(256, bool)
    capital[65:91] = True
    small = np.zeros(256, bool)
    small[97:123] = True
    for at, buf, t0, t1 in buffers(texts):
        n = len(at)
        points = (buf & 0xC0) != 0x80
        space = is_space(buf)

        def per_text(mask):
            total = np.concatenate([[0], np.cumsum(mask)])
            return total[t1] - total[t0]

        w0, w1 = runs(~space)
        word_of = owners(t0, w0)
        n_words = np.bincount(word_of, minlength=n)
        h = hasher.spans(buf, w0, w1)
        # words that lie in a window of three which the text has twice or more
        tri, tri_of, first = windows(h, word_of, 3)
        repeated = np.zeros(len(h) + 3, bool)
        if len(tri):
            again = _seen_twice(tri, tri_of)
            for k in range(3):
                repeated[first[again] + k] = True
        n_repeat = np.bincount(word_of[repeated[:len(h)]], minlength=n)
        # lines that hold a word and equal an earlier one
        breaks = np.flatnonzero(buf == 10)
        l0, l1 = np.concatenate([[0], breaks[:-1] + 1]), breaks
        words_before = np.concatenate([[0], np.cumsum(~space)])
        full = words_before[l1] > words_before[l0]
        l0, l1 = l0[full], l1[full]
        line_of = owners(t0, l0)
        n_lines = np.bincount(line_of, minlength=n)
        lines = hasher.spans(buf, l0, l1) if len(l0) else np.zeros(0, np.uint64)
        order = np.lexsort((lines, line_of))
        same = (lines[order][1:] == lines[order][:-1]) & (line_of[order][1:] == line_of[order][:-1])
        n_dup = np.bincount(line_of[order[1:][same]], minlength=n)
        # words with a capital and no small letter, of two letters or more
        caps, lows = np.concatenate([[0], np.cumsum(capital[buf])]), np.concatenate([[0], np.cumsum(small[buf])])
        shouted = (caps[w1] - caps[w0] >= 2) & (lows[w1] == lows[w0])
        out[at] = np.stack([
            per_text(points), n_words, per_text(points & ~space), per_text(symbol[buf]), n_lines, n_dup,
            n_repeat, per_text(letter[buf]), per_text(buf == 33),
            np.bincount(word_of[shouted], minlength=n)], axis=1)
    return out


def _seen_twice(h, owner):
    order = np.lexsort((h, owner))
    same = (h[order][1:] == h[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    twice = np.zeros(len(h), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return np.flatnonzero(twice)


def measured(df: DataFrame, text: str = "text", keep=()) -> DataFrame:
    """The ``keep`` columns and all measures of each row's whole text.

    NULL and empty texts measure 0 everywhere. Rows are neither merged nor dropped, so
    repeated rows and NULL ids stay. Words are ``[^\\x20\\x09-\\x0D]+``.
    """
    return _measured(df, text, list(keep), False)


def _measured(df, text, keep, with_text):
    """``keep`` columns as they are, and the measures of ``text``."""
    inner = df.select(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keep)],
                      *([] if with_text else [F.col(f"`{text}`").alias("t")]))
    t = f"k{keep.index(text)}" if with_text else "t"
    kept = inner.drop("t").schema.fields
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in kept] + [f"{m} long" for m in MEASURES])
    names = [f.name for f in kept]

    def run(batches):
        for batch in batches:  # Arrow batches, so that values of any type come back unchanged
            found = _measure(batch.column(t).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], *[pa.array(found[:, i]) for i in range(len(MEASURES))]],
                names=[*names, *MEASURES])

    out = inner.mapInArrow(run, schema)
    return out.select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(keep)], *MEASURES)


def failed_bits(rules=RULES) -> Column:
    """One bit per failed rule, in the order of the rules."""
    bits = [F.when(F.expr(r.fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, r in enumerate(rules)]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return total


def ledger(df: DataFrame, text: str = "text", keep=("doc_id",), rules=RULES) -> DataFrame:
    """``keep`` columns, measures and ``failed``, the bitmask of failed rules."""
    return measured(df, text, keep).withColumn("failed", failed_bits(rules))


def verdict(version: str, rules=RULES, policies=POLICIES) -> Column:
    """True where the ledger's ``failed`` has no bit of the policy."""
    mask = F.lit(policy_mask(version, rules, policies)).cast("long")
    return F.col("failed").bitwiseAND(mask) == 0


def ablations(book: DataFrame, version: str = "v1", rules=RULES, policies=POLICIES) -> DataFrame:
    """Per rule of a policy: documents failing it, failing only it, kept without it.

    One pass over the ledger: rows are first counted per mask, of which there are at
    most 2 to the number of rules, and the rules read those counts.
    """
    mask = policy_mask(version, rules, policies)
    masks = book.groupBy(F.col("failed").bitwiseAND(F.lit(mask).cast("long")).alias("failed")).count()
    named = F.explode(F.array(*[
        F.struct(F.lit(n).alias("rule"), F.lit(bit(n, rules)).cast("long").alias("bit")) for n in policies[version]]))
    each = masks.select("failed", "count", named.alias("r"))
    hit = F.col("failed").bitwiseAND(F.col("r.bit")) != 0
    only = F.col("failed") == F.col("r.bit")
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("count"))), F.lit(0))
    return each.groupBy(F.col("r.rule").alias("rule")).agg(
        total(hit).alias("fails"), total(only).alias("fails_only_this"),
        total((F.col("failed") == 0) | only).alias("kept_without"))


def apply_policy(df: DataFrame, version: str = "v1", text: str = "text") -> DataFrame:
    """The documents a policy keeps, with all their columns, whatever their names."""
    safe = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)])
    book = _measured(safe, f"c{df.columns.index(text)}", safe.columns, True).withColumn("failed", failed_bits())
    return book.filter(verdict(version)).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(df.columns)])
