"""Token ids of whole texts, inside Python tasks.

A text is cut into segments, each a run of white space and the word after it, and marks
like a comma behind a Latin letter or digit begin a segment of their own, so that a word
is known with and without them. The byte-level tokenizers' patterns never join what such
cuts separate, so a text's ids are its segments' ids in a row (marks are cut off only if
the tokenizer is seen to keep them apart); a worker encodes each different segment once and looks the
others up by hash. The table of segments is bounded; when full, the half that was met in
the most buffers stays.
"""
import os
import sys
from itertools import chain

import numpy as np

from .words import Hasher, buffers, is_space, owners

ENTRIES, POOL = 1_000_000, 6_000_000  # segments and their ids in the table
BUFFER = 800_000  # bytes of text looked up at once
JOINED = 100  # new segments encoded as one text
_MARK, _PLAIN = np.zeros(256, bool), np.zeros(256, bool)
_MARK[list(b".,;:!?")] = True
_PLAIN[list(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = True
_NONE = np.zeros(0, np.uint32), np.zeros(0, np.int64)


def _row(lists):
    """Lists of ids one after another."""
    return np.fromiter(chain.from_iterable(lists), np.uint32, sum(map(len, lists)))


def _places(starts, lengths):
    """All places of spans in a row."""
    upto = np.cumsum(lengths)
    return np.repeat(starts - (upto - lengths), lengths) + np.arange(upto[-1] if len(upto) else 0)


class Encoder:
    """Ids by a tokenizer file, with a bounded table of known segments."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer, self.hasher = Tokenizer.from_file(path), Hasher()
        whole, apart = ([i for part in parts for i in self.tokenizer.encode(part, add_special_tokens=False).ids]
                        for parts in (["ab, 1.c;\n d!"], ["ab", ",", " 1", ".c", ";", "\n d", "!"]))
        self.marks_apart = whole == apart
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.width = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.width[i] = len(token)  # byte-level tokens have a letter for every byte
        self.clear()

    def clear(self):
        self.keys, self.entries = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # by key
        self.starts, self.lengths, self.uses = (np.zeros(1 << 12, np.int32) for _ in range(3))  # by entry
        self.pool, self.filled = np.zeros(1 << 16, np.uint32), 0

    def _room(self, entries, ids):
        while len(self.starts) < entries:
            self.starts, self.lengths, self.uses = (np.resize(x, 2 * len(x)) for x in (self.starts, self.lengths, self.uses))
        while len(self.pool) < ids:
            self.pool = np.resize(self.pool, 2 * len(self.pool))

    def _thin(self):
        """Keep the segments met in the most buffers: half a table, with no more than half the ids."""
        often = np.argsort(-self.uses[self.entries], kind="stable")[:ENTRIES // 2]
        often = np.sort(often[np.cumsum(self.lengths[self.entries[often]]) <= POOL // 2])
        keys, entries = self.keys[often], self.entries[often]
        lengths, uses = self.lengths[entries], self.uses[entries] // 2
        ids = self.pool[_places(self.starts[entries], lengths)]
        self.clear()
        self._add(keys, np.arange(len(keys)), ids, lengths)
        self.uses[:len(keys)] = uses

    def _add(self, keys, order, ids, lengths):
        """New keys, ascending, and the ids of ``keys[order]`` in a row."""
        known, end = len(self.keys), len(self.keys) + len(keys)
        self._room(end, self.filled + len(ids))
        self.pool[self.filled:self.filled + len(ids)] = ids
        self.lengths[known:end], self.uses[known:end] = lengths, 0
        self.starts[known:end] = self.filled + np.cumsum(lengths) - lengths
        self.filled += len(ids)
        entries = np.empty(len(keys), np.int64)
        entries[order] = np.arange(known, end)
        at = np.searchsorted(self.keys, keys)
        self.keys, self.entries = np.insert(self.keys, at, keys), np.insert(self.entries, at, entries)

    def _together(self, segments):
        """Ids of the segments in a row and the number of each, encoded many at a time.

        None if the bytes of the ids do not tell whose they are.
        """
        texts = [b"".join(segments[k:k + JOINED]).decode("utf-8", "replace") for k in range(0, len(segments), JOINED)]
        ids = _row([e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])
        upto, ends = np.cumsum(self.width[ids]), np.cumsum(np.fromiter(map(len, segments), np.int64, len(segments)))
        last = np.searchsorted(upto, ends)
        if len(ends) and last[-1] == len(ids) - 1 and (upto[last] == ends).all():
            return ids, np.diff(last, prepend=-1)
        return None

    def _ids(self, segments):
        """(order of the segments, their ids in that order, number of ids of each).

        Segments from white space to anything else are encoded many at a time, as cuts before white
        space change no ids. If these do not fit, the segments are encoded one by one.
        """
        free = [i for i, s in enumerate(segments) if s[0] in b" \t\n\x0b\f\r" and (
            32 < s[-1] < 128 or not s[-4:].decode("utf-8", "ignore")[-1:].isspace())]
        together = self._together([segments[i] for i in free])
        ids, lengths = together or _NONE
        free = free if together else []
        rest = np.ones(len(segments), bool)
        rest[free] = False
        alone = np.flatnonzero(rest).tolist()
        more = [e.ids for e in self.tokenizer.encode_batch_fast(
            [segments[i].decode("utf-8", "replace") for i in alone], add_special_tokens=False)]
        return free + alone, np.append(ids, _row(more)), np.append(lengths, np.fromiter(map(len, more), np.int64, len(more)))

    def _learn(self, keys, segments):
        self._add(keys, *self._ids(segments))

    def _found(self, keys):
        """Entries of the keys, -1 where there is none."""
        at = np.searchsorted(self.keys, keys)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == keys[known]
        entries = np.full(len(keys), -1)
        entries[known] = self.entries[at[known]]
        return entries

    def encoded(self, texts):
        """Yield (index of the text, ids as uint32) for every text, in order."""
        for at, buf, t0, t1 in buffers(texts, BUFFER):
            if len(self.keys) > ENTRIES or self.filled > POOL:
                self._thin()
            space = is_space(buf)
            begins = space.copy()
            begins[1:] &= ~space[:-1]
            if self.marks_apart:
                begins[1:] |= _MARK[buf[1:]] & _PLAIN[buf[:-1]]
            begins[t0] = True
            begins[t1] = False  # what ends a text in the buffer is not part of it
            starts = np.flatnonzero(begins)
            n = len(at)
            if not len(starts):
                for i in at:
                    yield i, np.zeros(0, np.uint32)
                continue
            owner = owners(t0, starts)
            ends = np.minimum(np.append(starts[1:], len(buf)), t1[owner])
            keys, first, inverse = np.unique(self.hasher.spans(buf, starts, ends), return_index=True, return_inverse=True)
            entry = self._found(keys)
            new = np.flatnonzero(entry < 0)
            if len(new):
                raw = buf.tobytes()
                self._learn(keys[new], [raw[a:b] for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist())])
                entry[new] = self._found(keys[new])
            self.uses[entry] += 1
            lengths, begin = self.lengths[entry][inverse], self.starts[entry][inverse]
            ids = self.pool[_places(begin, lengths)]
            upto = np.cumsum(lengths)
            cuts = np.concatenate([[0], upto])[np.searchsorted(owner, np.arange(n + 1))]
            for i in range(n):
                yield at[i], ids[cuts[i]:cuts[i + 1]]


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file; kept between tasks."""
    kept = sys.__dict__.setdefault("_kept_encoders", {})
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]
