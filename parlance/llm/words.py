"""Words and lines of whole texts as 64-bit hashes, many texts at a time.

Used inside Python tasks. Texts are laid into byte buffers of about ``BUFFER`` bytes
(one longer text makes a longer buffer), and every step is a pass over a buffer, so
memory follows the buffer and not the Arrow batch. A span of bytes is hashed by a
polynomial over random byte values modulo 2**64 with a final mix; two different spans
agree with a probability of about 2**-60.
"""
import numpy as np

BUFFER = 400_000
_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 2 ** 64)


def mix(x):
    """The splitmix64 finaliser."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def buffers(texts, most=BUFFER):
    """Yield (positions of the texts, byte buffer, starts, ends); NULL is empty.

    Every text is followed by a newline that belongs to none.
    """
    part, at, size = [], [], 0
    for i, text in enumerate(texts):
        raw = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""
        if part and size + len(raw) > most:
            yield _laid(at, part)
            part, at, size = [], [], 0
        part.append(raw)
        at.append(i)
        size += len(raw) + 1
    if part:
        yield _laid(at, part)


def _laid(at, part):
    lengths = np.fromiter(map(len, part), np.int64, len(part))
    ends = np.cumsum(lengths + 1) - 1
    buf = np.frombuffer(b"\n".join(part) + b"\n", np.uint8)
    return np.array(at), buf, ends - lengths, ends


class Hasher:
    """Hashes spans of a buffer."""

    def __init__(self, lower=False):
        table = mix(np.arange(1, 257, dtype=np.uint64))
        if lower:  # only A-Z, as the texts' other letters stay as they are
            table[65:91] = table[97:123]
        self.table = table
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n):
        if len(self.up) < n:
            with np.errstate(over="ignore"):
                one = np.ones(1, np.uint64)
                self.up = np.cumprod(np.concatenate([one, np.full(n, _MULTIPLIER, np.uint64)]))
                self.down = np.cumprod(np.concatenate([one, np.full(n, _INVERSE, np.uint64)]))
        return self.up[:n], self.down

    def spans(self, buf, starts, ends):
        """Hash of each ``buf[start:end]``."""
        with np.errstate(over="ignore"):
            up, down = self._powers(len(buf))
            total = np.zeros(len(buf) + 1, np.uint64)
            np.cumsum(self.table[buf] * up, out=total[1:])
            h = (total[ends] - total[starts]) * down[starts]
            h += (ends - starts).astype(np.uint64)
        return mix(h)


def is_space(buf):
    """Bytes that separate words: blank and 0x09 to 0x0D."""
    return (buf == 32) | ((buf >= 9) & (buf <= 13))


def runs(mask):
    """Starts and ends of the runs of true values."""
    edge = np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def owners(text_starts, starts):
    """Index of the text that each span starts in."""
    return np.searchsorted(text_starts, starts, "right") - 1


def windows(hashes, owner, width):
    """Hash and owner of every ``width`` neighbouring words of one text."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        h = np.zeros(n, np.uint64)
        for k in range(width):
            h = h * np.uint64(_MULTIPLIER) + hashes[k:k + n]
    whole = owner[:n] == owner[width - 1:]
    first = np.flatnonzero(whole)
    return mix(h[first]), owner[first], first
