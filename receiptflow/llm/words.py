"""Words of many texts at once, straight from Arrow buffers, in numpy."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa

_U = np.uint64
#: Words of more bytes are hashed one by one.
_LONG = 64
_PART = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], _U)


def _alnum_table() -> np.ndarray:
    table = np.full(256, 32, np.uint8)
    for c in range(256):
        if chr(c).isascii() and chr(c).isalnum():
            table[c] = ord(chr(c).lower())
        elif c >= 128:
            table[c] = c
    return table


#: ASCII upper case to lower case, every other ASCII character that is no letter or digit to a space.
ALNUM = _alnum_table()


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column's slice and the offsets of its rows in them; null is empty."""
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    n = len(column)
    if n == 0 or column.buffers()[1] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    """``starts`` and ``ends`` of all words in ``data``; row r has the words ``rows[r]`` up to ``rows[r + 1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.rows)

    def hashes(self, seed: int = 0) -> np.ndarray:
        """64-bit hashes of the words' bytes: eight bytes at a time through ``mix``, long words by BLAKE2.

        Words of one length up to eight bytes never share a hash; others do by chance only, and under another seed
        other ones do. Where a result depends on equality, the bytes are compared with ``same``.
        """
        size = self.ends - self.starts
        out = mix(size.astype(_U) * _U(0x9E3779B97F4A7C15) + _U(seed))
        if not len(size):
            return out
        raw = np.concatenate([self.data, np.zeros(8, np.uint8)])
        eight = np.ndarray((len(self.data) + 1,), "<u8", raw, strides=(1,))
        at = np.flatnonzero(size <= _LONG)
        first, left = self.starts[at], size[at]
        with np.errstate(over="ignore"):
            while len(at):
                part = eight[first] & _PART[np.minimum(left, 8)]
                out[at] = mix(out[at] * _U(0xD6E8FEB86659FD93) + part)
                more = left > 8
                at, first, left = at[more], first[more] + 8, left[more] - 8
        for k in np.flatnonzero(size > _LONG):
            word = self.data[self.starts[k] : self.ends[k]].tobytes()
            out[k] = int.from_bytes(blake2b(word, digest_size=8, salt=seed.to_bytes(8, "little")).digest(), "little")
        return out

    def same(self, which: np.ndarray, other: Words, as_: np.ndarray) -> np.ndarray:
        """Whether the words ``which`` have the bytes of ``other``'s words ``as_``, pair by pair."""
        size = self.ends[which] - self.starts[which]
        equal = size == other.ends[as_] - other.starts[as_]
        size = np.where(equal, size, 0)
        total = np.concatenate([[0], np.cumsum(size)])
        step = np.arange(total[-1]) - np.repeat(total[:-1], size)
        off = self.data[np.repeat(self.starts[which], size) + step] != other.data[np.repeat(other.starts[as_], size) + step]
        equal[np.repeat(np.arange(len(size)), size)[off]] = False
        return equal

    def texts(self) -> list[bytes | None]:
        """Each row's words with a blank between them; none for a row without words."""
        out: list[bytes | None] = []
        for a, b in zip(self.rows[:-1].tolist(), self.rows[1:].tolist(), strict=True):
            out.append(b" ".join(self.data[self.starts[a] : self.ends[b - 1]].tobytes().split()) if b > a else None)
        return out


def mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(31))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(29))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(32))


def split_words(column: pa.Array, table: np.ndarray = ALNUM) -> Words:
    """Words of each row: runs of bytes that ``table`` does not map to a space. No word spans two rows."""
    raw, offsets = utf8(column)
    data = table[raw]
    n = len(data)
    inside = data != 32
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < n)]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(first)
    return Words(data, starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets))


def shingles(hashes: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words of each row, and the rows' offsets; a row of fewer words has one run."""
    counts = np.diff(rows)
    size = np.minimum(counts, k)
    runs = np.where(counts == 0, 0, counts - size + 1)
    out = np.zeros(len(runs) + 1, np.int64)
    np.cumsum(runs, out=out[1:])
    at = np.repeat(rows[:-1] - out[:-1], runs) + np.arange(out[-1])
    left = np.repeat(size, runs)
    value = np.zeros(len(at), _U)
    with np.errstate(over="ignore"):
        for j in range(k):
            here = hashes[np.minimum(at + j, max(len(hashes) - 1, 0))]
            step = mix(value * _U(0xD6E8FEB86659FD93) + here + _U(j + 1))
            value = step if j == 0 else np.where(left > j, step, value)
    return value, out


class Vocabulary:
    """Numbers for given words, and for those of texts: 0 on in the order of the bytes, -1 for any other word.

    Words are looked up by hash; the seed is such that no two of the vocabulary share one, and the bytes decide.
    """

    def __init__(self, words: set[bytes]):
        self.spelled = sorted(words)
        self.words = split_words(pa.array([w.decode(errors="surrogateescape") for w in self.spelled], pa.string()))
        self.seed = 0
        while len(np.unique(hashes := self.words.hashes(self.seed))) < len(self.spelled):
            self.seed += 1
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.seen = np.zeros(1 << 20, bool)
        self.seen[self.hashes >> _U(44)] = True

    def __len__(self) -> int:
        return len(self.spelled)

    def numbers(self, words: Iterable[bytes]) -> np.ndarray:
        place = {w: k for k, w in enumerate(self.spelled)}
        return np.array([place[w] for w in words], np.int64)

    def ids(self, words: Words) -> np.ndarray:
        hashes = words.hashes(self.seed)
        out = np.full(len(hashes), -1, np.int64)
        if len(self.hashes):
            maybe = np.flatnonzero(self.seen[hashes >> _U(44)])
            at = np.minimum(np.searchsorted(self.hashes, hashes[maybe]), len(self.hashes) - 1)
            same = self.hashes[at] == hashes[maybe]
            which, as_ = maybe[same], self.order[at[same]]
            equal = words.same(which, self.words, as_)
            out[which[equal]] = as_[equal]
        return out
