"""URL rules as a bit-parallel wildcard automaton.

Every rule is a glob over the canonical form of a URL. All globs together are one row of bits, cut into 64-bit
words; reading one byte of a URL moves every glob at once by a shift and an AND (Shift-And), and thousands of URLs
are read side by side in numpy. ``*`` keeps a bit set (a self-loop), ``?`` is a position that every byte fits.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from receiptflow.llm.shared import add_columns, inner_names, without
from receiptflow.llm.words import utf8

#: Bytes that UTF-8 never holds: the start of the host, and between host and path.
_EDGE, _SEP = 0xFE, 0xFF
_U = np.uint64


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host and its subdomains, below a path; both may hold ``*`` and ``?``. A path ends open."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def glob(self) -> list[int | str]:
        """As bytes and wildcards over edge, ``.`` + host, separator, path."""
        out: list[int | str] = [_EDGE, "*", ord(".")]
        for part, end in ((self.host, [_SEP]), (self.path, ["*"])):
            for b in part.encode():
                out.append({42: "*", 63: "?"}.get(b, b))
            out += end
        return out


class ShiftAnd:
    """All globs packed into multiword masks."""

    def __init__(self, globs: list[list[int | str]]):
        self.start, self.final, loops, places = [], [], [], []
        bit = 0
        for glob in globs:
            self.start.append(bit)  # this bit is the state before the first byte
            for x in glob:
                if x == "*":
                    loops.append(bit)
                else:
                    bit += 1
                    places.append((bit, x))
            self.final.append(bit)
            bit += 1
        self.words = max(1, (bit + 63) // 64)
        self.accept = np.zeros((256, self.words), _U)
        for at, x in places:
            for c in range(256) if x == "?" else (x,):
                # no wildcard crosses from the host to the path: a glob holds one separator, as a URL does
                if x != "?" or c not in (_EDGE, _SEP):
                    self.accept[c, at // 64] |= _U(1 << (at % 64))
        self.begin, self.loop, self.bound = (self._mask(b) for b in (self.start, loops, self.start))

    def _mask(self, bits: list[int]) -> np.ndarray:
        out = np.zeros(self.words, _U)
        for b in bits:
            out[b // 64] |= _U(1 << (b % 64))
        return out

    def run(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Which globs (columns) fit which strings (rows) as a whole."""
        lengths = np.diff(offsets)
        order = np.argsort(-lengths, kind="stable")
        first, left = offsets[:-1][order], lengths[order]
        state = np.tile(self.begin, (len(order), 1))
        for k in range(int(left[0]) if len(left) else 0):
            n = int(np.searchsorted(-left, -k, side="left"))  # strings longer than k come first
            old = state[:n]
            moved = old << _U(1)
            moved[:, 1:] |= old[:, :-1] >> _U(63)
            moved &= ~self.bound
            moved &= self.accept[data[first[:n] + k]]
            state[:n] = moved | (old & self.loop)
        final = np.array(self.final)
        hit = np.zeros((len(order), len(final)), bool)
        if len(final):
            hit[order] = (state[:, final // 64] >> (final % 64).astype(_U)) & _U(1) == 1
        return hit


def host_and_path(url):
    """Host (A-Z lower-cased) and path of a URL column; both empty where it is null or has no ``://``."""
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, parts, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, parts, 2), F.lit(""))


def filter_urls(pages: DataFrame, rules: list[Rule], url_col: str = "url", default: str = "allow", own: list[Rule] | None = None) -> DataFrame:
    """Each row with ``host``, ``path``, ``rule``, ``verdict`` and ``own_glob``; of the rules that fit the longest decides.

    Where two of the same length fit, the first listed wins. Where no rule fits, ``rule`` is null and the longest fitting
    one of the method's ``own`` globs decides, named in ``own_glob``; else the verdict is ``default``. One automaton reads
    both lists at once. A null or malformed URL has an empty host and path, which no rule fits. A very long URL is read
    in linear time. Repeated rows are judged alike, an empty table gives an empty one, and input columns named like the
    outputs are replaced. The rules are code of the caller, sent with the task; they do not grow with the pages.
    """
    host, path = host_and_path(F.col(url_col))
    host_, path_, bytes_ = inner_names("host", "path", "bytes")
    framed = without(pages.withColumns({host_: host, path_: path}), ["host", "path"])
    framed = framed.withColumnsRenamed({host_: "host", path_: "path"}).withColumn(bytes_, F.concat("host", "path"))
    given, rules = len(rules), [*rules, *(own or [])]
    ranked = sorted(range(len(rules)), key=lambda i: (i >= given, -len(rules[i].text), i))
    texts = [rules[i].text for i in ranked]
    verdicts = [rules[i].verdict for i in ranked]
    globs = [rules[i].glob() for i in ranked]

    def make():
        machine = ShiftAnd(globs)

        def judge(batch: pa.RecordBatch) -> list[pa.Array]:
            names = batch.schema.names
            (hosts, h), (paths, p) = (utf8(batch.column(names.index(c))) for c in ("host", "path"))
            hn, pn = np.diff(h), np.diff(p)
            offsets = np.zeros(batch.num_rows + 1, np.int64)
            np.cumsum(hn + pn + 3, out=offsets[1:])
            data = np.empty(int(offsets[-1]), np.uint8)
            data[offsets[:-1]], data[offsets[:-1] + 1], data[offsets[:-1] + 2 + hn] = _EDGE, ord("."), _SEP
            data[np.repeat(offsets[:-1] + 2 - h[:-1], hn) + np.arange(h[-1])] = hosts
            data[np.repeat(offsets[:-1] + 3 + hn - p[:-1], pn) + np.arange(p[-1])] = paths
            hit = machine.run(data, offsets)
            best = np.where(hit.any(1), hit.argmax(1), -1) if len(texts) else np.full(batch.num_rows, -1)
            return [
                pa.array([texts[i] if 0 <= i < given else None for i in best], pa.string()),
                pa.array([verdicts[i] if i >= 0 else default for i in best], pa.string()),
                pa.array([texts[i] if i >= given else None for i in best], pa.string()),
            ]

        return judge

    fields = [T.StructField(n, T.StringType()) for n in ("rule", "verdict", "own_glob")]
    # the masks of all rows of a block are in memory together
    size = max(1 << 12, (1 << 20) // ShiftAnd(globs).words)
    return add_columns(framed, fields, make, weigh=bytes_, block_bytes=size).drop(bytes_)
