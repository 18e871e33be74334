"""Encoding and decoding with a public SentencePiece BPE model by suffix-array matching.

Texts are cut where no piece can reach across (before a space that follows another character, and around ASCII
characters that stand in no longer piece). All segments of a batch of texts are concatenated and indexed by a
suffix array; every piece is binary-searched in it, and each occurrence is an edge from its first to its past-the-end
position. Edges are sorted by their ends and relaxed position by position, for all segments side by side: the last
token up to a position is the one piece ending there that BPE would leave next to the last token before it. Two tokens
stay side by side if merging their joint text never merges across their border; as merges are local, a sequence of
tokens is the BPE encoding of its text exactly if this holds for all neighbours.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from receiptflow.llm.shared import add_columns
from receiptflow.llm.words import Words, mix, utf8

_U = np.uint64
_SPACE = "▁"
#: Bytes of suffixes that are sorted at once; ties are sorted by the next so many, up to the longest piece.
_SORTED = 16
#: Bytes of a batch, which is matched at once.
_PORTION = 1 << 18
#: A segment of more bytes is matched in stretches of about so many, side by side, each going on over some of the next one.
_LONG, _OVERLAP = 1 << 12, 1 << 9
_LONG_PORTION = 1 << 18


def merge_steps(text: str, ids: dict[str, int], scores: list[float]) -> tuple[list[str], list[tuple[float, str, str]]]:
    """BPE of a short text, best score first and leftmost among equals: the symbols at the end, and each merge's score
    with the first and last symbol after it."""
    symbols = list(text)
    steps = []
    while True:
        best = None
        for i in range(len(symbols) - 1):
            k = ids.get(symbols[i] + symbols[i + 1])
            if k is not None and (best is None or scores[k] > best[0]):
                best = scores[k], i
        if best is None:
            return symbols, steps
        i = best[1]
        symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
        steps.append((best[0], symbols[0], symbols[-1]))


@dataclass
class PieceModel:
    """The pieces of a model, with the space as they spell it replaced by a plain one. Small: a row for each piece."""

    pieces: list[str]
    scores: list[float]
    bytes_: list[int]  # ids of the 256 byte pieces
    unknown: int
    silent: set[int]  # control pieces
    ids: dict[str, int] = field(init=False)

    def __post_init__(self):
        skip = {*self.bytes_, self.unknown, *self.silent}
        self.ids = {p: k for k, p in enumerate(self.pieces) if k not in skip}
        #: of the pieces BPE itself would make, their merges
        self.steps = {}
        for p in self.ids:
            symbols, steps = merge_steps(p, self.ids, self.scores)
            if len(symbols) == 1:
                self.steps[self.ids[p]] = steps
        longer = [p for p in self.ids if len(p) > 1]
        inside = {c for p in longer for c in p}
        if any(" " in p.lstrip(" ") for p in longer):
            raise ValueError("a piece has a space behind another character; texts cannot be cut at spaces")
        self.alone = np.array([c < 128 and c != 32 and chr(c) not in inside for c in range(256)])

    @classmethod
    def load(cls, path: str) -> PieceModel:
        """From a ``.model`` file: BPE with byte fallback, no normalisation, a space put before each text."""
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        rules = proto.normalizer_spec
        fits = (
            proto.trainer_spec.model_type == 2
            and proto.trainer_spec.byte_fallback
            and not rules.precompiled_charsmap
            and rules.add_dummy_prefix
            and not rules.remove_extra_whitespaces
            and rules.escape_whitespaces
        )
        sp = SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        kinds = [p.type for p in proto.pieces]
        if not fits or any(k in (4, 5) for k in kinds):
            raise ValueError("only BPE models with byte fallback, a dummy prefix and no normalisation or own symbols are read")
        return cls(
            [sp.id_to_piece(k).replace(_SPACE, " ") for k in range(n)],
            [sp.get_score(k) for k in range(n)],
            [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)],
            sp.unk_id(),
            {k for k in range(n) if sp.is_control(k)},
        )

    def stays(self, left: int, right: int) -> bool:
        """Whether BPE of the two pieces' joint text ends in just these two."""
        a, b = self.steps[left], self.steps[right]
        x, y = self.pieces[left][-1], self.pieces[right][0]
        i = j = 0
        none = float("-inf")
        while True:
            k = self.ids.get(x + y)
            across = self.scores[k] if k is not None else none
            own, other = a[i][0] if i < len(a) else none, b[j][0] if j < len(b) else none
            if across > own and across >= other:
                return False
            if own == none and other == none:
                return True
            if own >= other:
                x = a[i][2]
                i += 1
            else:
                y = b[j][1]
                j += 1


class Encoder:
    """Encodes blocks of texts; remembers which pieces stay side by side."""

    def __init__(self, model: PieceModel):
        self.model = model
        usable = sorted((k for k in model.steps if len(model.pieces[k]) > 1), key=lambda k: model.pieces[k].encode())
        raw = [model.pieces[k].encode() for k in usable]
        self.piece_ids = np.array(usable, np.int64)
        self.piece_size = np.array([len(x) for x in raw])
        #: suffixes are put in the order of so many first bytes, which is all that a search for pieces asks for
        self.depth = -(-max((len(x) for x in raw), default=1) // _SORTED) * _SORTED
        self.low = np.array(raw, f"S{self.depth}")
        self.high = np.array([x.ljust(self.depth, b"\xff") for x in raw], f"S{self.depth}")
        self.single = {p: k for p, k in model.ids.items() if len(p) == 1}
        self.count = len(model.pieces)
        wide = sorted((int.from_bytes(p.encode().ljust(4, b"\0")), k) for p, k in self.single.items() if not p.isascii())
        self.wide = np.array([c for c, _ in wide], np.int64)
        self.wide_ids = np.array([k for _, k in wide], np.int64)
        self.by_byte = np.array([self.single.get(chr(b), -1) if b < 128 else -1 for b in range(256)])
        # pairs of pieces by the hash of the pair, and whether they stay side by side; a later pair takes the slot
        self.pairs = np.full(1 << 21, -1, np.int64)
        self.stay = np.zeros(1 << 21, bool)
        self.byte_ids = np.array(model.bytes_)
        self.stretches: dict[bytes, np.ndarray] = {}
        self.sizes = np.array([len(p.encode()) for p in model.pieces], np.int64)  # of tokens in bytes of the text
        self.sizes[self.byte_ids] = 1
        self.whole = np.ones(len(model.pieces), bool)  # tokens that are pieces, not bytes of a character without one
        self.whole[self.byte_ids] = False

    def encode(self, column: pa.Array) -> pa.Array:
        """A list of ids for each text; null is empty."""
        text = pc.fill_null(pc.replace_substring(column.cast(pa.string()), _SPACE, " "), "")
        full = pc.greater(pc.binary_length(text), 0)
        text = pc.if_else(full, pc.binary_join_element_wise(pa.scalar(" "), text, pa.scalar("")), text)
        segments = self._segments(text)
        flat, counts = np.zeros(0, np.int32), np.zeros(len(text), np.int64)
        if len(segments.starts):
            flat, size = self._tokens(segments)
            counts = np.diff(np.concatenate([[0], np.cumsum(size)])[segments.rows])
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))

    def _segments(self, text: pa.Array) -> Words:
        data, offsets = utf8(text)
        cut = np.zeros(len(data) + 1, bool)
        space = data == 32
        cut[1:-1] = space[1:] & ~space[:-1]
        alone = self.model.alone[data]
        cut[:-1] |= alone
        cut[1:] |= alone
        cut[offsets] = True
        edges = np.flatnonzero(cut)
        return Words(data, edges[:-1], edges[1:], np.searchsorted(edges, offsets))

    def _tokens(self, segments: Words) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of all segments, and how many each has."""
        a, b = segments.starts, segments.ends
        parts, i = [], 0
        for j in [*np.flatnonzero(b - a > _LONG).tolist(), len(a)]:
            parts += self._in_portions(segments.data, a[i:j], b[i:j], _PORTION)
            if j < len(a):
                tokens = self._match_long(segments.data, int(a[j]), int(b[j]))
                parts.append((tokens, np.array([len(tokens)])))
            i = j + 1
        return np.concatenate([t for t, _ in parts]), np.concatenate([n for _, n in parts])

    def _in_portions(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, most: int) -> list[tuple[np.ndarray, np.ndarray]]:
        cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(ends - starts) // most)) + 1).tolist(), len(starts)]
        return [self._match(data, starts[i:j], ends[i:j]) for i, j in zip(cuts[:-1], cuts[1:], strict=True) if j > i]

    def _match_long(self, data: np.ndarray, start: int, end: int) -> np.ndarray:
        """The tokens of a long segment from those of its stretches.

        Every stretch is encoded as if it stood alone. In what two of them share there is nearly always a place where both
        have a border between tokens and the one before it stays beside the one behind it: there the first is left for the
        second. All neighbours stay beside each other then, which makes the whole the encoding of the segment. Where
        there is no such place (a run of one letter, out of step), the next stretch is matched again from a border of the
        first on.
        """
        firsts = np.arange(start, end, _LONG)
        while (inside := (data[firsts] & 0xC0) == 0x80).any():  # not inside a character
            firsts[inside] -= 1
        lasts = np.minimum(firsts + _LONG + _OVERLAP, end)
        while (inside := (lasts < end) & ((data[np.minimum(lasts, end - 1)] & 0xC0) == 0x80)).any():
            lasts[inside] -= 1
        parts = self._in_portions(data, firsts, lasts, _LONG_PORTION)
        tokens = np.split(np.concatenate([t for t, _ in parts]), np.cumsum(np.concatenate([n for _, n in parts]))[:-1])
        out, behind, took = [], tokens[0], int(firsts[0])  # tokens from ``took`` on that may still change
        for k in range(1, len(firsts)):
            met = self._border(behind, took, tokens[k], int(firsts[k]))
            if met is None:
                met = self._again(data, behind, took, int(lasts[k]))
                if met is None:
                    return self._match(data, np.array([start]), np.array([end]))[0]
                out.append(behind[: met[0]])
                took, behind = met[1:]
                continue
            i, j = met
            out.append(behind[:i])
            behind, took = tokens[k][j:], int(firsts[k]) + int(self.sizes[tokens[k][:j]].sum())
        return np.concatenate([*out, behind])

    def _again(self, data: np.ndarray, left: np.ndarray, at: int, end: int) -> tuple[int, int, np.ndarray] | None:
        """How many tokens to take of the left stretch, where the next one begins, and its tokens up to ``end``."""
        ends = at + np.cumsum(self.sizes[left])
        for k in np.argsort(np.abs(ends[:-1] - (ends[-1] - _OVERLAP // 2)), kind="stable")[:16].tolist():
            text = data[ends[k] : end].tobytes()
            if text not in self.stretches:  # texts that need this repeat themselves
                if len(self.stretches) >= 256:
                    self.stretches.clear()
                self.stretches[text] = self._match(data, ends[k : k + 1], np.array([end]))[0]
            fit = self.stretches[text]
            if self._stay(left[k], fit[0]):
                return k + 1, int(ends[k]), fit
        return None

    def _stay(self, left: int, right: int) -> bool:
        return bool(self.whole[left] and self.whole[right] and self._fits(np.array([left], np.int64), np.array([right], np.int64))[0])

    def _border(self, left: np.ndarray, at: int, right: np.ndarray, begin: int) -> tuple[int, int] | None:
        """How many tokens to take of the left stretch, from ``at`` on, and to leave out of the right one, from ``begin`` on."""
        ends = at + np.cumsum(self.sizes[left])
        starts = begin + np.concatenate([[0], np.cumsum(self.sizes[right])[:-1]])
        both, i, j = np.intersect1d(ends, starts, assume_unique=True, return_indices=True)
        # not at once at the edge of the right one, whose first tokens know nothing of what is before them
        for k in np.argsort(np.abs(both - begin - _OVERLAP // 2)).tolist():
            if i[k] + 1 < len(left) and self._stay(left[i[k]], right[j[k]]):
                return int(i[k]) + 1, int(j[k])
        return None

    def _match(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of segments, and how many each has."""
        size = ends - starts
        begin = np.concatenate([[0], np.cumsum(size + 1)])  # a byte that no text holds stands behind each segment
        text = np.full(begin[-1] + self.depth, 0xFF, np.uint8)
        text[np.repeat(begin[:-1] - np.concatenate([[0], np.cumsum(size)])[:-1], size) + np.arange(size.sum())] = data[
            np.repeat(starts - np.concatenate([[0], np.cumsum(size)])[:-1], size) + np.arange(size.sum())
        ]
        tail, head, piece = self._edges(text, int(begin[-1]))
        depth = tail - np.repeat(begin[:-1], size + 1)[head]
        if len(depth) and depth.max() < 1 << 16:
            depth = depth.astype(np.uint16)  # numpy sorts these by radix
        order = np.argsort(depth, kind="stable")
        tail, head, piece, depth = tail[order], head[order], piece[order], depth[order]
        last = np.full(begin[-1] + 1, -1, np.int64)
        back = np.zeros(begin[-1] + 1, np.int64)
        last[begin[:-1]] = -2  # a segment's beginning fits everything
        cuts = np.flatnonzero(np.diff(depth.astype(np.int64), prepend=-1, append=-1))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            fit = self._fits(last[head[a:b]], piece[a:b])
            to = tail[a:b][fit]
            last[to] = piece[a:b][fit]
            back[to] = head[a:b][fit]
        return self._traced(text, last, back, begin, ends - starts)

    def _edges(self, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(end, start, piece) of all occurrences of pieces; single characters come as their piece, or ``count`` if none."""
        at = np.flatnonzero((text[:n] < 0x80) | ((text[:n] >= 0xC0) & (text[:n] < 0xFF)))  # first bytes of characters
        width = np.ones(len(at), np.int64)
        lead = text[at]
        width += (lead >= 0xC0).astype(int) + (lead >= 0xE0) + (lead >= 0xF0)
        chars = self.by_byte[lead]
        wide = np.flatnonzero(lead >= 0xC0)
        code = np.zeros(len(wide), np.int64)
        for k in range(4):  # a character's bytes as one number
            code = code << 8 | np.where(k < width[wide], text[at[wide] + np.minimum(k, width[wide] - 1)], 0)
        spot = np.minimum(np.searchsorted(self.wide, code), max(len(self.wide) - 1, 0))
        chars[wide] = np.where(self.wide[spot] == code, self.wide_ids[spot], -1) if len(self.wide) else -1
        chars[chars < 0] = self.count
        # the suffix array: character positions in the order of the bytes that follow them
        suffixes = self._suffixes(text, at)
        whole = np.lib.stride_tricks.as_strided(text, (n, self.depth), (1, 1))
        ordered = np.ascontiguousarray(whole[at[suffixes]]).view(f"S{self.depth}").ravel()
        low = np.searchsorted(ordered, self.low, side="left")
        high = np.searchsorted(ordered, self.high, side="right")
        counts = high - low
        total = np.concatenate([[0], np.cumsum(counts)])
        head = at[suffixes[np.repeat(low - total[:-1], counts) + np.arange(total[-1])]]
        which = np.repeat(np.arange(len(counts)), counts)
        tail = np.concatenate([head + self.piece_size[which], at + width])
        return tail, np.concatenate([head, at]), np.concatenate([self.piece_ids[which], chars])

    def _suffixes(self, text: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The order of the suffixes at ``at`` by their first ``depth`` bytes: sorted by some, then ties by the next."""
        order, tied = np.arange(len(at)), np.zeros(len(at), np.int64)  # suffixes of equal numbers are tied
        todo = np.arange(len(at))
        for k in range(0, self.depth, _SORTED):
            here = at[order[todo]] + k
            pair = [np.ndarray((len(text) - 7,), ">u8", text, strides=(1,))[here + 8 * j].astype(np.uint64) for j in (0, 1)]
            turn = np.lexsort((pair[1], pair[0], tied[todo]))
            order[todo] = order[todo][turn]
            pair = [x[turn] for x in pair]
            differs = np.ones(len(todo), bool)
            differs[1:] = (tied[todo][1:] != tied[todo][:-1]) | (pair[0][1:] != pair[0][:-1]) | (pair[1][1:] != pair[1][:-1])
            tied[todo] = todo[np.maximum.accumulate(np.where(differs, np.arange(len(todo)), 0))]
            alone = differs & np.append(differs[1:], True)
            # what follows the end of a segment does not matter
            todo = todo[~alone]
            if not len(todo):
                break
        return order

    def _fits(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether each right piece stays behind the last token before it; ``count`` and -2 fit everything."""
        fit = (left == -2) | (left == self.count) | ((right == self.count) & (left >= 0))
        ask = np.flatnonzero(~fit & (left >= 0))
        pair = left[ask] * self.count + right[ask]
        slot = (mix(pair.astype(_U)) & _U(len(self.pairs) - 1)).astype(np.int64)
        known = self.pairs[slot] == pair
        fit[ask[known]] = self.stay[slot[known]]
        if not known.all():
            new, first, of = np.unique(pair[~known], return_index=True, return_inverse=True)
            stays = np.array([self.model.stays(x // self.count, x % self.count) for x in new.tolist()], bool)
            fit[ask[~known]] = stays[of]
            at = slot[~known][first]
            self.pairs[at], self.stay[at] = new, stays
        return fit

    def _traced(self, text, last, back, begin, size) -> tuple[np.ndarray, np.ndarray]:
        """Tokens from each segment's end back to its beginning, in order; characters without a piece as their bytes."""
        at, own = begin[:-1] + size, np.arange(len(size))
        owners, tokens, places, widths = [], [], [], []
        while len(own):
            before = back[at]
            owners.append(own)
            tokens.append(last[at])
            places.append(before)
            widths.append(at - before)
            left = before > begin[own]
            at, own = before[left], own[left]
        owner, token, place, width = (np.concatenate(x) for x in (owners, tokens, places, widths))
        spelled = token == self.count
        repeat = np.where(spelled, width, 1)
        order = np.argsort(place, kind="stable")
        owner, token, place, spelled, repeat = (x[order] for x in (owner, token, place, spelled, repeat))
        out = np.repeat(token, repeat)
        first = np.concatenate([[0], np.cumsum(repeat)])[:-1]
        raw = np.repeat(spelled, repeat)
        offset = np.arange(len(out)) - np.repeat(first, repeat)
        out[raw] = self.byte_ids[text[(np.repeat(place, repeat) + offset)[raw]]]
        return out.astype(np.int32), np.bincount(owner, repeat, minlength=len(size)).astype(np.int64)


class Decoder:
    """Ids back to texts: pieces are joined, a first space goes, every byte of byte pieces that are no UTF-8 becomes U+FFFD."""

    def __init__(self, model: PieceModel):
        raw = [p.encode() for p in model.pieces]
        for b, k in enumerate(model.bytes_):
            raw[k] = bytes([b])
        for k in model.silent:
            raw[k] = b""
        raw[model.unknown] = " ⁇ ".encode()
        self.size = np.array([len(x) for x in raw])
        self.begin = np.concatenate([[0], np.cumsum(self.size)])[:-1]
        self.flat = np.frombuffer(b"".join(raw), np.uint8)
        self.raw, self.unknown = raw, model.unknown
        self.is_byte = np.zeros(len(raw), bool)
        self.is_byte[model.bytes_] = True

    def decode(self, ids: pa.Array) -> list[str | None]:
        values, counts = ids.flatten().to_numpy(zero_copy_only=False), pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
        if len(values) and (values.min() < 0 or values.max() >= len(self.size)):
            raise ValueError("an id is not in the vocabulary")
        values = values.astype(np.int64)
        size = self.size[values]
        total = np.concatenate([[0], np.cumsum(size)])
        data = self.flat[np.repeat(self.begin[values] - total[:-1], size) + np.arange(total[-1])].tobytes()
        at = np.concatenate([[0], np.cumsum(counts)])
        rows = total[at]
        out: list[str | None] = []
        for r, valid in enumerate(ids.is_valid().to_pylist()):
            if not valid:
                out.append(None)
                continue
            own, spoken = values[at[r] : at[r + 1]], size[at[r] : at[r + 1]] > 0
            try:
                text = data[rows[r] : rows[r + 1]].decode()
                if not spoken.all() and self.is_byte[own].any():  # a piece without text ends a run of bytes
                    text = self._broken(own)
            except UnicodeDecodeError:
                text = self._broken(own)
            first = own[spoken.argmax()] if spoken.any() else -1
            # the space in front is that of a piece, not of a byte or of what stands for the unknown
            out.append(text.removeprefix(" ") if first >= 0 and not self.is_byte[first] and first != self.unknown else text)
        return out

    def _broken(self, ids: np.ndarray) -> str:
        """The text of ids whose bytes are not all UTF-8: runs of byte pieces are read for themselves."""
        parts: list[str] = []
        run = bytearray()
        for k in [*ids.tolist(), -1]:
            if k >= 0 and self.is_byte[k]:
                run += self.raw[k]
                continue
            if run:
                parts.append(_valid_parts(bytes(run)))
                run.clear()
            if k >= 0:
                parts.append(self.raw[k].decode())
        return "".join(parts)


def _valid_parts(data: bytes) -> str:
    """The characters of UTF-8 in ``data``, and U+FFFD for every byte that belongs to none."""
    out, at = [], 0
    while at < len(data):
        try:
            out.append(data[at:].decode())
            break
        except UnicodeDecodeError as error:
            out.append(data[at : at + error.start].decode() + "\ufffd")
            at += error.start + 1
    return "".join(out)


def encode_texts(docs: DataFrame, model_path: str, text_col: str = "text", decoded: str | None = None) -> DataFrame:
    """Each row of ``docs`` with ``ids``, as the model's own encoder gives them, and ``n_tokens``.

    With ``decoded`` a column of that name has the text that the ids give back, made in the same pass.
    The model file is read on the driver and sent to the tasks; it is a vocabulary, which does not grow with the texts.
    Null ids and no tokens for a null text, an empty list for an empty one; repeated rows are encoded alike; input columns
    named like the outputs are replaced; an empty table gives an empty one. A character that is in no piece comes as its
    bytes. Very long texts take linear time, also without a space: a segment of more than 4096 bytes is matched in
    stretches side by side (4 MB of letters take seconds and some hundred megabytes).
    """
    model = docs.sparkSession.sparkContext.broadcast(PieceModel.load(model_path))
    fields = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType())]
    fields += [T.StructField(decoded, T.StringType())] if decoded else []

    def make():
        encoder, decoder = Encoder(model.value), Decoder(model.value)

        def encode(batch: pa.RecordBatch) -> list[pa.Array]:
            column = batch.column(batch.schema.get_field_index(text_col))
            ids = encoder.encode(column)
            counts = pc.list_value_length(ids).cast(pa.int64())
            none = pa.scalar(None, ids.type)
            ids = pc.if_else(column.is_valid(), ids, none) if column.null_count else ids
            return [ids, counts, *([pa.array(decoder.decode(ids), pa.string())] if decoded else [])]

        return encode

    return add_columns(docs, fields, make, weigh=text_col, block_bytes=_PORTION)


def decode_ids(encoded: DataFrame, model_path: str, ids_col: str = "ids", name: str = "decoded") -> DataFrame:
    """Each row of ``encoded`` with the text of its ids; null for null. Ids outside the vocabulary raise ValueError."""
    model = encoded.sparkSession.sparkContext.broadcast(PieceModel.load(model_path))

    def make():
        decoder = Decoder(model.value)

        def decode(batch: pa.RecordBatch) -> list[pa.Array]:
            return [pa.array(decoder.decode(batch.column(batch.schema.get_field_index(ids_col))), pa.string())]

        return decode

    return add_columns(encoded, [T.StructField(name, T.StringType())], make, weigh=ids_col)
