"""Language identification by a bidirectional gated recurrent network over bytes, trained here in numpy.

Every byte of a text is a position that the network labels with language probabilities; those of all positions are
pooled into the document's. Texts are read in windows of ``CORE`` bytes, side by side in numpy. A window's state is not
empty where it begins: each direction reads the ``CONTEXT`` bytes before (behind) the window first, so that the labels
are, but for what a state still knows of bytes further away, those of one pass over the whole text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from receiptflow.llm.shared import add_columns
from receiptflow.llm.words import utf8

CORE, CONTEXT = 480, 32
#: The byte that stands where a row has no text. It empties the state.
PAD = 256
#: A-Z in lower case; all other bytes are read as they are.
LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Direction:
    """A GRU layer read in one direction. Rows of the weights are update, reset and candidate of each unit."""

    def __init__(self, hidden: int, rng: np.random.Generator):
        self.hidden = hidden
        self.input = rng.normal(0, 0.3, (3 * hidden, 257)).astype(np.float32)
        self.input[: 2 * hidden, PAD] = -60  # closed gates and an empty candidate: the state becomes zero
        self.input[2 * hidden :, PAD] = 0
        self.inner = rng.uniform(-1, 1, (3 * hidden, hidden)).astype(np.float32) / np.float32(np.sqrt(hidden))

    def weights(self) -> list[np.ndarray]:
        return [self.input, self.inner]

    def run(self, bytes_: np.ndarray) -> list[tuple]:
        """States (units x rows) after each step over ``bytes_`` (steps x rows), with what backpropagation needs."""
        h = self.hidden
        state = np.zeros((h, bytes_.shape[1]), self.input.dtype)
        out = []
        for row in bytes_:
            given = self.input[:, row]
            gates = _sigmoid(given[: 2 * h] + self.inner[: 2 * h] @ state)
            update, reset = gates[:h], gates[h:]
            candidate = np.tanh(given[2 * h :] + self.inner[2 * h :] @ (reset * state))
            new = update * state + (1 - update) * candidate
            out.append((new, state, update, reset, candidate))
            state = new
        return out

    def backward(self, bytes_: np.ndarray, tape: list[tuple], above: np.ndarray) -> list[np.ndarray]:
        """Gradients of the weights, through time; ``above`` has the gradient of each step's state."""
        h = self.hidden
        d_inner = np.zeros_like(self.inner)
        d_given = np.empty((len(tape), 3 * h, bytes_.shape[1]), self.input.dtype)
        carried = np.zeros_like(above[0])
        for t in reversed(range(len(tape))):
            _, state, update, reset, candidate = tape[t]
            d_new = above[t] + carried
            d_candidate = d_new * (1 - update) * (1 - candidate**2)
            d_update = d_new * (state - candidate) * update * (1 - update)
            d_gated = self.inner[2 * h :].T @ d_candidate
            d_reset = d_gated * state * reset * (1 - reset)
            d_gates = np.concatenate([d_update, d_reset])
            d_inner[: 2 * h] += d_gates @ state.T
            d_inner[2 * h :] += d_candidate @ (reset * state).T
            d_given[t, : 2 * h], d_given[t, 2 * h :] = d_gates, d_candidate
            carried = d_new * update + d_gated * reset + self.inner[: 2 * h].T @ d_gates
        seen = bytes_.ravel()
        d_input = np.stack([np.bincount(seen, d_given[:, j].ravel(), 257) for j in range(3 * h)]).astype(self.input.dtype)
        d_input[:, PAD] = 0
        return [d_input, d_inner]

    def states(self, bytes_: np.ndarray) -> np.ndarray:
        """The states of ``run`` (steps x units x rows), without a tape and in memory that is used again."""
        h, n = self.hidden, bytes_.shape[1]
        # signs and factors are put into the weights, so that a gate is 1 / (1 + exp(x)) and a tanh 2 / (1 + exp(x)) - 1
        factor = np.repeat(np.float32([-1, -1, -2]), h)[:, None]
        table, gate, inner = self.input * factor, self.inner[: 2 * h] * factor[: 2 * h], self.inner[2 * h :] * factor[2 * h :]
        out = np.empty((len(bytes_), h, n), np.float32)
        given, gates, part, gated = (np.empty((k * h, n), np.float32) for k in (3, 2, 1, 1))
        state = np.zeros((h, n), np.float32)
        with np.errstate(over="ignore"):
            for t, row in enumerate(bytes_):
                np.take(table, row, axis=1, out=given, mode="clip")
                np.matmul(gate, state, out=gates)
                gates += given[: 2 * h]
                np.exp(gates, out=gates)
                gates += 1
                np.reciprocal(gates, out=gates)
                np.multiply(gates[h:], state, out=gated)
                np.matmul(inner, gated, out=part)
                part += given[2 * h :]
                np.exp(part, out=part)
                part += 1
                np.divide(2, part, out=part)
                part -= 1
                new = out[t]
                np.subtract(state, part, out=new)
                new *= gates[:h]
                new += part
                state = new
        return out


class Network:
    """Two directions and a softmax over languages at every byte. ``bytes_`` are steps x rows throughout."""

    def __init__(self, languages: list[str], hidden: int = 8, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.ahead, self.back = Direction(hidden, rng), Direction(hidden, rng)
        self.out = rng.normal(0, 0.1, (len(languages), 2 * hidden)).astype(np.float32)
        self.bias = np.zeros((len(languages), 1), np.float32)

    def weights(self) -> list[np.ndarray]:
        return [*self.ahead.weights(), *self.back.weights(), self.out, self.bias]

    def probabilities(self, bytes_: np.ndarray) -> np.ndarray:
        """Language probabilities at every byte: steps x languages x rows."""
        h = self.ahead.hidden
        logits = np.matmul(self.out[:, :h], self.ahead.states(bytes_))
        logits += np.matmul(self.out[:, h:], self.back.states(bytes_[::-1])[::-1])
        logits += self.bias
        logits -= logits.max(1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(1, keepdims=True)
        return logits

    def fit(self, bytes_: np.ndarray, labels: np.ndarray, steps: int, batch: int = 256, rate: float = 0.02, seed: int = 2):
        """Adam over mini-batches of rows; every language comes equally often, and each byte has its document's."""
        rng = np.random.default_rng(seed)
        of = [np.flatnonzero(labels == k) for k in range(len(self.languages))]
        of = [x for x in of if len(x)]
        first = [np.zeros_like(w) for w in self.weights()]
        second = [np.zeros_like(w) for w in self.weights()]
        for k in range(1, steps + 1):
            pick = np.concatenate([rng.choice(x, -(-batch // len(of))) for x in of])
            for w, g, m, v in zip(self.weights(), self.gradients(bytes_[:, pick], labels[pick]), first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= rate * (1 - 0.9 * k / steps) * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)

    def gradients(self, bytes_: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross-entropy over all bytes, by backpropagation through time."""
        h = self.ahead.hidden
        tapes = self.ahead.run(bytes_), self.back.run(bytes_[::-1])
        states = np.concatenate([np.stack([x[0] for x in tapes[0]]), np.stack([x[0] for x in tapes[1]])[::-1]], 1)
        logits = self.out @ states + self.bias
        p = np.exp(logits - logits.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[:, labels, np.arange(len(labels))] -= 1
        inside = bytes_ != PAD
        p *= inside[:, None] / p.dtype.type(inside.sum())
        d_out = np.einsum("tln,tun->lu", p, states, optimize=True)
        d_states = self.out.T @ p
        grads = self.ahead.backward(bytes_, tapes[0], d_states[:, :h])
        grads += self.back.backward(bytes_[::-1], tapes[1], d_states[::-1, h:])
        return [*grads, d_out, p.sum((0, 2))[:, None]]


def windows(offsets: np.ndarray, core: int = CORE, context: int = CONTEXT) -> tuple[np.ndarray, ...]:
    """The windows of texts that lie at ``offsets``: text, first byte read, past the last read, first and past of the core."""
    size = np.diff(offsets)
    count = -(-size // core)
    text = np.repeat(np.arange(len(size)), count)
    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    first = offsets[text] + nth * core
    past = np.minimum(first + core, offsets[text + 1])
    return text, np.maximum(first - context, offsets[text]), np.minimum(past + context, offsets[text + 1]), first, past


def laid_out(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Stretches of ``data`` as columns from their first byte on, padded at the end."""
    at = begin[None, :] + np.arange(int((end - begin).max()))[:, None]
    return np.where(at < end[None, :], data[np.minimum(at, len(data) - 1)].astype(np.int16), np.int16(PAD))


def pooled(network: Network, data: np.ndarray, offsets: np.ndarray, rows: int | None = None) -> np.ndarray:
    """Probabilities of each text summed over its bytes: texts x languages; ``rows`` windows side by side."""
    rows = rows or max(64, 4096 // max(4, len(network.languages)))
    text, begin, end, first, past = windows(offsets)
    out = np.zeros((len(offsets) - 1, len(network.languages)))
    order = np.argsort(end - begin, kind="stable")
    for part in np.split(order, range(rows, len(order), rows)):
        if len(part):
            p = network.probabilities(laid_out(data, begin[part], end[part]))
            step = np.arange(len(p))[:, None]
            own = (step >= first[part] - begin[part]) & (step < past[part] - begin[part])
            np.add.at(out, text[part], np.einsum("tln,tn->nl", p, own.astype(np.float32)))
    return out


def sample_labelled(docs: DataFrame, text_col: str, lang_col: str, per_language: int, language_chars: int) -> pa.Table:
    """About ``per_language`` different texts of every label, or all it has, picked by hash, each whole.

    Of these, rows are taken in the order of their hashes while they have ``language_chars`` characters together, one at
    least (the shortest, should all be longer), so that what comes to the driver has a bound for each label.
    """
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.filter("lang IS NOT NULL AND text IS NOT NULL AND length(text) > 0")
    rows = rows.withColumn("h", F.xxhash64("text"))
    counts = rows.select("lang", "h").distinct().groupBy("lang").count()
    # a row for each label, of each of which the network, which is broadcast anyway, holds more
    rows = rows.join(F.broadcast(counts), "lang")
    share = F.least(F.lit(1.0), F.lit(float(per_language)) / F.col("count"))
    picked = rows.filter(F.pmod("h", F.lit(1_000_003)) < share * 1_000_003).dropDuplicates(["lang", "h"])
    # of about ``per_language`` rows a label: those that would take most of its room by themselves come last
    large = F.length("text") > language_chars / 8
    order = Window.partitionBy("lang").orderBy(large, F.when(large, F.length("text")), "h")
    room = F.sum(F.length("text")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    taken = picked.withColumns({"room": room, "place": F.row_number().over(order)}).filter((F.col("room") <= language_chars) | (F.col("place") == 1))
    return taken.select("lang", "text", "h").orderBy("lang", "h").drop("h").toArrow()


#: Bytes of the stretches that are learned.
LEARNED = 64


def train(sample: pa.Table, hidden: int = 8, steps: int = 250, seed: int = 1) -> Network | None:
    """A network fitted on labelled texts; none if there is no label or no text."""
    sample = sample.combine_chunks()
    langs = sorted(set(sample.column("lang").to_pylist()))
    if not langs:
        return None
    data, offsets = utf8(sample.column("text").combine_chunks())
    if not len(data):
        return None
    of = np.searchsorted(np.array(langs), np.array(sample.column("lang").to_pylist()))
    network = Network(langs, hidden, seed)
    if len(langs) > 1:
        text, _, _, first, past = windows(offsets, LEARNED, 0)
        network.fit(laid_out(LOWER[data], first, past), of[text], steps + 10 * len(langs))
    return network


def identify(
    docs: DataFrame,
    learn: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = 300,
    language_chars: int = 600_000,
) -> DataFrame:
    """Each row of ``docs`` with ``lang_pred`` and ``score``, learned from the rows of ``learn`` with text and label.

    The network is trained on the driver on about ``per_language`` whole texts of every label, fewer if they have more than
    ``language_chars`` characters, whatever the size of ``learn``; copies of a text count once. Prediction reads every byte of
    every text and no column but the text. ``score`` is the mean probability of the predicted language over all bytes,
    from 0 to 1; of languages with equal probability the first in order is taken. A text that is null or without a
    letter, and every text if nothing could be learned, gets ``und`` and 0. Very long texts are read in windows, so their
    length bounds nothing but the row itself. Repeated rows are predicted alike; input columns named like the outputs
    are replaced; an empty table gives an empty one.
    """
    network = train(sample_labelled(learn, text_col, lang_col, per_language, language_chars))
    shared = docs.sparkSession.sparkContext.broadcast(network)
    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]

    def make():
        net = shared.value

        def predict(batch: pa.RecordBatch) -> list[pa.Array]:
            column = batch.column(batch.schema.get_field_index(text_col)).cast(pa.string())
            n = batch.num_rows
            if net is None:
                return [pa.array(["und"] * n, pa.string()), pa.array([0.0] * n, pa.float64())]
            data, offsets = utf8(column)
            total = pooled(net, LOWER[data], offsets)
            best = total.argmax(1)
            share = total[np.arange(n), best] / np.maximum(1, np.diff(offsets))
            known = [_has_letter(x) for x in column.to_pylist()]
            names = [net.languages[k] if ok else "und" for k, ok in zip(best, known, strict=True)]
            return [pa.array(names, pa.string()), pa.array(np.where(known, np.minimum(1.0, share), 0.0), pa.float64())]

        return predict

    return add_columns(docs, fields, make, weigh=text_col)


def _has_letter(text: str | None) -> bool:
    return text is not None and any(c.isalpha() for c in text)
