"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads windows of bytes in both directions, labels every position with a probability for
each language, and a document's probabilities are the mean over all positions of its whole text. It
is trained here, in numpy, by backpropagation through time on a bounded sample of labelled texts.

Letters A-Z are read in lower case and every run of other ASCII bytes as one space; all other bytes
are read as they are. Nothing but the text is ever an input of a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from groundsill.llm.tables import in_small_batches
from groundsill.llm.words import slices, text_bytes
from groundsill.session import materialize, ship_with_tasks

ship_with_tasks(__name__)

UNKNOWN = "und"
_READ = np.full(256, 0x20, np.uint8)
_READ[0x61:0x7B] = np.arange(0x61, 0x7B)
_READ[0x41:0x5B] = np.arange(0x61, 0x7B)
_READ[0x80:] = np.arange(0x80, 0x100)


@dataclass(frozen=True)
class Training:
    """``texts`` is the bound of the sample: so many labelled texts per language at most, of which
    ``pieces`` stretches of ``stretch`` characters each are learned from."""

    texts: int = 300
    pieces: int = 6
    stretch: int = 110
    hidden: int = 8
    window: int = 128
    epochs: int = 10
    batch: int = 256
    rate: float = 0.03
    seed: int = 5


@dataclass
class Network:
    """``inputs``: per direction a row of 3 * hidden gate inputs for each byte; ``recurrent``: per
    direction hidden x 3 * hidden; ``output``: languages x 2 * hidden; ``offset``: per language."""

    labels: list[str]
    window: int
    inputs: list[np.ndarray]
    recurrent: list[np.ndarray]
    output: np.ndarray
    offset: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [*self.inputs, *self.recurrent, self.output, self.offset]


def read(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes as the network reads them, and where each row begins."""
    seen = _READ[data]
    blank = seen == 0x20
    keep = np.ones(len(seen), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    kept = np.concatenate([[0], np.cumsum(keep)])
    return seen[keep], kept[offsets]


def windows(seen: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows cut into windows of ``length`` bytes, the last filled up with zero bytes: bytes by
    (position, window), the row of each window, and how many bytes of each window count."""
    size = np.diff(offsets)
    count = -(-size // length)
    row = np.repeat(np.arange(len(size)), count)
    within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    begin = offsets[row] + within * length
    filled = np.minimum(size[row] - within * length, length)
    at = begin[None, :] + np.arange(length)[:, None]
    inside = np.arange(length)[:, None] < filled[None, :]
    cut = np.zeros(at.shape, np.uint8)
    cut[inside] = seen[at[inside]]
    return cut, row, filled


def _states(cut: np.ndarray, inputs: np.ndarray, recurrent: np.ndarray, backward: bool) -> np.ndarray:
    """Hidden states (position, hidden, window) of one direction.

    A sigmoid is half a tanh plus a half, with the halves taken into the weights beforehand.
    """
    length, n = cut.shape
    hidden = recurrent.shape[0]
    weights, by_byte = recurrent.T.copy(), inputs.T.copy()
    weights *= 0.5
    by_byte[: 2 * hidden] *= 0.5
    out = np.empty((length, hidden, n), np.float32)
    state = np.zeros((hidden, n), np.float32)
    given, mixed = np.empty((3 * hidden, n), np.float32), np.empty((3 * hidden, n), np.float32)
    change = np.empty((hidden, n), np.float32)
    gates, new = mixed[: 2 * hidden], mixed[2 * hidden :]
    update, reset = gates[:hidden], gates[hidden:]
    for t in reversed(range(length)) if backward else range(length):
        np.take(by_byte, cut[t], axis=1, out=given, mode="clip")
        np.matmul(weights, state, out=mixed)
        gates += given[: 2 * hidden]
        np.tanh(gates, out=gates)
        gates += 1
        new *= reset
        new += given[2 * hidden :]
        np.tanh(new, out=new)
        np.subtract(new, state, out=change)
        change *= update
        change *= 0.5
        state = np.add(state, change, out=out[t])
    return out


def _remembered(cut: np.ndarray, inputs: np.ndarray, recurrent: np.ndarray, backward: bool) -> tuple[np.ndarray, list]:
    """The same states, step by step, with what backpropagation needs of each step."""
    length, n = cut.shape
    hidden = recurrent.shape[0]
    out = np.empty((length, hidden, n), np.float32)
    state, memory = np.zeros((hidden, n), np.float32), []
    for t in reversed(range(length)) if backward else range(length):
        given, mixed = inputs[cut[t]].T, recurrent.T @ state
        gates = 0.5 + 0.5 * np.tanh(0.5 * (given[: 2 * hidden] + mixed[: 2 * hidden]))
        update, reset = gates[:hidden], gates[hidden:]
        new = np.tanh(given[2 * hidden :] + mixed[2 * hidden :] * reset)
        memory.append((t, state, update, reset, mixed[2 * hidden :], new))
        out[t] = state = state + update * (new - state)
    return out, memory


def _softmax(scores: np.ndarray, axis: int) -> np.ndarray:
    scores -= scores.max(axis=axis, keepdims=True)
    np.exp(scores, out=scores)
    scores /= scores.sum(axis=axis, keepdims=True)
    return scores


def position_probabilities(net: Network, cut: np.ndarray) -> np.ndarray:
    """Probabilities (position, language, window)."""
    hidden = net.recurrent[0].shape[0]
    scores = net.output[:, :hidden] @ _states(cut, net.inputs[0], net.recurrent[0], False)
    scores += net.output[:, hidden:] @ _states(cut, net.inputs[1], net.recurrent[1], True)
    scores += net.offset[:, None]
    return _softmax(scores, 1)


def _gradients(net: Network, cut: np.ndarray, filled: np.ndarray, target: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean cross entropy over all positions, in the order of parameters()."""
    length, n = cut.shape
    hidden = net.recurrent[0].shape[0]
    runs = [_remembered(cut, net.inputs[d], net.recurrent[d], bool(d)) for d in (0, 1)]
    both = np.concatenate([states for states, _ in runs], axis=1)
    error = _softmax(net.output @ both + net.offset[:, None], 1)
    error[:, target, np.arange(n)] -= 1
    counts = np.arange(length)[:, None] < filled[None, :]
    error *= (counts / counts.sum())[:, None, :].astype(np.float32)
    output = np.einsum("tcn,thn->ch", error, both, optimize=True)
    offset = error.sum(axis=(0, 2))
    pulled = net.output.T @ error
    inputs, recurrent = [], []
    for d in (0, 1):
        weights = net.recurrent[d]
        onto_inputs = np.empty((length, n, 3 * hidden), np.float32)
        grad_rec = np.zeros_like(weights)
        carried = np.zeros((hidden, n), np.float32)
        for t, state, update, reset, mixed, new in reversed(runs[d][1]):
            carried = carried + pulled[t, d * hidden : (d + 1) * hidden]
            of_new = carried * update * (1 - new * new)
            of_update = carried * (new - state) * update * (1 - update)
            of_reset = of_new * mixed * reset * (1 - reset)
            onto_given = np.concatenate([of_update, of_reset, of_new])
            onto_mixed = np.concatenate([of_update, of_reset, of_new * reset])
            onto_inputs[t] = onto_given.T
            grad_rec += state @ onto_mixed.T
            carried = carried * (1 - update) + weights @ onto_mixed
        by_gate = onto_inputs.reshape(-1, 3 * hidden).T
        inputs.append(np.stack(
            [np.bincount(cut.ravel(), gate, 256) for gate in by_gate], 1).astype(np.float32))
        recurrent.append(grad_rec)
    return [*inputs, *recurrent, output.astype(np.float32), offset.astype(np.float32)]


def train(texts: list[str], labels: list[str], how: Training = Training()) -> Network | None:
    """A network for the given labels, or None if there are none. Languages weigh the same."""
    names = sorted(set(labels))
    if not names:
        return None
    chance = np.random.default_rng(how.seed)
    draw = lambda *shape: chance.normal(0, 1, shape).astype(np.float32)
    h = how.hidden
    net = Network(names, how.window, [0.3 * draw(256, 3 * h) for _ in (0, 1)],
                  [draw(h, 3 * h) / h**0.5 for _ in (0, 1)], 0.3 * draw(len(names), 2 * h),
                  np.zeros(len(names), np.float32))
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    cut, row, filled = windows(*read(data, offsets), how.window)
    target = np.array([names.index(x) for x in labels])[row]
    by_label = [np.flatnonzero(target == k) for k in range(len(names))]
    by_label = [x for x in by_label if len(x)]
    if not by_label:
        return net
    steps = max(1, how.epochs * sum(map(len, by_label)) // how.batch)
    each = max(1, how.batch // len(by_label))
    mean = [np.zeros_like(p) for p in net.parameters()]
    square = [np.zeros_like(p) for p in net.parameters()]
    for step in range(1, steps + 1):
        chosen = np.concatenate([chance.choice(x, each) for x in by_label])
        rate = how.rate * (1 - (step - 1) / steps)
        grads = _gradients(net, cut[:, chosen], filled[chosen], target[chosen])
        for p, g, m, s in zip(net.parameters(), grads, mean, square, strict=True):
            np.clip(g, -1, 1, out=g)
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return net


def pooled(net: Network, data: np.ndarray, offsets: np.ndarray, block: int = 2048) -> np.ndarray:
    """Mean probability of each language over all positions of each row; zeros for empty rows."""
    cut, row, filled = windows(*read(data, offsets), net.window)
    total = np.zeros((len(offsets) - 1, len(net.labels)))
    length = np.arange(net.window)[:, None]
    for a in range(0, len(row), block):
        piece, until = cut[:, a : a + block], filled[a : a + block]
        chances = position_probabilities(net, np.ascontiguousarray(piece))
        inside = (length < until[None, :]).astype(np.float32)
        np.add.at(total, row[a : a + block], np.einsum("tcn,tn->nc", chances, inside))
    return total / np.maximum(np.bincount(row, filled, len(total)), 1)[:, None]


def held_out(id_col: str = "doc_id") -> Column:
    """Documents that are never learned from; an id that is null is not one of them."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_sample(documents: DataFrame, how: Training = Training(), id_col: str = "doc_id",
                    text_col: str = "text", lang_col: str = "lang") -> list[tuple[str, str]]:
    """Stretches of labelled texts outside the held-out part: ``how.texts`` different texts per
    language, or all if there are fewer, chosen by a hash of the text, and ``how.pieces`` stretches
    at hashed places of each. Copies of a text count once."""
    order = F.xxhash64(F.lit(how.seed), "text")
    usable = documents.where(
        F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull()
        & ~held_out(id_col)).select(F.col(lang_col).cast("string").alias("lang"),
                                    F.col(text_col).alias("text")).withColumn("order", order)
    # Hashes are ranked, not texts. Stored, so that Spark knows how few are chosen and moves them.
    chosen = materialize(usable.select("lang", "order").distinct().withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy("order"))
    ).where(F.col("rank") <= how.texts))
    places = F.transform(
        F.sequence(F.lit(1), F.lit(how.pieces)),
        lambda k: F.substring(
            F.col("text"),
            (F.pmod(F.xxhash64(F.col("order"), k),
                    F.greatest(F.length("text") - how.stretch, F.lit(0)) + 1) + 1).cast("int"),
            F.lit(how.stretch)))
    ranked = usable.join(F.broadcast(chosen), ["lang", "order"]).select(
        "lang", "rank", places.alias("pieces")).distinct()
    rows = ranked.orderBy("lang", "rank").select("lang", F.explode("pieces").alias("piece")).collect()
    return [(r.piece, r.lang) for r in rows]


def _has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def predict(documents: DataFrame, net: Network | None, text_col: str = "text") -> DataFrame:
    """``documents`` with ``lang_pred`` and ``score``, the pooled probability of that language.

    A text that is null or has no letter is ``und`` with score 0, and so is every text if nothing
    was learned. Columns of those names are replaced.
    """
    base = in_small_batches(documents).drop("lang_pred", "score")
    out = base.withColumn("lang_pred", F.lit(None).cast("string")).withColumn(
        "score", F.lit(None).cast("double"))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, score = [], []
            column = batch.column(text_col)
            for row, end, data, offsets in slices(column):
                texts = column.slice(row, end - row).to_pylist()
                if net is None:
                    best += [UNKNOWN] * len(texts)
                    score += [0.0] * len(texts)
                    continue
                chances = pooled(net, data, offsets)
                for text, row_chances in zip(texts, chances, strict=True):
                    if text and _has_letter(text):
                        k = int(row_chances.argmax())
                        best.append(net.labels[k])
                        score.append(float(min(max(row_chances[k], 0.0), 1.0)))
                    else:
                        best.append(UNKNOWN)
                        score.append(0.0)
            n = batch.num_columns
            yield pa.RecordBatch.from_arrays(
                batch.columns[: n - 2] + [pa.array(best, pa.string()), pa.array(score, pa.float64())],
                batch.schema.names)

    return out.mapInArrow(label, out.schema)


def identify(documents: DataFrame, how: Training = Training(), id_col: str = "doc_id",
             text_col: str = "text", lang_col: str = "lang",
             learn_from: DataFrame | None = None) -> DataFrame:
    """Trains on ``learn_from`` (by default the documents themselves) and labels every document;
    adds ``held_out``, ``lang_pred`` and ``score``."""
    rows = training_sample(documents if learn_from is None else learn_from, how, id_col, text_col,
                           lang_col)
    net = train([t for t, _ in rows], [lang for _, lang in rows], how)
    return predict(documents.drop("held_out").withColumn("held_out", held_out(id_col)), net, text_col)
