"""Language identification by a bidirectional gated recurrent network over bytes.

One recurrence reads a window of bytes forwards, one backwards; both states at
a byte give the probabilities of the languages there, and a document's
probabilities are the mean over all of its bytes. Gates and candidates use the
softsign ``x / (1 + |x|)`` in place of tanh, which needs no exponential.

The network is trained in numpy, by backpropagation through time, on the
driver. It learns every language of the training rows, from ``PER_LABEL``
documents of each, and from fewer of each beyond ``FULL_LABELS`` languages, so
that their number stays the same however large the corpus is (one of each
language at least), with an excerpt of ``EXCERPT`` characters of each. The
states and the steps of training grow with the languages beyond that number.
Prediction reads every byte of every text, on the executors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaywise.llm.common import byte_texts, map_batches, remainder, slices, table, with_fields

UNKNOWN = "und"
#: Bounds of the training rows; beyond so many languages there are fewer of each.
FULL_LABELS, PER_LABEL, EXCERPT = 32, 300, 1500
#: Training.
HIDDEN, TRAIN_BYTES, BATCH, STEPS, RATE, SEED = 8, 48, 192, 300, 0.02, 11
#: Bytes of a window in prediction, and windows that run side by side (fewer with more than FULL_LABELS languages).
WINDOW, WIDTH = 128, 2048
#: Least probability at which a filter keeps a document.
MIN_SCORE = 0.4


@dataclass
class Model:
    """``inputs``, ``states`` for each direction: reset and update gates, then candidates."""

    labels: list[str]
    inputs: list[np.ndarray]  # 2 x (256, 3 H): what a byte adds, biases included
    states: list[np.ndarray]  # 2 x (H, 3 H)
    out: np.ndarray  # (2 H, labels)
    bias: np.ndarray  # (labels,)

    def arrays(self) -> list[np.ndarray]:
        return [*self.inputs, *self.states, self.out, self.bias]


def softsign(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def new_model(labels: list[str], rng: np.random.Generator, hidden: int = HIDDEN) -> Model:
    draw = lambda *shape, s: (rng.standard_normal(shape) * s).astype("f4")
    return Model(
        labels,
        [draw(256, 3 * hidden, s=0.5) for _ in range(2)],
        [draw(hidden, 3 * hidden, s=0.5) for _ in range(2)],
        draw(2 * hidden, len(labels), s=0.5),
        np.zeros(len(labels), "f4"),
    )


def recur(inputs: np.ndarray, states: np.ndarray, data: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """All steps over ``data`` (time, batch): state before, gates' and candidates' sums, r, z, c, h."""
    n = states.shape[0]
    h = np.zeros((data.shape[1], n), "f4")
    steps = []
    for row in data:
        given, own = inputs[row], h @ states
        gates = given[:, : 2 * n] + own[:, : 2 * n]
        open_ = 0.5 + 0.5 * softsign(gates)
        r, z = open_[:, :n], open_[:, n:]
        sums = given[:, 2 * n :] + r * own[:, 2 * n :]
        c = softsign(sums)
        new = h + z * (c - h)
        steps.append((h, gates, sums, own[:, 2 * n :], r, z, c, new))
        h = new
    return steps


def back(states: np.ndarray, data: np.ndarray, steps: list, given: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of ``inputs`` and ``states`` from those of the states at each time (time, batch, H)."""
    n = states.shape[0]
    d_states = np.zeros_like(states)
    d_given = np.empty((*data.shape, 3 * n), "f4")
    d_next = np.zeros((data.shape[1], n), "f4")
    for t in range(len(steps) - 1, -1, -1):
        h, gates, sums, own, r, z, c, _ = steps[t]
        dh = given[t] + d_next
        d_sums = dh * z / np.square(1 + np.abs(sums))
        d_open = np.concatenate([d_sums * own, dh * (c - h)], axis=1)
        d_gates = 0.5 * d_open / np.square(1 + np.abs(gates))
        d_given[t, :, : 2 * n], d_given[t, :, 2 * n :] = d_gates, d_sums
        d_own = np.concatenate([d_gates, d_sums * r], axis=1)
        d_states += h.T @ d_own
        d_next = dh * (1 - z) + d_own @ states.T
    flat, at = d_given.reshape(-1, 3 * n), data.reshape(-1)
    d_inputs = np.stack([np.bincount(at, weights=flat[:, k], minlength=256) for k in range(3 * n)], axis=1)
    return d_inputs.astype("f4"), d_states


def gradients(model: Model, data: np.ndarray, target: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean loss over all positions of ``data`` (time, batch), and the gradient of each array."""
    runs = [recur(model.inputs[0], model.states[0], data), recur(model.inputs[1], model.states[1], data[::-1])]
    ahead = np.stack([s[-1] for s in runs[0]])
    behind = np.stack([s[-1] for s in runs[1]])[::-1]
    both = np.concatenate([ahead, behind], axis=2)
    p = softmax(both @ model.out + model.bias)
    columns = np.arange(data.shape[1])
    loss = float(-np.log(p[:, columns, target] + 1e-9).mean())
    p[:, columns, target] -= 1
    p /= data.size
    n = model.states[0].shape[0]
    d_both = p @ model.out.T
    d_in, d_st = zip(
        back(model.states[0], data, runs[0], d_both[..., :n]),
        back(model.states[1], data[::-1], runs[1], d_both[::-1, :, n:]),
        strict=True,
    )
    d_out = both.reshape(-1, 2 * n).T @ p.reshape(-1, p.shape[-1])
    return loss, [*d_in, *d_st, d_out, p.sum(axis=(0, 1))]


def train(rows: list[tuple[str, bytes]], steps: int | None = None, seed: int = SEED) -> Model | None:
    """A model of the labelled texts; None without any text as long as one byte.

    Steps are in proportion to the languages and states to their root, from ``FULL_LABELS`` on.
    """
    rng = np.random.default_rng(seed)
    rows = sorted((label, text) for label, text in rows if text)
    labels = sorted({label for label, _ in rows})
    if not labels:
        return None
    more = max(1.0, len(labels) / FULL_LABELS)
    steps = steps or int(STEPS * more)
    model = new_model(labels, rng, HIDDEN * int(np.ceil(np.sqrt(more))))
    texts = {
        label: np.frombuffer(b"".join(t.ljust(TRAIN_BYTES) + b"\n" for _, t in some), "u1")
        for label, some in groupby(rows, key=itemgetter(0))
    }
    arrays = model.arrays()
    first, second = ([np.zeros_like(a) for a in arrays] for _ in range(2))
    for step in range(1, steps + 1):
        target = rng.integers(0, len(labels), BATCH)
        starts = [rng.integers(0, len(texts[labels[k]]) - TRAIN_BYTES + 1) for k in target]
        data = np.stack([texts[labels[k]][s : s + TRAIN_BYTES] for k, s in zip(target, starts, strict=True)], axis=1)
        _, grads = gradients(model, data.astype("i8"), target)
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for a, g, m, v in zip(arrays, grads, first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            a -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype("f4")
    return model


class Reader:
    """Prediction with buffers that are used again; batch last, so each gate is one block."""

    def __init__(self, model: Model):
        self.model = model
        self.n = model.states[0].shape[0]
        self.inputs = [np.ascontiguousarray(x.T) for x in model.inputs]
        self.states = [np.ascontiguousarray(x.T) for x in model.states]
        self.out = np.ascontiguousarray(model.out.T)

    def _run(self, k: int, data: np.ndarray, into: np.ndarray) -> None:
        n, width = self.n, data.shape[1]
        given, own, size = (np.empty((3 * n, width), "f4") for _ in range(3))
        h = np.zeros((n, width), "f4")
        times = range(len(data)) if k == 0 else range(len(data) - 1, -1, -1)
        gates, r, z, c = given[: 2 * n], given[:n], given[n : 2 * n], own[2 * n :]
        for t in times:
            np.take(self.inputs[k], data[t], axis=1, out=given, mode="clip")
            np.matmul(self.states[k], h, out=own)
            gates += own[: 2 * n]
            np.abs(gates, out=size[: 2 * n])
            size[: 2 * n] += 1
            gates /= size[: 2 * n]
            gates += 1
            gates *= 0.5
            c *= r
            c += given[2 * n :]
            np.abs(c, out=size[2 * n :])
            size[2 * n :] += 1
            c /= size[2 * n :]
            c -= h
            c *= z
            h += c
            into[t] = h

    def positions(self, data: np.ndarray) -> np.ndarray:
        """Probabilities of the labels at every byte of ``data`` (time, batch): (time, labels, batch)."""
        both = np.empty((len(data), 2 * self.n, data.shape[1]), "f4")
        self._run(0, data, both[:, : self.n])
        self._run(1, data, both[:, self.n :])
        p = np.matmul(self.out, both)
        p += self.model.bias[:, None]
        p -= p.max(axis=1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(axis=1, keepdims=True)
        return p

    def documents(self, texts: list[bytes]) -> np.ndarray:
        """Probabilities of the labels for each text (rows sum to 1, or 0 for no bytes).

        Windows follow each other; the last ends with its text and counts only
        the bytes that the one before did not reach. A shorter text is followed
        by spaces that do not count.
        """
        sizes = np.array([len(x) for x in texts], "i8")
        held = np.maximum(sizes, WINDOW)
        data = np.frombuffer(b"".join(x if len(x) >= WINDOW else x.ljust(WINDOW) for x in texts), "u1")
        begin = np.cumsum(held) - held
        count = -(-held // WINDOW)
        doc = np.repeat(np.arange(len(texts)), count)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
        start = np.minimum(nth * WINDOW, held[doc] - WINDOW)
        total = np.zeros((len(texts), len(self.model.labels)))
        steps = np.arange(WINDOW)[:, None]
        width = max(1, int(WIDTH / max(1.0, len(self.model.labels) / FULL_LABELS)))
        for at in range(0, len(doc), width):
            part = slice(at, at + width)
            place = start[part] + steps
            p = self.positions(data[place + begin[doc[part]]])
            p *= ((place >= nth[part] * WINDOW) & (place < sizes[doc[part]]))[:, None, :]
            np.add.at(total, doc[part], p.sum(axis=0).T)
        return total / np.maximum(sizes, 1)[:, None]


def training_rows(docs: DataFrame) -> DataFrame:
    """``lang`` and ``excerpt`` of the rows to learn from, bounded as the module says.

    Ids are chosen by a hash, a language at a time; of rows with one id and
    language one excerpt is taken.
    """
    labelled = docs.select(
        F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("text")
    ).where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (remainder(F.col("doc_id"), 4) != 2))
    languages = labelled.select("lang").distinct().count()
    per_label = max(1, PER_LABEL * FULL_LABELS // max(languages, FULL_LABELS))
    order = W.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (
        labelled.select("doc_id", "lang")
        .withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= per_label)
        .select("doc_id", "lang").distinct()
    )
    rest = F.greatest(F.length("text") - EXCERPT, F.lit(0)) + 1
    excerpt = F.substring(F.col("text"), (F.pmod(F.xxhash64("doc_id"), rest) + 1).cast("int"), F.lit(EXCERPT))
    same = (F.col("doc_id").eqNullSafe(F.col("c_id"))) & (F.col("lang") == F.col("c_lang"))
    picked = F.broadcast(chosen.select(F.col("doc_id").alias("c_id"), F.col("lang").alias("c_lang")))
    return labelled.join(picked, same, "left_semi").groupBy("doc_id", "lang").agg(F.min(excerpt).alias("excerpt"))


def learn(docs: DataFrame) -> Model | None:
    """The model for ``docs``; None if it has no labelled text."""
    return train([(r.lang, r.excerpt.encode()) for r in training_rows(docs).select("lang", "excerpt").collect()])


_reader: tuple[bytes, Reader] | None = None


def reader(model: Model) -> Reader:
    """The worker's own copy, made once for each model."""
    global _reader
    key = b"".join(a.tobytes() for a in model.arrays())
    if _reader is None or _reader[0] != key:
        _reader = (key, Reader(model))
    return _reader[1]


def has_letter(text: bytes) -> bool:
    return any(map(str.isalpha, text.decode()))


def predicted(rows: DataFrame, model: Model | None) -> DataFrame:
    """Adds ``lang_pred`` and ``score`` to rows that have a ``text``; all columns are kept.

    A null text, one without a letter, and every text where nothing could be
    learned, get ``und`` with score 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = [x or b"" for x in byte_texts(batch.column("text")).to_pylist()]
            known = [k for k, x in enumerate(texts) if model and has_letter(x)]
            label = [UNKNOWN] * len(texts)
            score = [0.0] * len(texts)
            if known:
                pooled = reader(model).documents([texts[k] for k in known])
                best = pooled.argmax(axis=1)
                for i, k in enumerate(known):
                    label[k], score[k] = model.labels[best[i]], min(1.0, float(pooled[i, best[i]]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(label, pa.string()), pa.array(score, pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score"],
            )

    return map_batches(rows, run, with_fields(rows, lang_pred=T.StringType(), score=T.DoubleType()))


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of every row, by its text alone.

    Repeated rows and null ids stay as they are; an empty table gives no rows;
    columns besides ``doc_id``, ``text`` and ``lang`` are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text"))
    return predicted(rows, learn(docs)).select(
        "doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score"
    )


def keep_known(docs: DataFrame) -> DataFrame:
    """The rows whose language is recognised with ``MIN_SCORE`` at least, with all their columns."""
    held = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("text"))
    found = predicted(held, learn(docs)).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= MIN_SCORE))
    return found.select("row.*")


def op5_byte_birnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted languages of all documents."""
    return identify(table(spark, sf_dir, "documents"))
