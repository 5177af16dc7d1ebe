"""Language identification with a bidirectional gated recurrent network over bytes.

The network is trained in numpy by backpropagation through time on a bounded sample of labelled
texts. It labels every byte position of a text; the document's probabilities are their mean.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewatch.llm.common import id_share, map_batches, rows_out
from scorewatch.operators.sampling import first_per_class

FOLDS, HELD_FOLD = 4, 2
HIDDEN = 8
#: Labelled texts of each language and windows of each text that the training sees.
SAMPLE_DOCS, WINDOWS, WINDOW_BYTES = 1500, 4, 96
STEPS, BATCH, RATE = 200, 96, 0.02
#: Bytes that the network reads in one go; a longer text is read in consecutive windows.
SPAN = 128
#: Windows that are read side by side.
SIDE_BY_SIDE = 2048
UNKNOWN = "und"

SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"
_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())]
)


@dataclass
class Network:
    """Weights of both directions: byte table, recurrent weights and bias, and the output layer.

    Index 0 reads forwards, 1 backwards. The last axis of the first three holds the update gate, the
    reset gate and the candidate. Gates are piecewise linear: a quarter of the input plus a half, cut to
    0 and 1.
    """

    table: np.ndarray  # (2, 256, 3 H)
    recurrent: np.ndarray  # (2, H, 3 H)
    bias: np.ndarray  # (2, 1, H): added to the recurrent part of the candidate
    out: np.ndarray  # (2, H, K)
    out_bias: np.ndarray  # (K,)

    @staticmethod
    def initial(classes: int, hidden: int, rng: np.random.Generator) -> Network:
        draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        return Network(
            draw(2, 256, 3 * hidden, scale=0.5),
            draw(2, hidden, 3 * hidden, scale=hidden**-0.5),
            np.zeros((2, 1, hidden), np.float32),
            draw(2, hidden, classes, scale=hidden**-0.5),
            np.zeros(classes, np.float32),
        )

    def parameters(self) -> list[np.ndarray]:
        return [self.table, self.recurrent, self.bias, self.out, self.out_bias]

    def states(self, data: np.ndarray, keep: list | None = None) -> np.ndarray:
        """Hidden states (2, T, B, H) of byte windows (T, B); ``keep`` receives what training needs."""
        steps, side = data.shape
        hidden = self.recurrent.shape[1]
        h = np.zeros((2, side, hidden), np.float32)
        every = np.empty((2, steps, side, hidden), np.float32)
        for t in range(steps):
            given = np.stack([self.table[0][data[t]], self.table[1][data[steps - 1 - t]]])
            from_state = h @ self.recurrent
            gates = given[..., : 2 * hidden] + from_state[..., : 2 * hidden]
            gates = np.clip(0.25 * gates + 0.5, 0.0, 1.0)
            update, reset = gates[..., :hidden], gates[..., hidden:]
            inner = from_state[..., 2 * hidden :] + self.bias
            candidate = np.tanh(given[..., 2 * hidden :] + reset * inner)
            if keep is not None:
                keep.append((h, update, reset, inner, candidate))
            h = h + update * (candidate - h)
            every[0, t], every[1, steps - 1 - t] = h
        return every

    def probabilities(self, data: np.ndarray) -> np.ndarray:
        """Class probabilities (K, T, B) of every position of byte windows (T, B).

        The same as ``states`` with the windows as the last axis and buffers that are used again.
        """
        steps, side = data.shape
        hidden = self.recurrent.shape[1]
        two = 2 * hidden
        scale = np.ones(3 * hidden, np.float32)
        scale[:two] = 0.25
        shift = np.where(scale < 1.0, np.float32(0.5), np.float32(0.0))
        tables = [np.ascontiguousarray((self.table[k] * scale + shift).T) for k in range(2)]
        recurrent = np.ascontiguousarray((self.recurrent * scale).transpose(0, 2, 1))
        bias = np.ascontiguousarray(self.bias.transpose(0, 2, 1))
        logits = np.zeros((len(self.out_bias), steps, side), np.float32)
        for k in range(2):
            h = np.zeros((hidden, side), np.float32)
            every = np.empty((hidden, steps, side), np.float32)
            given, state = np.empty((3 * hidden, side), np.float32), np.empty((3 * hidden, side), np.float32)
            gates, candidate = state[:two], state[two:]
            for t in range(steps) if k == 0 else range(steps - 1, -1, -1):
                np.take(tables[k], data[t], axis=1, out=given, mode="clip")
                np.matmul(recurrent[k], h, out=state)
                gates += given[:two]
                np.clip(gates, 0.0, 1.0, out=gates)
                candidate += bias[k]
                candidate *= gates[hidden:]
                candidate += given[two:]
                np.tanh(candidate, out=candidate)
                candidate -= h
                candidate *= gates[:hidden]
                h += candidate
                every[:, t] = h
            logits += (self.out[k].T @ every.reshape(hidden, -1)).reshape(logits.shape)
        logits += self.out_bias[:, None, None]
        logits -= logits.max(0)
        np.exp(logits, out=logits)
        logits /= logits.sum(0)
        return logits

    def gradients(self, data: np.ndarray, used: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        """Gradients of the mean cross entropy over the used positions, by backpropagation through time."""
        steps, side = data.shape
        hidden = self.recurrent.shape[1]
        keep: list = []
        every = self.states(data, keep)
        logits = every[0] @ self.out[0] + every[1] @ self.out[1] + self.out_bias
        logits -= logits.max(-1, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(-1, keepdims=True)
        p[:, np.arange(side), labels] -= 1.0
        d_logits = p * (used / max(used.sum(), 1.0))[..., None].astype(np.float32)
        d_out = np.stack([np.einsum("tbh,tbk->hk", every[k], d_logits) for k in range(2)])
        d_every = np.stack([d_logits @ self.out[0].T, (d_logits @ self.out[1].T)[::-1]])
        d_table, d_recurrent = np.zeros_like(self.table), np.zeros_like(self.recurrent)
        d_bias = np.zeros_like(self.bias)
        d_h = np.zeros((2, side, hidden), np.float32)
        for t in range(steps - 1, -1, -1):
            before, update, reset, inner, candidate = keep[t]
            d_h = d_h + d_every[:, t]
            d_candidate = d_h * update * (1.0 - candidate**2)
            d_update = d_h * (candidate - before) * 0.25 * (update > 0.0) * (update < 1.0)
            d_reset = d_candidate * inner * 0.25 * (reset > 0.0) * (reset < 1.0)
            d_inner = d_candidate * reset
            d_state = np.concatenate([d_update, d_reset, d_inner], -1)
            d_given = np.concatenate([d_update, d_reset, d_candidate], -1)
            np.add.at(d_table[0], data[t], d_given[0])
            np.add.at(d_table[1], data[steps - 1 - t], d_given[1])
            d_recurrent += before.transpose(0, 2, 1) @ d_state
            d_bias += d_inner.sum(1, keepdims=True)
            d_h = d_h * (1.0 - update) + d_state @ self.recurrent.transpose(0, 2, 1)
        return [d_table, d_recurrent, d_bias, d_out, d_logits.sum((0, 1))]


def train(windows: list[bytes], labels: np.ndarray, classes: int, seed: int = 11, steps: int = STEPS) -> Network:
    """Fit a network by Adam on byte windows; classes are drawn equally often."""
    rng = np.random.default_rng(seed)
    network = Network.initial(classes, HIDDEN, rng)
    data = np.zeros((WINDOW_BYTES, len(windows)), np.uint8)
    used = np.zeros(data.shape, bool)
    for k, window in enumerate(windows):
        data[: len(window), k] = np.frombuffer(window, np.uint8)
        used[: len(window), k] = True
    groups = [np.flatnonzero(labels == c) for c in range(classes)]
    means = [np.zeros_like(p) for p in network.parameters()]
    squares = [np.zeros_like(p) for p in network.parameters()]
    for step in range(1, steps + 1):
        pick = np.concatenate([rng.choice(g, BATCH // classes + 1) for g in groups])
        found = network.gradients(data[:, pick], used[:, pick], labels[pick])
        norm = np.sqrt(sum(float((g * g).sum()) for g in found))
        rate = RATE * (1.0 - 0.9 * step / steps)
        for p, g, m, s in zip(network.parameters(), found, means, squares, strict=True):
            g = g * min(1.0, 1.0 / max(norm, 1e-9))
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            p -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return network


def labelled_sample(docs: DataFrame, per_language: int = SAMPLE_DOCS) -> DataFrame:
    """(lang, text) of labelled texts outside the held-out fold, at most ``per_language`` different ones of each language.

    A language's texts are taken by the hash of id and text, first among parts of them, then of what is left, so
    every language that occurs is in the sample and none is sorted by one task. A text that an id repeats counts
    once, however many rows hold it.
    """
    of_fold = id_share(F.col("doc_id"), FOLDS) != HELD_FOLD
    labelled = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & of_fold).select(
        "lang", F.hex(F.xxhash64(F.lit(5), "doc_id", "text")).alias("mark"), "text"
    )
    marks = labelled.select("lang", "mark").distinct()
    chosen = first_per_class(marks, "lang", "mark", per_language)
    found = labelled.join(F.broadcast(chosen), ["lang", "mark"], "left_semi")
    return found.groupBy("lang", "mark").agg(F.first("text").alias("text")).select("lang", "text")


def sample_windows(docs: DataFrame) -> DataFrame:
    """Byte windows, spread over the whole text, of a bounded number of labelled texts of each language."""

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs, parts = [], []
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            data = text.encode()
            room = max(len(data) - WINDOW_BYTES, 0)
            for at in sorted({room * k // max(WINDOWS - 1, 1) for k in range(WINDOWS)}):
                langs.append(lang)
                parts.append(data[at : at + WINDOW_BYTES])
        names = ["lang", "part"]
        return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(parts, pa.binary())], names=names)

    return map_batches(labelled_sample(docs), cut, "lang string, part binary")


def learn(docs: DataFrame) -> tuple[Network, list[str]] | None:
    """Network and its languages; None without labelled text."""
    rows = sorted((r["lang"], bytes(r["part"])) for r in sample_windows(docs).collect() if len(r["part"]))
    if not rows:
        return None
    names = sorted({lang for lang, _ in rows})
    labels = np.array([names.index(lang) for lang, _ in rows])
    return train([part for _, part in rows], labels, len(names)), names


def document_probabilities(network: Network, texts: list[bytes], classes: int) -> np.ndarray:
    """Mean class probabilities over all byte positions of each text; every text needs a byte."""
    sizes = np.array([len(t) for t in texts], np.int64)
    rows = -(-sizes // SPAN)
    padded = np.zeros(int(rows.sum()) * SPAN, np.uint8)
    starts = (np.cumsum(rows) - rows) * SPAN
    for start, text in zip(starts.tolist(), texts, strict=True):
        padded[start : start + len(text)] = np.frombuffer(text, np.uint8)
    windows = padded.reshape(-1, SPAN)
    filled = np.full(len(windows), SPAN)
    filled[np.cumsum(rows) - 1] = sizes - (rows - 1) * SPAN
    sums = np.empty((len(windows), classes))
    order = np.argsort(filled, kind="stable")
    for k in range(0, len(windows), SIDE_BY_SIDE):
        part = order[k : k + SIDE_BY_SIDE]
        longest = int(filled[part].max())
        found = network.probabilities(np.ascontiguousarray(windows[part, :longest].T))
        found *= np.arange(longest)[:, None] < filled[part]
        sums[part] = found.sum(1).T
    return np.add.reduceat(sums, np.cumsum(rows) - rows, axis=0) / sizes[:, None]


def identify(docs: DataFrame) -> DataFrame:
    """Predicted language and its probability for every document.

    ``docs`` needs ``doc_id``, ``text`` and ``lang``; other columns are ignored. ``lang`` is read only
    from the rows outside the held-out fold, to learn; predictions use the text alone. NULL texts and
    texts without a letter give ``und`` with score 0, as do all texts when nothing is labelled.
    Repeated rows and NULL ids are judged row by row; an empty table gives no rows. Long texts are
    read whole, in consecutive windows.
    """
    model = learn(docs)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").to_pylist()
        named, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        some = [k for k, t in enumerate(texts) if t and any(map(str.isalpha, t))] if model else []
        if some:
            network, names = model
            found = document_probabilities(network, [texts[k].encode() for k in some], len(names))
            for k, p in zip(some, found, strict=True):
                named[k], scores[k] = names[int(p.argmax())], min(float(p.max()), 1.0)
        return rows_out(_ARROW, (batch.column("doc_id").to_pylist(), batch.column("held").to_pylist(), named, scores))

    held = (id_share(F.col("doc_id"), FOLDS) == HELD_FOLD).alias("held")
    return map_batches(docs.select("doc_id", held, "text"), work, SCHEMA, piecewise=True)
