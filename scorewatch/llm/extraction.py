"""Main text of web pages by a recurrent labeller of blocks.

A bidirectional LSTM reads the blocks of a page in order, each as a vector of its hashed tag path, its
hashed words and a few proportions, and says for every block whether it belongs to the article. It is
trained in numpy on generated page layouts, as the pages themselves carry no labels.
"""

from __future__ import annotations

import functools
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from scorewatch.llm.common import rows_out
from scorewatch.llm.html_blocks import Block, PathCodes, blocks_of
from scorewatch.llm.layouts import ARTICLE_MARK, LAYOUT_MARKS, layout

PATH_CODES, PATH_SIZE = 1024, 16
WORD_CODES, WORD_SIZE = 1024, 8
PROPORTIONS = 8
HIDDEN = 16
INPUT = PATH_SIZE + WORD_SIZE + PROPORTIONS
LAYOUTS, EPOCHS, BATCH, RATE, SEED = 2000, 5, 32, 0.01, 3
#: Pages whose blocks are read side by side.
SIDE_BY_SIDE = 256
#: Blocks, with padding, that are read together.
TOGETHER = 1 << 16

SCHEMA = "page_id long, url string, text string, n_chars long, n_blocks long, n_kept long"
_ARROW = pa.schema(
    [
        ("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64()),
        ("n_blocks", pa.int64()), ("n_kept", pa.int64()),
    ]
)

_WORD = re.compile(r"\w+")


class WordCodes(dict):
    def __missing__(self, word: str) -> int:
        code = zlib.crc32(word.lower().encode()) % WORD_CODES
        if len(self) > 200_000:
            self.clear()
        self[word] = code
        return code


_words = WordCodes()


@dataclass
class Page:
    """Blocks of a page as arrays: codes of paths and different words with the block of each, and proportions."""

    path: np.ndarray
    path_of: np.ndarray
    words: np.ndarray
    words_of: np.ndarray
    numbers: np.ndarray

    @staticmethod
    def of(blocks: list[Block]) -> Page:
        n = len(blocks)
        tokens = [_WORD.findall(b.text) for b in blocks]
        different = [{*found} for found in tokens]
        sizes = [len(t) for t in different]
        numbers = np.empty((n, PROPORTIONS), np.float32)
        for k, (b, found) in enumerate(zip(blocks, tokens, strict=True)):
            chars = len(b.text)
            numbers[k] = (
                np.log1p(len(found)) / 4, np.log1p(chars) / 6, b.link_chars / chars, b.depth / 10,
                b.text[-1] in ".!?…\"'", (b.text.count(".") + b.text.count(",")) / (len(found) + 1),
                k / n, 1.0 / (1 + n),
            )
        return Page(
            np.array([c for b in blocks for c in b.path], np.int64),
            np.repeat(np.arange(n), [len(b.path) for b in blocks]),
            np.array([_words[w] for found in different for w in found], np.int64),
            np.repeat(np.arange(n), sizes),
            numbers,
        )


def _sum_of(table: np.ndarray, codes: np.ndarray, of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the codes' vectors per block, over the root of their number."""
    counts = np.bincount(of, minlength=n)
    scale = (1.0 / np.sqrt(np.maximum(counts, 1))).astype(np.float32)
    out = np.zeros((n, table.shape[1]), np.float32)
    some = np.flatnonzero(counts)
    if len(some):
        starts = (np.cumsum(counts) - counts)[some]
        out[some] = np.add.reduceat(table[codes], starts, axis=0) * scale[some, None]
    return out, scale


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


class Labeller:
    """Embedding tables, one LSTM per direction and a logistic output."""

    def __init__(self, rng: np.random.Generator):
        draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        self.path = draw(PATH_CODES, PATH_SIZE, scale=0.3)
        self.words = draw(WORD_CODES, WORD_SIZE, scale=0.1)
        self.given = draw(2, INPUT, 4 * HIDDEN, scale=INPUT**-0.5)
        self.recurrent = draw(2, HIDDEN, 4 * HIDDEN, scale=HIDDEN**-0.5)
        self.bias = np.zeros((2, 1, 4 * HIDDEN), np.float32)
        self.bias[:, :, HIDDEN : 2 * HIDDEN] = 1.0
        self.out = draw(2 * HIDDEN + INPUT, scale=0.2)
        self.out_bias = np.zeros(1, np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.path, self.words, self.given, self.recurrent, self.bias, self.out, self.out_bias]

    def vectors(self, pages: list[Page]) -> tuple[np.ndarray, np.ndarray]:
        """Block vectors (T, B, INPUT) of pages side by side, and which of them are blocks."""
        steps = max(len(p.numbers) for p in pages)
        x = np.zeros((steps, len(pages), INPUT), np.float32)
        used = np.zeros((steps, len(pages)), bool)
        for k, p in enumerate(pages):
            n = len(p.numbers)
            x[:n, k, :PATH_SIZE] = _sum_of(self.path, p.path, p.path_of, n)[0]
            x[:n, k, PATH_SIZE : PATH_SIZE + WORD_SIZE] = _sum_of(self.words, p.words, p.words_of, n)[0]
            x[:n, k, PATH_SIZE + WORD_SIZE :] = p.numbers
            used[:n, k] = True
        return x, used

    def read(self, x: np.ndarray, used: np.ndarray, keep: list | None = None) -> np.ndarray:
        """Logits (T, B); a direction's state stays as it is beyond a page's blocks."""
        steps, side, _ = x.shape
        every = np.empty((2, steps, side, HIDDEN), np.float32)
        for k in range(2):
            h = np.zeros((side, HIDDEN), np.float32)
            c = np.zeros_like(h)
            given = x @ self.given[k] + self.bias[k]
            for t in range(steps) if k == 0 else range(steps - 1, -1, -1):
                gates = given[t] + h @ self.recurrent[k]
                i, f, o = (_sigmoid(gates[:, j * HIDDEN : (j + 1) * HIDDEN]) for j in range(3))
                g = np.tanh(gates[:, 3 * HIDDEN :])
                on = used[t][:, None]
                c_new = np.where(on, f * c + i * g, c)
                tanh_c = np.tanh(c_new)
                h_new = np.where(on, o * tanh_c, h)
                if keep is not None:
                    keep.append((k, t, h, c, i, f, o, g, tanh_c))
                h, c = h_new, c_new
                every[k, t] = h
        if keep is not None:
            keep.append(every)
        weights = self.out
        return every[0] @ weights[:HIDDEN] + every[1] @ weights[HIDDEN : 2 * HIDDEN] + x @ weights[2 * HIDDEN :] + self.out_bias

    def gradients(self, pages: list[Page], labels: list[np.ndarray]) -> list[np.ndarray]:
        """Gradients of the mean logistic loss by backpropagation through time and into the tables."""
        x, used = self.vectors(pages)
        keep: list = []
        p = _sigmoid(self.read(x, used, keep))
        every = keep.pop()
        d = np.zeros_like(p)
        for k, own in enumerate(labels):
            d[: len(own), k] = p[: len(own), k] - own
        d /= used.sum()
        found = [np.zeros_like(q) for q in self.parameters()]
        d_path, d_words, d_given, d_recurrent, d_bias, d_out, d_out_bias = found
        for k in range(2):
            d_out[k * HIDDEN : (k + 1) * HIDDEN] = np.einsum("tb,tbh->h", d, every[k])
        d_out[2 * HIDDEN :] = np.einsum("tb,tbh->h", d, x)
        d_out_bias[:] = d.sum()
        d_x = d[..., None] * self.out[2 * HIDDEN :]
        d_h = [np.zeros((len(pages), HIDDEN), np.float32) for _ in range(2)]
        d_c = [np.zeros_like(d_h[0]) for _ in range(2)]
        for k, t, h, c, i, f, o, g, tanh_c in reversed(keep):
            on = used[t][:, None]
            dh = d_h[k] + d[t][:, None] * self.out[k * HIDDEN : (k + 1) * HIDDEN]
            inner = np.where(on, dh, 0.0)
            dc = d_c[k] + inner * o * (1 - tanh_c**2)
            moved = np.where(on, dc, 0.0)
            gates = np.concatenate(
                [moved * g * i * (1 - i), moved * c * f * (1 - f), inner * tanh_c * o * (1 - o), moved * i * (1 - g**2)], 1
            )
            d_given[k] += x[t].T @ gates
            d_recurrent[k] += h.T @ gates
            d_bias[k] += gates.sum(0)
            d_x[t] += gates @ self.given[k].T
            d_h[k] = np.where(on, gates @ self.recurrent[k].T, dh)
            d_c[k] = np.where(on, dc * f, dc)
        for k, page in enumerate(pages):
            n = len(page.numbers)
            for table, codes, of, a, b in (
                (d_path, page.path, page.path_of, 0, PATH_SIZE),
                (d_words, page.words, page.words_of, PATH_SIZE, PATH_SIZE + WORD_SIZE),
            ):
                scale = 1.0 / np.sqrt(np.maximum(np.bincount(of, minlength=n), 1))
                np.add.at(table, codes, (d_x[:n, k, a:b] * scale[:, None])[of].astype(np.float32))
        return found


@functools.cache
def trained(layouts: int = LAYOUTS, epochs: int = EPOCHS, seed: int = SEED) -> Labeller:
    """Labeller fitted by Adam to generated layouts; the same in every process."""
    rng = np.random.default_rng(seed)
    codes = PathCodes(PATH_CODES)
    pages, labels = [], []
    for _ in range(layouts):
        blocks = blocks_of(layout(rng), codes)
        labels.append(np.array([ARTICLE_MARK in b.text for b in blocks], np.float32))
        for b in blocks:
            b.text = b.text.translate(LAYOUT_MARKS) or "-"
        pages.append(Page.of(blocks))
    model = Labeller(rng)
    means = [np.zeros_like(p) for p in model.parameters()]
    squares = [np.zeros_like(p) for p in model.parameters()]
    step, last = 0, epochs * (layouts // BATCH)
    by_size = np.argsort([len(p.numbers) for p in pages], kind="stable")
    for _ in range(epochs):
        chunks = [by_size[k : k + BATCH] for k in range(0, layouts - BATCH + 1, BATCH)]
        for k in rng.permutation(len(chunks)):
            step += 1
            found = model.gradients([pages[j] for j in chunks[k]], [labels[j] for j in chunks[k]])
            norm = np.sqrt(sum(float((g * g).sum()) for g in found))
            rate = RATE * (1.0 - 0.95 * step / last)
            for p, g, m, s in zip(model.parameters(), found, means, squares, strict=True):
                g = g * min(1.0, 1.0 / max(norm, 1e-9))
                m += 0.1 * (g - m)
                s += 0.01 * (g * g - s)
                p -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return model


def label_pages(model: Labeller, pages: list[list[Block]]) -> list[np.ndarray]:
    """For every block of every page whether it is the article's."""
    out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
    order = sorted((k for k, blocks in enumerate(pages) if blocks), key=lambda k: len(pages[k]))
    at = 0
    while at < len(order):
        # Pages are padded to the longest of those read together, which is the last one; a long page stands alone.
        end = at + 1
        while end < min(len(order), at + SIDE_BY_SIDE) and (end + 1 - at) * len(pages[order[end]]) <= TOGETHER:
            end += 1
        part = order[at:end]
        at = end
        x, used = model.vectors([Page.of(pages[k]) for k in part])
        logits = model.read(x, used)
        for j, k in enumerate(part):
            out[k] = logits[: len(pages[k]), j] > 0
    return out


def extract(pages: DataFrame, model: Labeller | None = None) -> DataFrame:
    """Main text of every page.

    ``pages`` needs ``page_id``, ``url`` and ``html``; other columns are ignored. NULL or empty html,
    or a page without article blocks, gives an empty text of 0 characters. NULL or repeated ids and
    NULL urls stay as they are, row by row; an empty table gives no rows. Long pages are read whole, alone if
    they have many blocks, so memory follows the blocks of one page. Nothing is shuffled; the model of fixed size goes to the tasks with the plan.
    """
    model = model or trained()

    def run(batches):
        codes = PathCodes(PATH_CODES)
        for whole in batches:
            for at in range(0, whole.num_rows, SIDE_BY_SIDE):
                batch = whole.slice(at, SIDE_BY_SIDE)
                found = [blocks_of(h or "", codes) for h in batch.column(2).to_pylist()]
                marks = label_pages(model, found)
                texts = [" ".join(b.text for b, m in zip(*pair, strict=True) if m) for pair in zip(found, marks, strict=True)]
                sizes, blocks = [len(t) for t in texts], [len(b) for b in found]
                kept = [int(m.sum()) for m in marks]
                ids, urls = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                yield rows_out(_ARROW, (ids, urls, texts, sizes, blocks, kept))

    return pages.select("page_id", "url", "html").mapInArrow(run, SCHEMA)
