"""Byte-pair encoding and decoding with a segment tree over the ranks of adjacent pairs.

The leaves of a word's tree hold the merge rank of the pair that starts at each symbol. The root is the
lowest rank, and going down to the left wherever the minimum lies there finds its leftmost pair. A
merge changes three leaves and their paths. Words of a batch that are not yet known are merged
together, one tree per row of an array; a very long word gets a tree of its own.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from scorewatch.llm.common import map_batches, rows_out, text_column

_NONE = np.int32(2**31 - 1)
#: Control characters that one of the two pattern libraries takes for white space.
_SEPARATORS = re.compile("[\x1c-\x1f]")
#: Symbols up to which words are merged together in one array.
WIDEST_ROW = 64
#: Words a worker remembers; the memory is emptied when full.
CACHE_WORDS = 600_000

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
)


def byte_symbols() -> list[str]:
    """Printable character of every byte: itself where printable, else the next free one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Vocabulary:
    """A BPE model read from a tokenizer file: word ends, merges, and the patterns of its words."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as source:
            spec = json.load(source)
        model = spec["model"]
        ids = model["vocab"]
        self.suffix = model["end_of_word_suffix"]
        self.tokens = [""] * (max(max(ids.values()), *(t["id"] for t in spec["added_tokens"])) + 1)
        for token, number in ids.items():
            self.tokens[number] = token
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for token, number in self.specials.items():
            self.tokens[number] = token
        symbols = byte_symbols()
        self.inner = np.array([ids[s] for s in symbols], np.int32)
        self.final = np.array([ids[s + self.suffix] for s in symbols], np.int32)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.merges = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in reversed([*enumerate(pairs)])}
        self.size = np.int64(len(self.tokens))
        keys = np.array([a * self.size + b for a, b in self.merges], np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.ranks = np.array([r for r, _ in self.merges.values()], np.int32)[order]
        self.merged = np.array([m for _, m in self.merges.values()], np.int32)[order]
        pattern = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(pattern["pattern"]["Regex"])
        self.special = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")")
        self.plain = re.compile(re.sub(r"\\p\{L\}", "a-z", re.sub(r"\\p\{N\}", "0-9", self.words.pattern)))
        self.ids: dict[str, bytes] = {}
        self.decoded: dict[str, str] = {}

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of each pair; pairs without a merge have the largest rank."""
        keys = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        found = (self.keys[at] == keys) & (left >= 0) & (right >= 0)
        return np.where(found, self.ranks[at], _NONE), self.merged[at]

    def normal(self, text: str) -> str:
        """Composed and in lower case, character by character."""
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def pieces(self, text: str) -> list[str]:
        """Words of a text; a pattern without Unicode classes is enough for ASCII."""
        if text.isascii() and not _SEPARATORS.search(text):
            return self.plain.findall(text.lower())
        return self.words.findall(self.normal(text))

    def symbols(self, word: str) -> np.ndarray:
        data = np.frombuffer(word.encode(), np.uint8)
        out = self.inner[data]
        out[-1] = self.final[data[-1]]
        return out

    def learn(self, words: set[str]) -> None:
        """Encode the words that are not known yet."""
        if len(self.ids) + len(words) > CACHE_WORDS:
            self.ids.clear()
            self.decoded.clear()
        rows: dict[int, list[str]] = {}
        for word in words - self.ids.keys():
            size = len(word) if word.isascii() else len(word.encode())
            if size > WIDEST_ROW:
                self._keep(word, merge_one(self, self.symbols(word)))
            else:
                rows.setdefault(1 << max(1, (size - 1).bit_length()), []).append(word)
        for width, group in rows.items():
            for k in range(0, len(group), 1 << 14):
                part = group[k : k + (1 << 14)]
                ids, sizes = merge_rows(self, part, width)
                data, n = ids.astype("<u4").tobytes(), 0
                for word, size in zip(part, sizes.tolist(), strict=True):
                    self._keep(word, data[4 * n : 4 * (n + size)])
                    n += size

    def _keep(self, word: str, ids: bytes) -> None:
        self.ids[word] = ids
        self.decoded[word] = " ".join([self.tokens[i] for i in array("I", ids)])

    def encode_all(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """Ids (little-endian 32-bit) and decoded text of each text."""
        parts = [[self.pieces(p) if k % 2 == 0 else p for k, p in enumerate(self.special.split(t))] for t in texts]
        self.learn(set().union(*(p for mine in parts for p in mine[::2])))
        out = []
        for mine in parts:
            ids, decoded = [], []
            for k, part in enumerate(mine):
                if k % 2:
                    ids.append(np.array([self.specials[part]], "<u4").tobytes())
                    decoded.append(part)
                elif part:
                    ids.append(b"".join(map(self.ids.__getitem__, part)))
                    decoded.append(" ".join(map(self.decoded.__getitem__, part)))
            out.append((b"".join(ids), " ".join(decoded)))
        return out


def merge_rows(vocabulary: Vocabulary, words: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Merge words of at most ``width`` (a power of two) bytes; their ids one after another and counts."""
    data = [w.encode() for w in words]
    sizes = np.fromiter(map(len, data), np.int64, len(data))
    n = len(words)
    sym = np.full((n, width), -1, np.int64)
    place = np.arange(width) < sizes[:, None]
    sym[place] = vocabulary.inner[np.frombuffer(b"".join(data), np.uint8)]
    last = sizes - 1
    sym[np.arange(n), last] = vocabulary.final[[d[-1] for d in data]]
    after = np.tile(np.arange(1, width + 1), (n, 1))
    before = np.tile(np.arange(-1, width - 1), (n, 1))
    tree = np.full((n, 2 * width), _NONE, np.int32)
    result = np.zeros((n, width), np.int64)
    tree[:, width:-1], result[:, :-1] = vocabulary.pair_ranks(sym[:, :-1], sym[:, 1:])
    for level in range(width.bit_length() - 2, -1, -1):
        a, b = 1 << level, 2 << level
        tree[:, a:b] = np.minimum(tree[:, 2 * a : 2 * b : 2], tree[:, 2 * a + 1 : 2 * b : 2])
    rows = np.flatnonzero(tree[:, 1] != _NONE)
    while len(rows):
        node = np.ones(len(rows), np.int64)
        for _ in range(width.bit_length() - 1):
            node = 2 * node
            node += tree[rows, node] != tree[rows, 1]
        here = node - width
        gone = after[rows, here]
        nxt = after[rows, gone]
        prv = before[rows, here]
        sym[rows, here] = result[rows, here]
        sym[rows, gone] = -1
        after[rows, here] = nxt
        inside = nxt < width
        before[rows[inside], nxt[inside]] = here[inside]
        follower = np.where(inside, sym[rows, np.minimum(nxt, width - 1)], -1)
        rank, merged = vocabulary.pair_ranks(sym[rows, here], follower)
        _set_leaves(tree, result, rows, here, rank, merged, width)
        _set_leaves(tree, result, rows, gone, np.full(len(rows), _NONE), merged, width)
        some = prv >= 0
        if some.any():
            r, p = rows[some], prv[some]
            rank, merged = vocabulary.pair_ranks(sym[r, p], sym[r, here[some]])
            _set_leaves(tree, result, r, p, rank, merged, width)
        rows = rows[tree[rows, 1] != _NONE]
    alive = sym >= 0
    return sym[alive], alive.sum(1)


def _set_leaves(tree, result, rows, at, rank, merged, width) -> None:
    result[rows, at] = merged
    node = at + width
    tree[rows, node] = rank
    while width > 1:
        node >>= 1
        width >>= 1
        tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])


def merge_one(vocabulary: Vocabulary, symbols: np.ndarray) -> bytes:
    """Merge one word of any length with a segment tree of its own."""
    n = len(symbols)
    width = 1 << max(1, (n - 1).bit_length())
    sym = symbols.tolist()
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    none = (int(_NONE), 0)
    merges = vocabulary.merges
    tree = [none[0]] * (2 * width)
    for i in range(n - 1):
        tree[width + i] = merges.get((sym[i], sym[i + 1]), none)[0]
    for node in range(width - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])

    def put(i: int, rank: int) -> None:
        node = width + i
        tree[node] = rank
        while node > 1:
            node >>= 1
            low = min(tree[2 * node], tree[2 * node + 1])
            if tree[node] == low:
                break
            tree[node] = low

    while tree[1] != none[0]:
        node = 1
        while node < width:
            node = 2 * node + (tree[2 * node] != tree[1])
        i = node - width
        j = after[i]
        sym[i] = merges[sym[i], sym[j]][1]
        sym[j] = -1
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
            put(i, merges.get((sym[i], sym[after[i]]), none)[0])
        else:
            put(i, none[0])
        put(j, none[0])
        if before[i] >= 0:
            put(before[i], merges.get((sym[before[i]], sym[i]), none)[0])
    return array("I", [s for s in sym if s >= 0]).tobytes()


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """Number of tokens and digests of the ids and of the decoded text, one row per document.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. A NULL text is encoded as an
    empty one: no tokens, and the digests of nothing. Rows with a NULL or repeated id stay rows of
    their own; an empty table gives no rows. Strings of special tokens are that token. Nothing is
    shuffled; a worker remembers at most ``CACHE_WORDS`` words besides those of one batch.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = vocabulary(path).encode_all(text_column(batch))
        sha = lambda data: hashlib.sha256(data).hexdigest()
        return rows_out(
            _ARROW,
            (
                batch.column(0).to_pylist(),
                [len(ids) // 4 for ids, _ in found],
                [sha(ids) for ids, _ in found],
                [sha(text.encode()) for _, text in found],
            ),
        )

    return map_batches(docs.select("doc_id", "text"), work, SCHEMA, piecewise=True)
