"""Cost-balanced packing of tokenized documents into sequences of fixed length."""

from __future__ import annotations

import base64
import functools
import heapq
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame

CAPACITY = 2048
END_ID = 1
#: Tokens that are packed together. A group is a unit of work of one task, whatever the table's size.
GROUP_TOKENS = 1 << 21

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, sequence_length long"
)
_ARROW = pa.schema([(part.split()[0], pa.int64()) for part in SCHEMA.split(", ")])


@functools.cache
def _encoding(ranks_path: str, pattern: str) -> tiktoken.Encoding:
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_bytes(text: str, ranks_path: str, pattern: str, specials: dict[str, int]) -> bytes:
    """Ids of a text as little-endian 32-bit numbers; strings of special tokens are that token."""
    for special, number in specials.items():
        if special in text:
            inner = (token_bytes(part, ranks_path, pattern, specials) for part in text.split(special))
            return np.array([number], "<u4").tobytes().join(inner)
    return array("I", _encoding(ranks_path, pattern).encode_ordinary(text)).tobytes()


def pack(lengths: list[int], capacity: int = CAPACITY, linear: float = 1.0, quadratic: float = 1.0 / 512) -> tuple:
    """Pieces (document, start, length, sequence, offset) and the sequences' lengths.

    A piece of n tokens costs ``linear * n + quadratic * n * n``, as attention inside a document does.
    Documents go in descending length to the sequence of lowest cost that has room left; what does
    not fit goes on in the next. All sequences end full: the tokens beyond a multiple of ``capacity``
    make sequences whose lengths are powers of two, which need no padding.
    """
    total = sum(lengths)
    rest = total % capacity
    rooms = [capacity] * (total // capacity) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    used = [0] * len(rooms)
    heap = [(0.0, s) for s in range(len(rooms))]
    pieces = []
    for doc in sorted(range(len(lengths)), key=lambda d: (-lengths[d], d)):
        start, left = 0, lengths[doc]
        while left:
            cost, s = heap[0]
            take = min(left, rooms[s] - used[s])
            pieces.append((doc, start, take, s, used[s]))
            used[s] += take
            start += take
            left -= take
            if used[s] < rooms[s]:
                heapq.heapreplace(heap, (cost + linear * take + quadratic * take * take, s))
            else:
                heapq.heappop(heap)
    return pieces, rooms


def pack_documents(
    docs: DataFrame, ranks_path: str, pattern: str, specials: dict[str, int], capacity: int = CAPACITY
) -> DataFrame:
    """Pieces of all documents, one row each.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. Every document ends with id 1;
    a NULL or empty text is that id alone. Repeated rows are packed once each; a NULL id stays NULL.
    An empty table gives no rows. Each task tokenizes its rows and packs them in groups of about
    ``GROUP_TOKENS`` tokens (a longer document is a group of its own), so nothing is shuffled and a
    retried task repeats its result. ``sequence_id`` holds the task in its upper and a running number
    in its lower 32 bits; ``sequence_length`` is the filled length of the piece's sequence.
    """
    end = np.array([END_ID], "<u4").tobytes()

    def emit(group: list[tuple[int | None, bytes]], first: int) -> tuple[pa.RecordBatch, int]:
        lengths = [len(ids) // 4 for _, ids in group]
        pieces, rooms = pack(lengths, capacity)
        rows = [
            (
                group[d][0], start, n, zlib.crc32(memoryview(group[d][1])[4 * start : 4 * (start + n)]),
                lengths[d], first + s, offset, rooms[s],
            )
            for d, start, n, s, offset in pieces
        ]
        columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
        return pa.RecordBatch.from_arrays(columns, schema=_ARROW), first + len(rooms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        following = TaskContext.get().partitionId() << 32
        group: list[tuple[int | None, bytes]] = []
        tokens = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = token_bytes(text.as_py() or "", ranks_path, pattern, specials) + end
                group.append((doc_id, ids))
                tokens += len(ids) // 4
                if tokens >= GROUP_TOKENS:
                    out, following = emit(group, following)
                    yield out
                    group, tokens = [], 0
        if group:
            yield emit(group, following)[0]

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
