"""Removal of byte strings that also start in a document with a smaller id, by sharded suffix arrays.

Every window of 50 bytes is labelled by its rarest-hashed inner string (its minimizer). Minimizers found in
two documents mark the text that can repeat; each carries the smallest document that holds it. Runs of windows with
the same smallest document are cut out as pieces, equal windows always lie in pieces of one such document, so pieces are
dealt to shards by it. A shard sorts the suffixes of its different pieces and reads the repeats off
their common prefixes.
"""

from __future__ import annotations

import hashlib
import math
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from scorewatch.llm.common import mix64, pieces_of, pin, rows_out
from scorewatch.llm.suffix_array import common_prefixes, suffix_array

WINDOW = 50
#: Length of the inner strings (16 to 32 bytes), and how many of them a window has.
INNER = 24
SPAN = WINDOW - INNER + 1
#: Bytes of pieces that one shard sorts. The pieces of a leader with more are cut by mark.
SHARD_BYTES = 1 << 20
#: Bytes of texts that are hashed at once, few enough for the processor's cache.
HASHED_BYTES = 1 << 17

OUTPUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def inner_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the inner string at every position that has one, from its first and its last 16 bytes."""
    odd = np.uint64(0xD6E8FEB86659FD93)
    hashed = mix64((data.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    for size in (1, 2, 4, 8):
        hashed = hashed[: len(hashed) - size] * odd + (hashed[size:] ^ (hashed[size:] >> np.uint64(29)))
    n = len(data) - INNER + 1
    return mix64(hashed[:n] * odd + hashed[INNER - 16 : INNER - 16 + n])


def window_marks(hashes: np.ndarray) -> np.ndarray:
    """Smallest inner hash of every window."""
    least, size = hashes, 1
    while 2 * size <= SPAN:
        least = np.minimum(least[: len(least) - size], least[size:])
        size *= 2
    rest = SPAN - size
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts as one array with their starts and sizes."""
    sizes = np.array([len(t) for t in texts], np.int64)
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum(sizes) - sizes, sizes


def _marks(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Inner hashes of the joined texts, mark of every window and the windows' range of each text."""
    data, starts, sizes = _joined(texts)
    if len(data) < WINDOW:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), starts, starts
    hashes = inner_hashes(data)
    return hashes, window_marks(hashes), starts, starts + np.maximum(sizes - WINDOW + 1, 0)


def _cached(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts of about ``HASHED_BYTES``, with the index of the first."""
    first, size = 0, 0
    for k, text in enumerate(texts):
        size += len(text)
        if size >= HASHED_BYTES:
            yield first, texts[first : k + 1]
            first, size = k + 1, 0
    if first < len(texts):
        yield first, texts[first:]


def _dealt(doc_ids: np.ndarray, parts: int) -> np.ndarray:
    return (mix64(doc_ids.view(np.uint64)) % np.uint64(parts)).astype(np.int64)


def _packed(*arrays: np.ndarray) -> bytes:
    data = b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)
    return zstandard.compress(struct.pack("<q", len(arrays[0])) + data, 1)


def _unpacked(blob: bytes, *kinds: str) -> list[np.ndarray]:
    data = zstandard.decompress(blob)
    n, at, out = struct.unpack_from("<q", data)[0], 8, []
    for kind in kinds:
        out.append(np.frombuffer(data, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out


def mark_rows(docs: DataFrame, parts: int) -> DataFrame:
    """(part, blob) rows: the documents' different marks, dealt by mark; 48 bits of a mark are kept."""

    def run(batches):
        for batch in pieces_of(batches):
            ids = np.array(batch.column("doc_id").to_pylist(), np.int64)
            texts = [t.encode() for t in batch.column("text").to_pylist()]
            found, owner = [], []
            for first, some in _cached(texts):
                _, marks, firsts, ends = _marks(some)
                for k, (a, b) in enumerate(zip(firsts.tolist(), ends.tolist(), strict=True), first):
                    if b > a:
                        own = marks[a:b]
                        own = np.unique(own[np.concatenate([[True], own[1:] != own[:-1]])])
                        found.append(own)
                        owner.append(np.full(len(own), k))
            if not found:
                continue
            mark, owner = np.concatenate(found), np.concatenate(owner)
            part = ((mark >> np.uint64(48)) % np.uint64(parts)).astype(np.int64)
            order = np.lexsort((owner, part))
            mark, owner, part = mark[order], owner[order], part[order]
            cuts = np.searchsorted(part, np.arange(parts + 1))
            out = []
            for k in range(parts):
                a, b = cuts[k], cuts[k + 1]
                if b > a:
                    low, high = mark[a:b].astype(np.uint32), (mark[a:b] >> np.uint64(32)).astype(np.uint32)
                    step = np.diff(ids[owner[a:b]], prepend=0)
                    out.append((k, _packed(low, high.astype(np.uint16), step)))
            columns = [pa.array([k for k, _ in out], pa.int32()), pa.array([b for _, b in out], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "blob"])

    return docs.mapInArrow(run, "part int, blob binary")


def shared_marks(marks: DataFrame, parts: int) -> DataFrame:
    """(part, blob) rows, dealt by document: the marks of two or more documents and the smallest one."""

    def share(table: pa.Table) -> pa.Table:
        lows, highs, docs = [], [], []
        for blob in table.column("blob"):
            low, high, step = _unpacked(blob.as_py(), "<u4", "<u2", "<i8")
            lows.append(low)
            highs.append(high)
            docs.append(np.cumsum(step))
        mark = np.concatenate(lows).astype(np.uint64) | (np.concatenate(highs).astype(np.uint64) << np.uint64(32))
        doc = np.concatenate(docs)
        order = np.lexsort((doc, mark))
        mark, doc = mark[order], doc[order]
        first = np.flatnonzero(np.concatenate([[True], mark[1:] != mark[:-1]]))
        last = np.concatenate([first[1:], [len(mark)]]) - 1
        shared = doc[first] != doc[last]
        counts = np.diff(np.concatenate([first, [len(mark)]]))
        keep = np.repeat(shared, counts)
        leader = np.repeat(doc[first], counts)[keep]
        mark, doc = mark[keep], doc[keep]
        to = _dealt(doc, parts)
        out = []
        for k in range(parts):
            mine = to == k
            if mine.any():
                own, at = np.unique(mark[mine], return_index=True)
                out.append((k, _packed(own, leader[mine][at])))
        return pa.table({"part": pa.array([k for k, _ in out], pa.int32()), "blob": pa.array([b for _, b in out], pa.binary())})

    return marks.groupBy("part").applyInArrow(share, "part int, blob binary")


def text_rows(docs: DataFrame, parts: int) -> DataFrame:
    """(part, doc_id, row, blob): the documents' compressed texts, dealt by document; ``row`` tells texts apart."""

    def run(batches):
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            ids = np.array(batch.column("doc_id").to_pylist(), np.int64)
            blobs = [packer.compress(t.encode()) for t in batch.column("text").to_pylist()]
            part = pa.array(_dealt(ids, parts).astype(np.int32))
            columns = [part, pa.array(ids), batch.column("row"), pa.array(blobs, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "doc_id", "row", "blob"])

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("row"))
    return rows.mapInArrow(run, "part int, doc_id long, row long, blob binary")


_CUT = "doc_id long, row long, leader long, start long, size long, h1 long, h2 long, last long, data binary"
_CUT_ARROW = pa.schema(
    [(name, pa.int64()) for name in ("doc_id", "row", "leader", "start", "size", "h1", "h2", "last")]
    + [("data", pa.binary())]
)


def _pieces(windows: np.ndarray, hashes: np.ndarray, leaders: np.ndarray, at: int) -> list[tuple[int, int, int]]:
    """(leader, first byte, end byte) of the pieces of one text, relative to its first byte.

    A run of windows is cut where its first minimizer starts and its last one ends: what lies between is
    the same in all documents that share the run, and copies of it are merged before they are moved.
    """
    known = leaders >= 0
    change = np.flatnonzero(np.concatenate([[True], leaders[1:] != leaders[:-1]]))
    ends = np.concatenate([change[1:], [len(leaders)]])
    out = []
    for a, b in zip(change.tolist(), ends.tolist(), strict=True):
        if not known[a]:
            continue
        leader = int(leaders[a])
        first = a + int(np.argmax(hashes[at + a : at + a + SPAN] == windows[at + a]))
        final = hashes[at + b - 1 : at + b - 1 + SPAN] == windows[at + b - 1]
        last = b - 1 + SPAN - 1 - int(np.argmax(final[::-1])) + INNER
        if last - first >= WINDOW:
            if first > a:
                out.append((leader, a, first - 1 + WINDOW))
            out.append((leader, first, last))
            if last - WINDOW + 1 < b:
                out.append((leader, last - WINDOW + 1, b - 1 + WINDOW))
        else:
            out.append((leader, a, b - 1 + WINDOW))
    return out


def cut_pieces(texts: DataFrame, shared: DataFrame) -> DataFrame:
    """The documents' pieces, each named by 128 bits of its digest.

    Of equal pieces of one part the first carries the bytes, the smallest document and, in ``last``, the
    largest one; the others only say where they lie.
    """

    def cut(given: pa.Table) -> pa.Table:
        out = []
        names, keys, blobs, marks, leaders = [], [], [], [], []
        first_of: dict[tuple, list] = {}
        for batch in given.to_batches():
            fields = (batch.column(name).to_pylist() for name in ("doc_id", "row", "blob", "kind"))
            for doc_id, row, blob, kind in zip(*fields, strict=True):
                if kind:
                    names.append(doc_id)
                    keys.append(row)
                    blobs.append(blob)
                else:
                    own, leader = _unpacked(blob, "<u8", "<i8")
                    marks.append(own)
                    leaders.append(leader)
        order = sorted(range(len(names)), key=names.__getitem__)
        names, keys, blobs = ([column[k] for k in order] for column in (names, keys, blobs))
        table = np.concatenate(marks) if marks else np.zeros(0, np.uint64)
        table, at = np.unique(table, return_index=True)
        leader_of = np.concatenate(leaders)[at] if marks else np.zeros(0, np.int64)
        low = np.uint64((1 << 48) - 1)
        distinct, code = np.unique(leader_of, return_inverse=True)
        for from_ in range(0, len(names), 32):
            some = blobs[from_ : from_ + 32]
            plain = [zstandard.decompress(b) if b else b"" for b in some]
            hashes, windows, firsts, ends = _marks(plain)
            ids = np.unique(windows & low) if len(windows) else windows
            pos = np.minimum(np.searchsorted(table, ids), max(len(table) - 1, 0))
            found = table[pos] == ids if len(table) else np.zeros(len(ids), bool)
            # Marks by rank, so that leaders that are negative ids need no place of their own.
            rank = np.where(found, pos, -1)
            every = rank[np.searchsorted(ids, windows & low)] if len(windows) else np.zeros(0, np.int64)
            every = np.where(every >= 0, code[every] if len(code) else -1, -1)
            rows = []
            for k, (text, a, b) in enumerate(zip(plain, firsts.tolist(), ends.tolist(), strict=True)):
                doc_id, row = names[from_ + k], keys[from_ + k]
                cuts = _pieces(windows, hashes, every[a:b], a) if b > a and (every[a:b] >= 0).any() else []
                for c, x, y in cuts:
                    h1, h2 = struct.unpack("<qq", hashlib.blake2b(text[x:y], digest_size=16).digest())
                    leader = int(distinct[c])
                    piece = (doc_id, row, leader, x, y - x, h1, h2, doc_id)
                    known = first_of.get((leader, h1, h2))
                    if known:
                        known[7] = doc_id
                        rows.append((*piece, None))
                    else:
                        first_of[leader, h1, h2] = [*piece, text[x:y]]
            if rows:
                out.append(rows_out(_CUT_ARROW, zip(*rows, strict=True)))
        if first_of:
            out.append(rows_out(_CUT_ARROW, zip(*first_of.values(), strict=True)))
        return pa.Table.from_batches(out, schema=_CUT_ARROW)

    both = texts.select("part", F.lit(1).alias("kind"), "doc_id", "row", "blob").union(
        shared.select("part", F.lit(0), F.lit(0).cast("long"), F.lit(0).cast("long"), "blob")
    )

    return both.groupBy("part").applyInArrow(cut, _CUT)


def _repeats(table: pa.Table) -> pa.Table:
    """Runs (a, b) of window starts of a shard's pieces, with the smallest document that holds them."""
    table = table.sort_by([("leader", "ascending"), ("h1", "ascending"), ("h2", "ascending")])
    names = [table.column(n).to_numpy() for n in ("leader", "h1", "h2")]
    first = np.flatnonzero(np.concatenate([[True], np.any([n[1:] != n[:-1] for n in names], axis=0)]))
    least = np.minimum.reduceat(table.column("doc_id").to_numpy(), first)
    last = np.maximum.reduceat(table.column("last").to_numpy(), first)
    table = table.take(pa.array(first))
    data = table.column("data").to_pylist()
    whole = np.frombuffer(b"\x00".join(data) + b"\x00", np.uint8).astype(np.int64)
    sizes = np.array([len(d) for d in data], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    text = whole + 2
    text[starts + sizes] = 1
    text = np.concatenate([text, [0]])
    order = suffix_array(text, 258)
    prefix = common_prefixes(text, order)
    piece = np.concatenate([np.repeat(np.arange(len(data)), sizes + 1), [0]])
    offset = np.arange(len(text)) - starts[piece]
    valid = offset + WINDOW <= sizes[piece]
    valid[-1] = False
    group = np.cumsum(prefix[order] < WINDOW)
    ranked = order[valid[order]]
    group = group[valid[order]]
    owner = least[piece[ranked]]
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.zeros(0, np.int64)
    low = np.empty(len(text), np.int64)
    if len(first):
        low[ranked] = np.repeat(np.minimum.reduceat(owner, first), np.diff(np.concatenate([first, [len(group)]])))
    at = np.flatnonzero(valid)
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) != 1) | (low[at[1:]] != low[at[:-1]])
    begin = np.flatnonzero(new)
    end = np.concatenate([begin[1:], [len(at)]]) - 1
    a, b = at[begin], at[end]
    own = piece[a]
    useful = low[a] < last[own]
    a, b, own = a[useful], b[useful], own[useful]
    names = ["leader", "h1", "h2"]
    out = {n: table.column(n).take(pa.array(own)) for n in names}
    return pa.table(out | {"a": offset[a], "b": offset[b] + 1, "low": low[a]})


_PARTS = pa.schema(
    [(name, pa.int64()) for name in ("leader", "of1", "of2", "at", "h1", "h2", "mark", "doc_id", "last")]
    + [("data", pa.binary())]
)


def _by_mark(pieces: DataFrame) -> DataFrame:
    """Pieces (now named of1, of2) cut at offsets ``at`` into runs of windows of one mark, named by digest."""

    def run(batches):
        for batch in batches:
            rows = []
            for leader, h1, h2, doc_id, last, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                marks = window_marks(inner_hashes(np.frombuffer(data, np.uint8))).view(np.int64)
                first = np.flatnonzero(np.concatenate([[True], marks[1:] != marks[:-1]])).tolist()
                for x, y in zip(first, [*first[1:], len(marks)], strict=True):
                    part = data[x : y - 1 + WINDOW]
                    digest = struct.unpack("<qq", hashlib.blake2b(part, digest_size=16).digest())
                    rows.append((leader, h1, h2, x, *digest, int(marks[x]), doc_id, last, part))
                if len(rows) >= 1 << 15:
                    yield rows_out(_PARTS, zip(*rows, strict=True))
                    rows = []
            if rows:
                yield rows_out(_PARTS, zip(*rows, strict=True))

    schema = ", ".join(f"{f.name} {'binary' if f.name == 'data' else 'long'}" for f in _PARTS)
    return pieces.select("leader", "h1", "h2", "doc_id", "last", "data").mapInArrow(run, schema)


def repeat_runs(pieces: DataFrame) -> DataFrame:
    """Runs of repeated windows (leader, h1, h2, a, b, low) in the pieces that carry their bytes.

    Leaders with more bytes than a shard are few; their list is written, so the plan sees its size: a
    small list is broadcast, a long one is joined by a shuffle. Their pieces are cut by mark, equal parts
    are merged, and shards take them by (leader, mark): equal windows have equal marks.
    """
    total = pieces.agg(F.sum("size")).first()[0] or 0
    sizes = pieces.groupBy("leader").agg(F.sum("size").alias("bytes"))
    heavy = pin(sizes.where(F.col("bytes") > SHARD_BYTES), "suffix-heavy")
    heavy_total = heavy.agg(F.sum("bytes")).first()[0] or 0
    schema = "leader long, h1 long, h2 long, a long, b long, low long"
    columns = ["leader", "h1", "h2", "doc_id", "last", "data"]

    def sort_shards(rows: DataFrame, size: int, *key: str) -> DataFrame:
        shard = F.pmod(F.xxhash64(*key), F.lit(max(1, math.ceil(size / SHARD_BYTES))))
        return rows.groupBy(shard.alias("shard")).applyInArrow(_repeats, schema)

    small = pieces.join(heavy, "leader", "left_anti").select(*columns)
    parts = _by_mark(pieces.join(heavy, "leader", "left_semi"))
    merged = parts.groupBy("leader", "mark", "h1", "h2", "data").agg(F.min("doc_id").alias("doc_id"), F.max("last").alias("last"))
    # A part repeats the bytes around its windows, about five times the piece in all.
    part_runs = sort_shards(merged.select("mark", *columns), 5 * heavy_total, "leader", "mark")
    placed = parts.select("leader", "of1", "of2", "at", "h1", "h2").join(part_runs, ["leader", "h1", "h2"])
    runs = placed.select(
        "leader", F.col("of1").alias("h1"), F.col("of2").alias("h2"), (F.col("at") + F.col("a")).alias("a"), (F.col("at") + F.col("b")).alias("b"), "low"
    )
    # Copies of a piece that several tasks carried give equal runs.
    return sort_shards(small, total, "leader").union(runs.distinct())


def removed_spans(texts: DataFrame) -> DataFrame:
    """Byte ranges to remove (doc_id, row and the arrays a, b) of the texts (doc_id, text) that have some."""
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shared = shared_marks(mark_rows(texts, parts), parts)
    pieces = pin(cut_pieces(text_rows(texts, parts), shared), "suffix-cut")
    runs = repeat_runs(pieces.where("data is not null"))
    # The smallest document of a piece is its own leader at best and loses nothing there.
    places = pieces.where("leader < doc_id").select("doc_id", "row", "leader", "start", "h1", "h2")
    found = places.join(runs, ["leader", "h1", "h2"]).where(F.col("low") < F.col("doc_id"))
    span = F.struct((F.col("start") + F.col("a")).alias("a"), (F.col("start") + F.col("b") - 1 + WINDOW).alias("b"))
    spans = found.groupBy("doc_id", "row").agg(F.collect_set(span).alias("spans"))
    return spans.select("doc_id", "row", F.col("spans.a").alias("a"), F.col("spans.b").alias("b"))


def _named(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit("")).alias("text")
    return docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), text)


def kept_parts(data: bytes, begins: Iterable[int], ends: Iterable[int]) -> tuple[bytes, int]:
    """The bytes outside the spans and the number of maximal removed runs."""
    parts, at, runs = [], 0, 0
    end = -1
    for a, b in sorted(zip(begins, ends, strict=True)):
        if a > end:
            runs += 1
            parts.append(data[at:a])
        at = end = max(end, b)
    parts.append(data[at:])
    return b"".join(parts), runs


def dedupe_bytes(docs: DataFrame) -> DataFrame:
    """What is removed of every document, and the digest of what is left.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. A byte goes if a string of
    ``WINDOW`` bytes that covers it also starts in a document with a smaller id, judged on the input.
    A NULL text counts as empty. Rows of one id do not remove each other. A row without an id is left
    whole and removes nothing. An empty table gives no rows.
    """
    texts = _named(docs)
    spans = removed_spans(texts)

    def finish(batches):
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for doc_id, blob, a, b in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                data = unpacker.decompress(blob)
                kept, runs = kept_parts(data, a or [], b or [])
                rows.append((doc_id, len(data), len(data) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
            if rows:
                names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=names)

    # Compressed texts are read from the input again: they are moved once here and stored nowhere.
    packed = text_rows(texts, 1).select("doc_id", "row", "blob")
    some = packed.join(spans, ["doc_id", "row"], "left").select("doc_id", "blob", "a", "b").mapInArrow(finish, OUTPUT)
    zero = F.lit(0).cast("long")
    text = F.coalesce("text", F.lit("")).cast("binary")
    nameless = docs.where("doc_id is null").select(
        F.col("doc_id").cast("long"), F.length(text).cast("long"), zero, zero, F.sha2(text, 256)
    )
    return some.union(nameless)


@F.pandas_udf(StringType())
def _kept_text(text: pd.Series, begins: pd.Series, ends: pd.Series) -> pd.Series:
    """Texts without their spans; unchanged where there are none."""
    return pd.Series(
        [
            t if a is None else kept_parts((t or "").encode(), a, b)[0].decode("utf-8", "ignore")
            for t, a, b in zip(text, begins, ends, strict=True)
        ],
        dtype=object,
    )


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents with repeated strings cut out of ``text``, and ``n_chars`` (if any) set anew.

    All other columns and all rows stay; a text may become empty. Characters of which only some bytes
    were cut go with them. Odd input as for ``dedupe_bytes``.
    """
    spans = removed_spans(_named(docs))
    rows = docs.select(
        F.struct(*docs.columns).alias("doc"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("row"),
    )
    cut = rows.join(spans, ["doc_id", "row"], "left").select(
        "doc", F.col("a").isNotNull().alias("changed"), _kept_text("doc.text", "a", "b").alias("kept")
    )
    renewed = {"text": F.col("kept")}
    if "n_chars" in docs.columns:
        renewed["n_chars"] = F.when(F.col("changed"), F.char_length("kept")).otherwise(F.col("doc.n_chars"))
    return cut.select(
        *[(renewed[c].cast(docs.schema[c].dataType) if c in renewed else F.col("doc")[c]).alias(c) for c in docs.columns]
    )
