"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewatch.session import shared_folder

#: ASCII white space; a word is a maximal run of other characters.
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"

_MIX = np.uint64(0x9E3779B97F4A7C15)


def pin(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table below the shared folder, compressed well, and read it back; cuts the lineage."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words_of(text: Column) -> Column:
    """Words of a text as an array; NULL and blank texts have none."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_RUN))


def id_share(doc_id: Column, parts: int) -> Column:
    """Remainder of the CRC-32 of the id as text; NULL ids count as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalising 64-bit mix of unsigned numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hash of each word, the same in every process.

    The words are read as one buffer: a positional polynomial per byte is summed per word.
    """
    if not words:
        return np.zeros(0, np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    data = np.frombuffer(b"".join(words), np.uint8).astype(np.uint64)
    starts = np.cumsum(sizes) - sizes
    place = (np.arange(len(data)) - np.repeat(starts, sizes)).astype(np.uint64)
    salted = mix64((data + np.uint64(1)) * _MIX + place * np.uint64(0xD6E8FEB86659FD93))
    return mix64(np.add.reduceat(salted, starts) + sizes.astype(np.uint64) * _MIX)


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words; of the whole sequence when it is shorter."""
    if not len(hashes):
        return hashes
    size = min(size, len(hashes))
    n = len(hashes) - size + 1
    out = np.full(n, np.uint64(size))
    for k in range(size):
        out = mix64(out * np.uint64(0xD6E8FEB86659FD93) + hashes[k : k + n])
    return out


def text_column(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """Texts of a batch, NULL as empty."""
    return [t or "" for t in batch.column(name).to_pylist()]


def rows_out(schema: pa.Schema, columns: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def pieces_of(batches: Iterator[pa.RecordBatch], limit: int = 16 << 20, name: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of a piece hold about ``limit`` bytes; a longer text stands alone."""
    for batch in batches:
        sizes = np.array([len(t) if t else 0 for t in batch.column(name).to_pylist()], np.int64)
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // limit)) + 1
        edges = [0, *cuts.tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def map_batches(df: DataFrame, work, schema: str, piecewise: bool = False, limit: int = 4 << 20) -> DataFrame:
    """``mapInArrow`` with a function from one batch to one batch, on demand of ``limit`` bytes of text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, limit) if piecewise else batches:
            if batch.num_rows:
                yield work(batch)

    return df.mapInArrow(run, schema)
