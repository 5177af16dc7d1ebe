"""SimHash fingerprints of whole texts and the search for near ones by permuted block tables."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewatch.llm.common import map_batches, mix64, pin, rows_out, shingle_hashes, word_hashes

BITS = 128
WORDS = BITS // 64
SHINGLE = 5
#: Hamming distance up to which fingerprints are near, and the blocks that the bits are cut into.
RADIUS = 3
BLOCKS = 4
#: Distance of near texts: on sf0.1 the 335 pairs at Jaccard similarity 0.75 to 1 lie 7 to 31 bits apart.
NEAR = 31
#: Blocks of 32 bits of the tables for ``NEAR``: of two fingerprints at most that far apart, some block differs in
#: at most ``_BLOCK_ERRORS`` bits.
COVER_BLOCKS, _BLOCK_ERRORS = 4, 7
#: A vector for every bit of a block. Any are right; with these no table has under 12 bits, found by a search.
_VECTORS = np.array(
    [158, 138, 131, 241, 55, 43, 142, 159, 234, 109, 15, 223, 35, 60, 76, 186, 77, 41, 164, 97, 91, 49, 126, 200, 3, 155]
    + [99, 104, 115, 94, 245, 121],
    np.uint32,
)
#: Fingerprints of one part, parts that the search is cut into at least, and fingerprints that a part is worth.
GROUP, LEAST_PARTS, SMALL = 1 << 19, 5, 4096
#: Pairs of a tile up to which all are compared without tables. Like the parts this only moves the cost.
FEW = 1 << 30
#: Pairs that are compared at once, and near pairs of a tile that are held at once.
_PAIRS, _HELD = 1 << 16, 1 << 23
#: Of ``sampled_bits``: share of the pairs at a radius to be found, and mean number of fingerprints with the same key.
RECALL, SAMPLED_GROUP = 0.99, 4096
#: Terms whose bits are voted on at once.
_CHUNK = 4096

SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ]
)


def fingerprint(text: str) -> bytes:
    """Sign of the weighted votes of a text's five-word shingles on each bit.

    Words are in lower case; a text with fewer words votes with its whole sequence. A shingle that
    occurs n times weighs 1 + ln n. A text without words has all bits clear.
    """
    words = text.lower().encode("utf-8", "surrogatepass").split()
    terms, counts = np.unique(shingle_hashes(word_hashes(words), SHINGLE), return_counts=True)
    votes = np.zeros(BITS)
    weights = (1.0 + np.log(counts)).astype(np.float32)
    for k in range(0, len(terms), _CHUNK):
        part = terms[k : k + _CHUNK]
        lanes = np.stack([mix64(part + np.uint64(lane) * np.uint64(0x9E3779B97F4A7C15)) for lane in range(WORDS)], axis=1)
        bits = np.unpackbits(lanes.view(np.uint8), axis=1).astype(np.float32)
        votes += weights[k : k + _CHUNK] @ (2.0 * bits - 1.0)
    return np.packbits(votes > 0).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    return 1.0 - (int.from_bytes(a) ^ int.from_bytes(b)).bit_count() / BITS


def edited_text(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the start of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def with_next(docs: DataFrame) -> DataFrame:
    """Documents in ranges of the id, sorted by descending id; ``ghost`` rows are only a next text.

    The bounds are ids of the table (approximate quantiles, one range per shuffle partition), so each
    range starts with a known id, and a copy of that row ends the range before. Only the bounds pass
    through the driver.
    """
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = F.col("doc_id").cast("long")
    shares = [k / ranges for k in range(1, ranges)] or [1.0]
    cuts, top = docs.agg(F.percentile_approx(ids, shares, 20 * ranges), F.max(ids)).first()
    bounds = sorted({*(cuts or []), *([top] if top is not None else [])})
    # Descending order: range 0 holds the largest ids; NULL ids are the end of the last range.
    last = max(len(bounds) - 1, 0)
    before = {b: (last - k - 1) % (last + 1) for k, b in enumerate(bounds)} or {None: 0}
    edges = np.array(bounds, np.int64)

    def deal(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys = batch.column(0).to_pylist()
        known = np.array([last if k is None else last - int(np.searchsorted(edges, k)) for k in keys], np.int32)
        ghosts = [k for k, key in enumerate(keys) if key in before]
        take = pa.array([*range(len(keys)), *ghosts])
        place = np.concatenate([known, np.array([before[keys[k]] for k in ghosts], np.int32)])
        ghost = np.repeat(np.array([0, 1], np.int32), [len(keys), len(ghosts)])
        out = [*(batch.column(k).take(take) for k in range(3)), pa.array(place), pa.array(ghost)]
        return pa.RecordBatch.from_arrays(out, names=["doc_id", "text", "tie", "place", "ghost"])

    rows = docs.select(ids.alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    dealt = map_batches(
        rows.withColumn("tie", F.xxhash64("text")), deal, "doc_id long, text string, tie long, place int, ghost int"
    )
    order = ["place", "ghost", F.col("doc_id").desc_nulls_last(), F.col("tie").desc()]
    return dealt.repartition(ranges, "place").sortWithinPartitions(*order)


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. A NULL text counts as empty.
    The next document is the one with the next smaller id (after the last, the first); rows of one id
    follow each other by a hash of their text, NULL ids come last. A single document is its own next.
    An empty table gives no rows. Texts are moved once, in ranges of the id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        ended: int | None = None
        out: list[tuple] = []
        for batch in batches:
            columns = [batch.column(k) for k in range(4)]
            for k in range(batch.num_rows):
                doc_id, text, place, ghost = (c[k].as_py() for c in columns)
                if held and place == held[3] and place != ended:
                    mark = fingerprint(text)
                    out.append(compare(held, (doc_id, text, mark, place)))
                    if ghost:
                        ended, held = place, None
                    else:
                        held = (doc_id, text, mark, place)
                elif not ghost:
                    held = (doc_id, text, fingerprint(text), place)
                if len(out) >= 512:
                    yield rows_out(_ARROW, zip(*out, strict=True))
                    out = []
        if out:
            yield rows_out(_ARROW, zip(*out, strict=True))

    def compare(one: tuple, following: tuple) -> tuple:
        doc_id, text, mark, _ = one
        edited = edited_text(text, following[1])
        changed = mark if edited == text else fingerprint(edited)
        sha = hashlib.sha256(edited.encode()).hexdigest()
        near = likeness(mark, changed), likeness(mark, following[2])
        return (doc_id, len(text), sha, mark.hex(), changed.hex(), *near)

    return with_next(docs).select("doc_id", "text", "place", "ghost").mapInArrow(run, SCHEMA)


#: Members of one key that are compared with each other at once.
TILE = 1024


def near_sets(marks: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """Distinct fingerprints with others within ``radius`` bits, and the number of these others.

    ``marks`` needs ``fingerprint`` (hexadecimal, NULL ignored); repeated ones count once. The bits are
    cut into blocks, and every choice of ``blocks - radius`` blocks is a table keyed by their bits: two
    fingerprints within the radius differ in at most ``radius`` blocks, so they meet in some table, and
    they are counted in the first one only. No pairs are listed. Keys with more than ``TILE`` members are dealt into square tiles (one pair of parts of the members
    each), so no task ever holds a whole large group.
    """
    tables = [*combinations(range(blocks), blocks - radius)]
    width = BITS // blocks // 4
    piece = [F.substring("fingerprint", 1 + b * width, width) for b in range(blocks)]
    keys = F.array(*[F.concat(F.lit(f"{t}:"), *[piece[b] for b in table]) for t, table in enumerate(tables)])
    distinct = marks.select("fingerprint").where("fingerprint is not null").distinct()
    rows = pin(distinct.select("fingerprint", F.explode(keys).alias("key")), "simhash")
    sizes = rows.groupBy("key").count().where("count > 1").withColumn("parts", F.ceil(F.col("count") / TILE).cast("int"))
    members = rows.join(sizes, "key").withColumn("part", F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int"))
    other = F.sequence(F.lit(0), F.col("parts") - 1)
    tiles = members.select(
        "fingerprint", "key", "part",
        F.explode(other).alias("with"),
    ).select(
        "fingerprint", "key", F.least("part", "with").alias("a"), F.greatest("part", "with").alias("b"), "part"
    )
    masks = [sum(1 << b for b in table) for table in tables]

    def count(table: pa.Table) -> pa.Table:
        names = table.column("fingerprint").to_pylist()
        parts = table.column("part").to_numpy()
        first = masks[int(table.column("key")[0].as_py().partition(":")[0])]
        earlier = masks[: masks.index(first)]
        raw = np.frombuffer(b"".join(map(bytes.fromhex, names)), np.uint8).reshape(len(names), BITS // 8)
        lanes = raw.view(np.uint64)
        own = int(table.column("a")[0].as_py()) == int(table.column("b")[0].as_py())
        n_near = np.zeros(len(names), np.int64)
        for k in range(len(names)):
            rest = np.arange(len(names)) > k if own else parts > parts[k]
            differ = lanes[rest] ^ lanes[k]
            near = np.bitwise_count(differ).sum(1) <= radius
            if near.any():
                at = np.flatnonzero(rest)[near]
                same = (raw[at].reshape(len(at), blocks, -1) == raw[k].reshape(1, blocks, -1)).all(2)
                mine = (same << np.arange(blocks)).sum(1)
                new = np.ones(len(at), bool)
                for mask in earlier:
                    new &= (mine & mask) != mask
                n_near[k] += new.sum()
                n_near[at[new]] += 1
        some = n_near > 0
        found = [pa.array(np.array(names, object)[some], pa.string()), pa.array(n_near[some])]
        return pa.Table.from_arrays(found, names=["fingerprint", "n_near"])

    counted = tiles.groupBy("key", "a", "b").applyInArrow(count, "fingerprint string, n_near long")
    return counted.groupBy("fingerprint").agg(F.sum("n_near").alias("n_near"))


def sampled_bits(n: int, radius: int = NEAR, recall: float = RECALL, group: int = SAMPLED_GROUP) -> np.ndarray:
    """Bit positions (tables x bits) of the keys of ``n`` fingerprints, for searches that may miss pairs.

    No query uses them, as what they find depends on ``n``.
    Bits are added until about ``group`` fingerprints share a key, tables until a pair at ``radius``
    agrees on all bits of some table with probability ``recall``. Up to ``group`` fingerprints are in
    one table without a key, so all their pairs are compared.
    """
    bits = max(0, math.ceil(math.log2(max(n, 1) / group)))
    meet = math.comb(BITS - radius, bits) / math.comb(BITS, bits)
    tables = 1 if meet == 1 else math.ceil(math.log(1 - recall) / math.log(1 - meet))
    rng = np.random.default_rng(128)
    return np.array([np.sort(rng.permutation(BITS)[:bits]) for _ in range(tables)], np.int64).reshape(tables, bits)


def _cover() -> np.ndarray:
    """Bits of a block that each of its tables is keyed by, as 32-bit masks.

    Every bit has a vector of ``_BLOCK_ERRORS + 1`` binary places, and each vector ``v`` but zero is a table that
    keeps the bits whose vectors have an odd product with ``v``. Some ``v`` has even products with any
    ``_BLOCK_ERRORS`` vectors, so two blocks that differ in so many bits agree on all that its table keeps.
    """
    v = np.arange(1, 1 << (_BLOCK_ERRORS + 1), dtype=np.uint32)
    kept = np.bitwise_count(v[:, None] & _VECTORS) & 1
    return (kept.astype(np.uint32) << np.arange(32, dtype=np.uint32)).sum(1, dtype=np.uint32)


def _near_by_tables(left: np.ndarray, right: np.ndarray, radius: int) -> np.ndarray | None:
    """Sorted places ``x * len(right) + y`` of all pairs within ``radius`` bits, by the tables of all blocks.

    None if the pairs that share a key would take longer than a comparison of all pairs, as in large groups of
    near copies, or if ``radius`` is beyond what the tables find.
    """
    if radius >= COVER_BLOCKS * (_BLOCK_ERRORS + 1):
        return None
    spare = len(left) * len(right) // 4
    blocks = [np.ascontiguousarray(side.view(np.uint32).T) for side in (left, right)]
    l0, l1 = np.ascontiguousarray(left.T)
    r0, r1 = np.ascontiguousarray(right.T)
    found, size = [np.zeros(0, np.int64)], 0
    for k in range(COVER_BLOCKS):
        for mask in _cover():
            # Masked bits are mixed to 16: unlike ones may meet, and like ones always do.
            own, other = (((b[k] & mask) * np.uint32(0x9E3779B1) >> np.uint32(16)).astype(np.uint16) for b in blocks)
            order = np.argsort(other, kind="stable")
            sizes = np.bincount(other, minlength=1 << 16)
            n = sizes[own]
            upto = np.cumsum(n)
            spare -= int(upto[-1])
            if spare < 0:
                return None
            # Member ``i`` of all pairs of this table is member ``i + shift`` of the other side in key order.
            shift = (np.cumsum(sizes) - sizes)[own] - upto + n
            s0, s1 = r0[order], r1[order]
            cuts = [*np.searchsorted(upto, np.arange(0, int(upto[-1]), _PAIRS), "right").tolist(), len(left)]
            for a, z in zip(cuts, cuts[1:]):
                x = np.repeat(np.arange(a, z), n[a:z])
                y = np.arange(len(x)) + (upto[a] - n[a] if a < z else 0) + shift[x]
                near = np.flatnonzero(np.bitwise_count(l0[x] ^ s0[y]) + np.bitwise_count(l1[x] ^ s1[y]) <= radius)
                if len(near):
                    found.append(x[near] * len(right) + order[y[near]])
                    size += len(near)
            if size > _HELD:
                found = [np.unique(np.concatenate(found))]
                size = len(found[0])
                if size > _HELD // 2:
                    return None
    return np.unique(np.concatenate(found))


def _near_by_all(left: np.ndarray, right: np.ndarray, radius: int) -> Iterator[np.ndarray]:
    """Places of all pairs within ``radius`` bits, every pair compared."""
    r0, r1 = np.ascontiguousarray(right.T)
    step = max(1, _PAIRS // max(len(right), 1))
    for k in range(0, len(left), step):
        part = left[k : k + step]
        apart = np.bitwise_count(part[:, :1] ^ r0)
        apart += np.bitwise_count(part[:, 1:] ^ r1)
        near = np.flatnonzero(apart.ravel() <= radius)
        if len(near):
            yield near + k * len(right)


def _near_in_tile(lanes: np.ndarray, parts: np.ndarray, own: bool, radius: int, few: int = FEW) -> Iterator[tuple]:
    """(i, j, distance) arrays of all near pairs of a tile, each pair once.

    Tiles of up to ``few`` pairs, for which the tables cost more than they save, are compared whole.
    """
    low = parts == parts.min()
    i, j = (np.arange(len(lanes)),) * 2 if own else (np.flatnonzero(low), np.flatnonzero(~low))
    if not len(i) or not len(j):
        return
    left, right = lanes[i], lanes[j]
    listed = _near_by_tables(left, right, radius) if len(i) * len(j) > few else None
    for places in _near_by_all(left, right, radius) if listed is None else [listed]:
        x, y = np.divmod(places, len(j))
        if own:
            x, y = x[x < y], y[x < y]
        if len(x):
            yield i[x], j[y], np.bitwise_count(left[x] ^ right[y]).sum(1)


def near_tiles(classes: DataFrame, group: int = GROUP):
    """Fingerprints grouped by pairs of parts, so that any two meet in one tile.

    ``classes`` needs distinct ``fingerprint`` and its ``class_id``; it is read more than once. Parts hold about
    ``group`` fingerprints, or fewer if there would be less than ``LEAST_PARTS``; what is found does not depend on them.
    """
    n = classes.count()
    parts = max(1, math.ceil(n / group), min(LEAST_PARTS, n // SMALL))

    def deal(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw = np.frombuffer(b"".join(map(bytes.fromhex, batch.column(0).to_pylist())), np.int64).reshape(-1, WORDS)
        columns = [*(pa.array(np.ascontiguousarray(c)) for c in raw.T), batch.column(1)]
        return pa.RecordBatch.from_arrays(columns, names=["f0", "f1", "class_id"])

    marks = classes.select("fingerprint", F.col("class_id").cast("long"))
    rows = map_batches(marks, deal, "f0 long, f1 long, class_id long")
    members = rows.withColumn("part", F.pmod(F.xxhash64("f0", "f1"), F.lit(parts)).cast("int"))
    tiles = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).select(
        "f0", "f1", "class_id", "part", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b")
    )
    return tiles.groupBy("a", "b")


def _tile(table: pa.Table, radius: int, few: int) -> tuple[np.ndarray, Iterator[tuple]]:
    lanes = np.stack([table.column(c).to_numpy() for c in ("f0", "f1")], 1).view(np.uint64)
    parts = table.column("part").to_numpy()
    own = table.column("a")[0].as_py() == table.column("b")[0].as_py()
    return lanes, _near_in_tile(lanes, parts, own, radius, few)


def _hex(lanes: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes().hex() for r in lanes], pa.string())


def near_counts(classes: DataFrame, radius: int = NEAR, group: int = GROUP, few: int = FEW) -> DataFrame:
    """Fingerprints with others within ``radius`` bits, and the number of all these others. No pairs are listed."""
    tiles = near_tiles(classes, group)

    def count(table: pa.Table) -> pa.Table:
        lanes, found = _tile(table, radius, few)
        n_near = np.zeros(len(lanes), np.int64)
        for x, y, _ in found:
            n_near += np.bincount(x, minlength=len(lanes)) + np.bincount(y, minlength=len(lanes))
        some = n_near > 0
        return pa.table({"fingerprint": _hex(lanes[some]), "n_near": n_near[some]})

    return tiles.applyInArrow(count, "fingerprint string, n_near long").groupBy("fingerprint").agg(F.sum("n_near").alias("n_near"))


def near_pairs(classes: DataFrame, radius: int = NEAR, group: int = GROUP, few: int = FEW) -> DataFrame:
    """Every pair of classes within ``radius`` bits once, with representatives and distance."""
    tiles = near_tiles(classes, group)

    def pairs(table: pa.Table) -> pa.Table:
        lanes, found = _tile(table, radius, few)
        found = [*found] or [(np.zeros(0, np.int64),) * 3]
        x, y, distance = (np.concatenate(c) for c in zip(*found, strict=True))
        ids = table.column("class_id").combine_chunks()
        columns = [ids.take(pa.array(x)), ids.take(pa.array(y)), _hex(lanes[x]), _hex(lanes[y]), pa.array(distance.astype(np.int32))]
        return pa.table(columns, names=["a", "b", "fingerprint_a", "fingerprint_b", "distance"])

    schema = "a long, b long, fingerprint_a string, fingerprint_b string, distance int"
    listed = tiles.applyInArrow(pairs, schema)
    swap = F.coalesce(F.col("a") > F.col("b"), F.col("a").isNull() & F.col("b").isNotNull())
    ends = [F.when(swap, F.col(y)).otherwise(F.col(x)).alias(x) for x, y in (("a", "b"), ("b", "a"))]
    ends += [F.when(swap, F.col(f"fingerprint_{y}")).otherwise(F.col(f"fingerprint_{x}")).alias(f"fingerprint_{x}") for x, y in ("ab", "ba")]
    return listed.select(*ends, "distance")


def classes_of(fingerprinted: DataFrame) -> DataFrame:
    """One class per fingerprint: its smallest id and its number of rows."""
    own = fingerprinted.where("fingerprint is not null").groupBy("fingerprint")
    return pin(own.agg(F.min("doc_id").alias("class_id"), F.count("*").alias("n_copies")), "simhash-classes")


def with_near(fingerprinted: DataFrame) -> DataFrame:
    """Fingerprinted documents with their class and ``n_near``, the number of other classes within ``NEAR`` bits.

    Texts with one fingerprint are a class of ``n_copies`` rows, and ``class_id`` is its smallest id.
    """
    pinned = pin(fingerprinted, "fingerprints")
    classes = classes_of(pinned)
    named = classes.join(near_counts(classes), "fingerprint", "left")
    extra = F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "class_id", "n_copies"
    return pinned.join(named, "fingerprint", "left").select(*pinned.columns, *extra)


def near_documents(docs: DataFrame) -> DataFrame:
    """Pairs of near classes of the documents; ``with_near`` names the class of each document."""
    marks = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    def mark(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = pa.array([fingerprint(t).hex() for t in batch.column(1).to_pylist()], pa.string())
        return pa.RecordBatch.from_arrays([batch.column(0), found], names=["doc_id", "fingerprint"])

    return near_pairs(classes_of(map_batches(marks, mark, "doc_id long, fingerprint string", piecewise=True)))
