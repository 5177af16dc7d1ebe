"""Near duplicates by the Jaccard similarity of word shingles, joined in signature trees.

A set whose tokens are mostly its own cannot be linked; one exchange of half of all tokens, packed, finds most
of these, and one of all tokens of the sets that are left finds the rest. Of the others, sets that share none of their rarest tokens cannot be similar enough. Chains through such
tokens give coarse groups, and every link lies inside one of them. Over many sets chance ties unrelated sets
into one group, so groups that are too large for one task are split by parity sketches, whose distance is
at most the number of tokens in which two sets differ. Each group is joined exactly in a tree.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewatch.llm.common import SPACES, mix64, pieces_of, pin, shingle_hashes, word_hashes
from scorewatch.llm.components import components
from scorewatch.llm.signature_tree import join_groups

SHINGLE = 5
PERCENT = 75
#: Buckets of the token counts that order tokens from rare to frequent.
COUNTERS = 1 << 20
SLICES = 16
#: Tokens that a set sends to the comparison beyond those that a link may leave unshared, in percent of its size.
SPARE = 25
#: Tokens of the sets that one task joins together. Larger groups are dealt into tiles.
BLOCK_TOKENS = 2_000_000
#: Sets, and blocks of tokens, whose sketches one task compares. A sketch is about 50 times smaller than its text.
SKETCH_SETS = 1 << 15
SKETCH_BLOCKS = 32

_UPPER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPLIT = bytes.maketrans(SPACES.encode(), b" " * len(SPACES))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted hashes of the different shingles of a text in lower case (A-Z only)."""
    words = [w for w in (text or "").encode().translate(_UPPER).translate(_SPLIT).split(b" ") if w]
    return np.unique(shingle_hashes(word_hashes(words), SHINGLE))


def token_counts(docs: DataFrame) -> np.ndarray:
    """How often the tokens of each bucket occur, over all given texts.

    A task adds up its documents in an array of fixed size and sends it in slices; only the sum of
    ``COUNTERS`` numbers reaches the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for text in batch.column(0):
                at = (shingle_set(text.as_py()) >> np.uint64(20)) % np.uint64(COUNTERS)
                total += np.bincount(at.astype(np.int64), minlength=COUNTERS) if len(at) > 50_000 else 0
                if len(at) <= 50_000:
                    np.add.at(total, at.astype(np.int64), 1)
        if total.any():
            packer = zstandard.ZstdCompressor(level=1)
            parts = [packer.compress(p.astype(np.uint32).tobytes()) for p in np.split(total, SLICES)]
            yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array(parts, pa.binary())], names=["slice", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(COUNTERS // SLICES, np.uint32)
        for part in table.column("counts"):
            total += np.frombuffer(zstandard.decompress(part.as_py()), np.uint32)
        return pa.table({"slice": table.column("slice")[:1], "counts": pa.array([zstandard.compress(total.tobytes(), 1)], pa.binary())})

    sent = docs.select("text").mapInArrow(count, "slice int, counts binary")
    rows = sent.groupBy("slice").applyInArrow(add, "slice int, counts binary").collect()
    out = np.zeros((SLICES, COUNTERS // SLICES), np.uint32)
    for row in rows:
        out[row["slice"]] = np.frombuffer(zstandard.decompress(bytes(row["counts"])), np.uint32)
    return out.ravel()


def prefix_length(size: int, percent: int = PERCENT) -> int:
    """Tokens, in one order for all sets, of which two linked sets must share one."""
    return size - math.ceil(percent * size / 100) + 1


def sent_length(size: int, percent: int = PERCENT) -> int:
    """Tokens, the smallest of a set, that are compared with those of the other sets."""
    return min(size, prefix_length(size, percent) - 1 + math.ceil(SPARE * size / 100))


def identity(tokens: np.ndarray) -> tuple[int, int]:
    """128-bit identity of a set, in two signed numbers."""
    marks = mix64(tokens), mix64(tokens ^ np.uint64(0x5851F42D4C957F2D))
    return tuple(int(m.sum().astype(np.int64)) if len(m) else 0 for m in marks)


def text_mark(docs: DataFrame):
    """Hash that tells the texts of one id apart."""
    return F.xxhash64(docs["text"])


def sets_table(docs: DataFrame) -> DataFrame:
    """Size and identity of each document's set, and the mark of its text."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(text.as_py()) for text in batch.column(1)]
            first, second = zip(*map(identity, sets), strict=True) if sets else ((), ())
            columns = [batch.column(0), *(pa.array(c, pa.int64()) for c in (map(len, sets), first, second)), batch.column(2)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "s1", "s2", "mark"])

    rows = docs.select("doc_id", "text", text_mark(docs).alias("mark"))
    return rows.mapInArrow(measure, "doc_id long, n_shingles long, s1 long, s2 long, mark long")


def packed_tokens(docs: DataFrame, parts: int, percent: int = PERCENT, whole: bool = False) -> DataFrame:
    """(part, blob) rows: tokens dealt by hash, four bytes each, with the sets that they belong to.

    With many parts nearly every token brings the eight bytes of its set along, so only the tokens that
    decide are sent: the smallest of each set, ``sent_length`` of them, or all if ``whole``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            sets: dict[int, np.ndarray] = {}
            for text in batch.column("text"):
                tokens = shingle_set(text.as_py())
                if len(tokens):
                    sets[identity(tokens)[0]] = tokens if whole else tokens[: sent_length(len(tokens), percent)]
            if not sets:
                continue
            nodes = np.fromiter(sets, np.int64, len(sets))
            sizes = np.fromiter(map(len, sets.values()), np.int64, len(sets))
            tokens, owner = np.concatenate([*sets.values()]), np.repeat(np.arange(len(nodes)), sizes)
            part = ((tokens >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            tokens, owner = tokens[order].astype(np.uint32), owner[order]
            cuts = np.searchsorted(part[order], np.arange(parts + 1))
            out = []
            for k in range(parts):
                a, b = cuts[k], cuts[k + 1]
                if b > a:
                    own, counts = np.unique(owner[a:b], return_counts=True)
                    head = np.array([len(own), b - a], np.int64).tobytes()
                    data = head + nodes[own].tobytes() + counts.astype(np.uint32).tobytes() + tokens[a:b].tobytes()
                    out.append((k, data))
            columns = [pa.array([k for k, _ in out], pa.int32()), pa.array([d for _, d in out], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "blob"])

    return docs.select("text").mapInArrow(run, "part int, blob binary")


def shared_counts(packed: DataFrame, parts: int) -> DataFrame:
    """(s1, shared): how many tokens that a set sends another set sends too, at least.

    Tokens are compared by their part and 32 more bits; a rare false match only keeps a set longer.
    """

    def share(table: pa.Table) -> pa.Table:
        tokens, owners = [], []
        for blob in table.column("blob"):
            data = blob.as_py()
            n, size = np.frombuffer(data, np.int64, 2)
            nodes = np.frombuffer(data, np.int64, n, 16)
            owners.append(np.repeat(nodes, np.frombuffer(data, np.uint32, n, 16 + 8 * n)))
            tokens.append(np.frombuffer(data, np.uint32, size, 16 + 12 * n))
        nodes, owner = np.unique(np.concatenate(owners), return_inverse=True)
        pairs = np.unique((np.concatenate(tokens).astype(np.uint64) << np.uint64(32)) | owner.astype(np.uint64))
        token = pairs >> np.uint64(32)
        same = np.zeros(len(pairs), bool)
        same[1:] = token[1:] == token[:-1]
        same[:-1] |= same[1:]
        counts = np.bincount((pairs[same] & np.uint64(0xFFFFFFFF)).astype(np.int64), minlength=len(nodes))
        kept = counts > 0
        nodes, counts = nodes[kept], counts[kept]
        to = (nodes.view(np.uint64) % np.uint64(parts)).astype(np.int64)
        out = [(k, nodes[to == k].tobytes() + counts[to == k].astype(np.uint32).tobytes()) for k in np.unique(to).tolist()]
        return pa.table({"part": pa.array([k for k, _ in out], pa.int32()), "blob": pa.array([d for _, d in out], pa.binary())})

    def add(table: pa.Table) -> pa.Table:
        nodes, counts = [], []
        for blob in table.column("blob"):
            data = blob.as_py()
            nodes.append(np.frombuffer(data, np.int64, len(data) // 12))
            counts.append(np.frombuffer(data, np.uint32, len(data) // 12, 8 * (len(data) // 12)))
        node, at = np.unique(np.concatenate(nodes), return_inverse=True)
        total = np.bincount(at, np.concatenate(counts)).astype(np.int64)
        return pa.table({"s1": node, "shared": total})

    found = packed.groupBy("part").applyInArrow(share, "part int, blob binary")
    return found.groupBy("part").applyInArrow(add, "s1 long, shared long")


def candidate_texts(docs: DataFrame, classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One text (s1, n_shingles, text) of each set that shares enough tokens for a link.

    Linked sets share ``least`` tokens or more, and neither is smaller than that. Of two linked sets take
    the one whose sent tokens end first: up to there the other set sends all that both have, and behind
    there lie no more tokens than a link may leave unshared. So both send the spare tokens of that set, at
    least, in common. What is left is counted again with all tokens. The text is fetched by id and mark, as
    an id may stand on other texts too.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = shared_counts(packed_tokens(docs.where("doc_id is not null"), parts, percent), parts)
    least = f"(({percent} * n_shingles + 99) div 100)"
    enough = F.expr(f"shared >= ({min(SPARE, percent)} * {least} + 99) div 100")
    alive = classes.join(counts, "s1").where(enough).select("rep", "mark", "s1", "n_shingles")
    texts = docs.where("doc_id is not null").select(F.col("doc_id").alias("rep"), text_mark(docs).alias("mark"), "text")
    found = pin(alive.join(texts, ["rep", "mark"]).select("s1", "n_shingles", "text"), "jaccard-half")
    counts = shared_counts(packed_tokens(found, parts, percent, whole=True), parts)
    still = counts.join(found.select("s1", "n_shingles").distinct(), "s1").where(F.expr(f"shared >= {least}")).select("s1")
    return pin(found.join(still, "s1", "left_semi"), "jaccard-candidates")


def prefix_rows(candidates: DataFrame, counts: np.ndarray, percent: int = PERCENT) -> DataFrame:
    """(token, s1) rows of each candidate's rarest tokens."""
    order = np.minimum(counts, 65535).astype(np.uint16)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, nodes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for text, node in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                tokens = shingle_set(text.as_py())
                rank = order[((tokens >> np.uint64(20)) % np.uint64(COUNTERS)).astype(np.int64)]
                rare = np.lexsort((tokens, rank))[: prefix_length(len(tokens), percent)]
                out.append(tokens[rare].view(np.int64))
                nodes.append(np.full(len(rare), node))
            columns = [pa.array(np.concatenate(out)), pa.array(np.concatenate(nodes))]
            yield pa.RecordBatch.from_arrays(columns, names=["token", "s1"])

    return candidates.select("text", "s1").mapInArrow(pick, "token long, s1 long")


def candidate_edges(rows: DataFrame) -> DataFrame:
    """Edges (a, b) between sets that follow each other in the list of a prefix token.

    Rows are dealt in ranges of (token, set), so the list of a frequent token spreads over tasks. Each
    task sends its first and last row along, and the lists that go on in the next task are tied
    together on the driver, two rows per task.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, "token", "s1").sortWithinPartitions("token", "s1")

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["end", "token", "a", "b"]
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            token, node = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(2))
            if last is None:
                out = [[1], [int(token[0])], [int(node[0])], [int(node[0])]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=names)
            else:
                token, node = np.concatenate([[last[0]], token]), np.concatenate([[last[1]], node])
            tied = (token[1:] == token[:-1]) & (node[1:] != node[:-1])
            pairs = np.unique(np.stack([node[:-1][tied], node[1:][tied]], 1), axis=0)
            last = token[-1], node[-1]
            if len(pairs):
                zero = np.zeros(len(pairs), np.int64)
                columns = [pa.array(c) for c in (zero, zero, *np.ascontiguousarray(pairs.T))]
                yield pa.RecordBatch.from_arrays(columns, names=names)
        if last is not None:
            out = [[1], [int(last[0])], [int(last[1])], [int(last[1])]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=names)

    found = pin(dealt.mapInArrow(chain, "end long, token long, a long, b long"), "jaccard-edges")
    ends = sorted((r["token"], r["a"]) for r in found.where("end = 1").select("token", "a").collect())
    tied = [(x[1], y[1]) for x, y in zip(ends, ends[1:]) if x[0] == y[0] and x[1] != y[1]]
    edges = found.where("end = 0").select("a", "b").distinct()
    if tied:
        edges = edges.union(rows.sparkSession.createDataFrame(tied, "a long, b long"))
    return edges


def _tree_links(table: pa.Table, percent: int) -> pa.Table:
    """Links that tie the sets of a task together, group by group: each set with its group's first."""
    groups = table.column("piece").to_pylist()
    nodes = table.column("s1").to_pylist()
    texts = table.column("text")
    by_group: dict[str, dict[int, int]] = {}
    for k, group in enumerate(groups):
        by_group.setdefault(group, {})[nodes[k]] = k
    a, b = [], []
    for group in by_group.values():
        rows = [group[node] for node in sorted(group)]
        first = join_groups([shingle_set(texts[k].as_py()) for k in rows], percent)
        for k, root in zip(rows, first, strict=True):
            if nodes[k] != nodes[rows[root]]:
                a.append(nodes[k])
                b.append(nodes[rows[root]])
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def parity_sketch(tokens: np.ndarray, words: int) -> bytes:
    """For each of ``64 * words`` bits, whether the set has an odd number of the tokens that fall on it."""
    at = (tokens % np.uint64(64 * words)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=64 * words) & 1).astype(np.uint8), bitorder="little").tobytes()


def _possible_ties(table: pa.Table, percent: int) -> pa.Table:
    """Ties (a, b) of a task's sets: each set with the first of those that it reaches by possible links.

    Of every pair the smaller set is in the band ``low``; the two parts of a piece are only compared with
    each other, as each has a piece of its own. Sets that are tied already are not compared again.
    """
    node, first = np.unique(table.column("s1").to_numpy(), return_index=True)
    size, band, part = (table.column(c).to_numpy()[first] for c in ("n_shingles", "band", "part"))
    order = np.argsort(size, kind="stable")
    node, size, band, part, first = node[order], size[order], band[order], part[order], first[order]
    bits = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint64).reshape(table.num_rows, -1)[first]
    two = len(np.unique(part)) > 1
    ends = np.searchsorted(size, size * 100 // percent, "right")
    label = np.arange(len(node))
    for i in np.flatnonzero(band == table.column("low")[0].as_py()).tolist():
        at = slice(i + 1, ends[i])
        open_ = label[at] != label[i]
        if two:
            open_ &= part[at] != part[i]
        others = np.flatnonzero(open_) + i + 1
        both = size[others] + size[i]
        differ = both - 2 * (-(-percent * both // (100 + percent)))
        found = others[np.bitwise_count(bits[others] ^ bits[i]).sum(1, dtype=np.int64) <= differ]
        if len(found):
            label[np.isin(label, label[found])] = label[i]
    _, least, at = np.unique(label, return_index=True, return_inverse=True)
    a, b = node, node[least[at]]
    return pa.table({"a": pa.array(a[a != b], pa.int64()), "b": pa.array(b[a != b], pa.int64())})


def split_groups(large: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(s1, root) of the groups that possible links leave of the given ones; sets without any are left out.

    ``large`` has s1, n_shingles, root, and the tokens and sets of the root's group. Only sketches are dealt
    into tiles. Two linked sets lie in one band of sizes or in neighbouring ones, and a set has a sketch for
    its band and one for the band below, as wide as the sets that meet there are large.
    """
    step = math.log(100 / percent)
    tasks = F.greatest(F.col("tokens") / (SKETCH_BLOCKS * BLOCK_TOKENS), F.col("sets") / SKETCH_SETS)
    rows = large.join(texts.select("s1", "text"), "s1").select(
        "s1", "n_shingles", "root", F.floor(F.log("n_shingles") / step).cast("int").alias("band"),
        F.ceil(2 * tasks).cast("int").alias("parts"), "text",
    )

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            sets = [shingle_set(text.as_py()) for text in batch.column("text")]
            bands = batch.column("band").to_pylist()
            for below in (1, 0):
                lows = [band - below for band in bands]
                words = [math.ceil((100 / percent) ** (low + 2) / 64) for low in lows]
                made = [parity_sketch(tokens, n) for tokens, n in zip(sets, words, strict=True)]
                columns = [*batch.columns[:-1], pa.array(lows, pa.int32()), pa.array(made, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["s1", "n_shingles", "root", "band", "parts", "low", "sketch"])

    made = rows.mapInArrow(sketch, "s1 long, n_shingles long, root long, band int, parts int, low int, sketch binary")
    tiles = (
        made.withColumn("part", F.pmod(F.xxhash64("s1"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumn("piece", F.concat_ws(":", "root", "low", F.least("part", "other"), F.greatest("part", "other")))
        .select("piece", "s1", "n_shingles", "band", "part", "low", "sketch")
    )
    work = lambda table: _possible_ties(table, percent)
    ties = tiles.groupBy("piece").applyInArrow(work, "a long, b long")
    return components(ties, "jaccard-split").withColumnRenamed("node", "s1")


def link_classes(docs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Classes of equal sets (s1, s2, rep and the mark of its text) and the links (a, b) that tie their s1 together."""
    classes = pin(
        sets.where("n_shingles > 0 and doc_id is not null")
        .groupBy("s1", "s2", "n_shingles")
        .agg(F.min(F.struct("doc_id", "mark")).alias("least"))
        .select("s1", "s2", "n_shingles", F.col("least.doc_id").alias("rep"), "least.mark"),
        "jaccard-classes",
    )
    texts = candidate_texts(docs, classes, percent)
    edges = candidate_edges(prefix_rows(texts, token_counts(texts), percent))
    coarse = components(edges, "jaccard-coarse").withColumnRenamed("node", "s1")
    members = pin(texts.select("s1", "n_shingles").distinct().join(coarse, "s1").select("s1", "root", "n_shingles"), "jaccard-members")
    counted = [F.sum("n_shingles").alias("tokens"), F.count("*").alias("sets")]
    sizes = members.groupBy("root").agg(*counted)
    if (sizes.agg(F.max("tokens")).first()[0] or 0) > BLOCK_TOKENS:
        sized = members.join(sizes, "root")
        large = sized.where(F.col("tokens") > BLOCK_TOKENS)
        split = split_groups(large, texts, percent).join(large.select("s1", "n_shingles"), "s1")
        fitting = sized.where(F.col("tokens") <= BLOCK_TOKENS).select("s1", "root", "n_shingles")
        members = pin(fitting.union(split.select("s1", "root", "n_shingles")), "jaccard-members")
        sizes = members.groupBy("root").agg(*counted)
    total = sizes.agg(F.sum("tokens")).first()[0] or 0
    blocks = max(1, math.ceil(4 * total / BLOCK_TOKENS))
    sized = members.join(sizes, "root")
    # A group that fits is one piece. A larger one is cut by the size of its sets and then by hash, and
    # every two parts whose sizes allow a link form a piece.
    small = sized.where(F.col("tokens") <= BLOCK_TOKENS).select(
        "s1", F.concat(F.lit("g"), "root").alias("piece"), F.pmod(F.xxhash64("root"), F.lit(blocks)).alias("block")
    )
    parts = F.ceil(2 * F.col("tokens") / BLOCK_TOKENS).cast("int")
    step = math.log(100 / percent)
    band = F.floor(F.log("n_shingles") / step).cast("int")
    tiles = (
        sized.where(F.col("tokens") > BLOCK_TOKENS)
        .select("s1", "root", band.alias("band"), parts.alias("parts"))
        .withColumn("part", F.pmod(F.xxhash64("s1"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumn("low", F.explode(F.array(F.col("band") - 1, F.col("band"))))
        .select(
            "s1",
            F.concat_ws(
                ":", F.concat(F.lit("t"), "root"), "low", F.least("part", "other"), F.greatest("part", "other")
            ).alias("piece"),
        )
        .select("s1", "piece", F.xxhash64("piece").alias("block"))
    )
    pieces = small.union(tiles)
    given = pieces.join(texts.select("s1", "text"), "s1")
    work = lambda table: _tree_links(table, percent)
    return classes, given.groupBy("block").applyInArrow(work, "a long, b long")


def near_rows(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Rows of ``near_duplicates`` with the mark of their text."""
    sets = pin(sets_table(docs), "jaccard-sets")
    classes, links = link_classes(docs, sets, percent)
    roots = components(links, "jaccard-links").withColumnRenamed("node", "s1")
    least = classes.join(roots, "s1").groupBy("root").agg(F.min("rep").alias("first"))
    named = classes.join(roots.join(least, "root"), "s1", "left").select(
        "s1", "s2", F.coalesce("first", "rep").alias("component_id")
    )
    rows = sets.select("doc_id", "n_shingles", "s1", "s2", "mark")
    joined = rows.where("n_shingles > 0 and doc_id is not null").join(named, ["s1", "s2"])
    alone = rows.where("n_shingles = 0 or doc_id is null").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", "n_shingles", "component_id", "mark"]
    return joined.select(*columns).union(alone.select(*columns))


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Size of each document's set and the smallest id that it reaches by links.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. Two documents are linked when
    their sets of five-word shingles have a Jaccard similarity of ``percent`` or more; a shorter text
    is one shingle, NULL or blank texts have none and stay alone. Equal sets are one class, so copies
    are not compared. Rows with a repeated id stay rows, and each is linked by its own text; a NULL id
    is linked with nothing and its ``component_id`` is NULL. An empty table gives no rows.
    """
    return near_rows(docs, percent).drop("mark")


def keep_first(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id, as it was.

    Rows of one id stay or go by their own text; if a group's smallest id has several rows in it, all
    of these stay. Rows without a shingle or an id all stay.
    """
    found = near_rows(docs.select("doc_id", "text"), percent).where("doc_id <> component_id")
    gone = found.select(F.col("doc_id").alias("gone_id"), F.col("mark").alias("gone_mark")).distinct()
    same = (docs["doc_id"] == gone["gone_id"]) & (text_mark(docs) == gone["gone_mark"])
    return docs.join(gone, same, "left_anti").select(*docs.columns)
