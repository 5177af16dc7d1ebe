"""Text operators against brute force, exact libraries and odd input."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from scorewatch.llm import (
    bpe,
    components,
    extraction,
    grams,
    html_blocks,
    jaccard_join,
    langid,
    packing,
    quality,
    queries,
    resampling,
    signature_tree,
    simhash,
    suffix_array,
    suffix_dedup,
    toxicity,
)

ODD = "doc_id long, text string, lang string, source string, n_chars long, part string, blob string"
LONG = " ".join(f"w{k % 977}x{k % 31}" for k in range(30_000))


@pytest.fixture(scope="module")
def odd(spark):
    """NULLs, blanks, copies, a very long text, repeated rows and ids, and columns with clashing names."""
    same = "the same twelve words are in this text and in its copy too"
    rows = [
        (1, same, "en"), (2, same, "en"), (2, same, "en"), (3, None, None), (4, "", "en"), (5, " \n\t ", "de"),
        (6, LONG, "en"), (7, LONG + " end", None), (None, same, "fr"), (8, "kurz", "de"), (9, same + " now", "en"),
    ]
    return spark.createDataFrame([(i, t, la, "s", len(t or ""), "p", "b") for i, t, la in rows], ODD)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (2, 1, 1), (3, 0, 1), (None, 1, 1), (6, None, None), (8, 0, 0)], "doc_id long, quality int, toxic int"
    )


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(5)
    for n in [0, 1, 2, 7, 30, 200]:
        for symbols in (1, 2, 4, 200):
            text = np.concatenate([rng.integers(1, symbols + 1, n), [0]]).astype(np.int64)
            items = text.tolist()
            order = suffix_array.suffix_array(text, int(text.max()) + 1)
            assert order.tolist() == sorted(range(n + 1), key=lambda i: items[i:])
            prefix = suffix_array.common_prefixes(text, order)
            for a, b in zip(order[:-1].tolist(), order[1:].tolist()):
                k = 0
                while max(a, b) + k <= n and items[a + k] == items[b + k]:
                    k += 1
                assert prefix[b] == k


def removed_by_force(rows):
    out, seen = {}, {}
    for doc_id, text in sorted(rows):
        data = text.encode()
        gone = np.zeros(len(data), bool)
        mine = [data[k : k + 50] for k in range(len(data) - 49)]
        for k, window in enumerate(mine):
            if seen.get(window, doc_id) < doc_id:
                gone[k : k + 50] = True
        for window in mine:
            seen.setdefault(window, doc_id)
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[doc_id] = (len(data), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("shard", [1 << 20, 300])
def test_repeated_strings(spark, monkeypatch, shard):
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", shard)
    rng = random.Random(3)
    words = ["alpha", "béta", "gamma", "delta", "the", "of", "and", "ü"]
    passages = [" ".join(rng.choices(words, k=rng.randint(5, 40))) for _ in range(12)]
    rows = []
    for k in range(120):
        rows.append((k * 7 - 300, " ".join(rng.choice(passages) if rng.random() < 0.4 else rng.choice(words) for _ in range(rng.randint(0, 25)))))
    rows += [(1000, "x" * 49), (1001, "x" * 49), (1002, "y" * 50), (1003, "y" * 5000), (1004, "")]
    found = by_id(suffix_dedup.dedupe_bytes(spark.createDataFrame(rows, "doc_id long, text string")))
    assert {k: tuple(r)[1:] for k, r in found.items()} == removed_by_force(rows)


@pytest.mark.parametrize("shard", [1 << 20, 300])
def test_texts_without_repeats(spark, monkeypatch, shard):
    """Cut texts have the digests of the byte form; columns that clash with inner names stay."""
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", shard)
    shared = "the same passage of more than fifty bytes stands in many documents " * 2
    rows = [(k, f"{k} own start {k * k} " + shared[k % 9 :] + f" own end {k}", 5, f"a{k}", k, None) for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars int, a string, row long, doc string")
    found = suffix_dedup.without_repeats(docs)
    assert found.schema.simpleString() == docs.schema.simpleString()
    expected = removed_by_force([r[:2] for r in rows])
    for r in found.collect():
        assert hashlib.sha256(r["text"].encode()).hexdigest() == expected[r["doc_id"]][3]
        assert r["n_chars"] == (len(r["text"]) if expected[r["doc_id"]][1] else 5)
        assert (r["a"], r["row"], r["doc"]) == (f"a{r['doc_id']}", r["doc_id"], None)


def test_repeated_strings_odd(odd):
    rows = suffix_dedup.dedupe_bytes(odd).collect()
    assert len(rows) == odd.count()
    found = {r["doc_id"]: r for r in rows}
    assert found[None]["n_removed"] == 0 and found[3]["n_bytes"] == 0 and found[1]["n_removed"] == 0
    assert found[2]["n_removed"] == found[2]["n_bytes"] and found[7]["n_removed"] >= len(LONG)
    assert suffix_dedup.without_repeats(odd).columns == odd.columns


def test_components(spark):
    edges = [(k, k + 1) for k in range(1, 60)] + [(100, 70), (70, 80), (5, 5)]
    found = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {k: 1 for k in range(1, 61)} | {70: 70, 80: 70, 100: 70}


def test_signature_tree_finds_every_link():
    rng = np.random.default_rng(1)
    sets = []
    for _ in range(40):
        base = rng.integers(0, 2**63, int(rng.integers(1, 60))).astype(np.uint64)
        for _ in range(int(rng.integers(1, 5))):
            own = base.copy()
            own[rng.random(len(own)) < 0.2] = rng.integers(0, 2**63)
            sets.append(np.unique(own))
    parent = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            common = len(np.intersect1d(sets[a], sets[b]))
            if 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                old, new = max(parent[a], parent[b]), min(parent[a], parent[b])
                parent = [new if p == old else p for p in parent]
    assert signature_tree.join_groups(sets, 75) == parent


@pytest.mark.parametrize("block", [2_000_000, 40])
def test_near_duplicates(spark, odd, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK_TOKENS", block)
    rows = jaccard_join.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    found = {r["doc_id"]: r for r in rows}
    assert [found[k]["component_id"] for k in (1, 2, 9, 3, 4, 5, 6, 7, 8, None)] == [1, 1, 1, 3, 4, 5, 6, 6, 8, None]
    assert found[1]["n_shingles"] == 9 and found[8]["n_shingles"] == 1 and found[5]["n_shingles"] == 0
    kept = sorted(r["doc_id"] for r in jaccard_join.keep_first(odd).where("doc_id is not null").collect())
    assert kept == [1, 3, 4, 5, 6, 8]


@pytest.mark.parametrize("block", [2_000_000, 60])
def test_near_duplicates_with_an_id_on_two_texts(spark, monkeypatch, block):
    """Each text of a repeated id finds its own near copies, in any order of the rows."""
    monkeypatch.setattr(jaccard_join, "BLOCK_TOKENS", block)
    a, b, c = (" ".join(f"{name}{k}" for k in range(60)) for name in "abc")
    rows = [(2, a), (2, b), (2, c), (3, a + " x"), (4, b + " x"), (5, c + " x"), (1, b + " y"), (6, a), (7, c), (7, a + " z")]
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string")
        marks = {(r["doc_id"], r["mark"]): r["component_id"] for r in jaccard_join.near_rows(docs).collect()}
        texts = {(r["doc_id"], r["mark"]): r["text"] for r in docs.select("*", jaccard_join.text_mark(docs).alias("mark")).collect()}
        found = {(doc_id, texts[doc_id, mark]): root for (doc_id, mark), root in marks.items()}
        assert found == {(i, t): 1 if t[0] == "b" else 2 for i, t in rows}
        kept = {(r["doc_id"], r["text"]) for r in jaccard_join.keep_first(docs).collect()}
        assert kept == {(2, a), (2, c), (1, b + " y")}


def test_quality_counts(spark, odd, labels):
    found = by_id(quality.judge(odd, labels))
    assert found[3]["base_failed"] and found[3]["n_words"] == 0 and not found[3]["kept"]
    assert found[6]["n_words"] == 30_000
    lines = "a b c d e f g h i j\na b c d e f g h i j\n \n## x"
    row = quality.judge(spark.createDataFrame([(1, lines)], "doc_id long, text string"), labels).first()
    assert (row["n_words"], row["n_dup_lines"], row["n_repeat_words"], row["n_symbols"]) == (22, 1, 20, 2)
    assert row["base_failed"] and row["word_chars"] == 23
    assert quality.keep(odd, labels).columns == odd.columns


def test_all_trusted_documents_count(spark):
    """Target counts cover every trusted document, also those of a long list of labels."""
    n = 60_000
    docs = spark.range(n).selectExpr("id as doc_id", "concat('w', id) as text")
    trusted = spark.range(n).selectExpr("id as doc_id", "cast(id % 12 > 0 as int) as quality")
    assert grams.trusted_ids(trusted).count() == n - n // 12
    codes = [r["c"] % 100 for r in docs.selectExpr("xxhash64(text) as c").collect()]
    raw = np.bincount(codes, minlength=100)
    target = np.bincount([c for k, c in enumerate(codes) if k % 12], minlength=100)
    want = np.log((target + 1) / (target.sum() + 100)) - np.log((raw + 1) / (raw.sum() + 100))
    assert np.abs(np.array(grams.log_ratios(docs, trusted, 100)) / grams.SCALE - want).max() < 0.001


def test_resampling(odd, labels):
    rows = resampling.resample(odd, labels, share=0.5).collect()
    kept = [r["sample_key"] for r in rows if r["kept"]]
    assert len(rows) == odd.count() and len(kept) >= round(0.5 * len(rows))
    assert min(kept) >= max(r["sample_key"] for r in rows if not r["kept"])


def test_simhash(spark, odd):
    rows = sorted([(9, "nine words"), (4, "four"), (7, "seven of them")], reverse=True)
    found = by_id(simhash.fingerprint_documents(spark.createDataFrame(rows, "doc_id long, text string")))
    for k, (doc_id, text) in enumerate(rows):
        following = rows[(k + 1) % 3][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert found[doc_id]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert found[doc_id]["near_next"] == simhash.likeness(simhash.fingerprint(text), simhash.fingerprint(following))
    rows = simhash.with_near(simhash.fingerprint_documents(odd)).collect()
    assert len(rows) == odd.count()
    assert len({r["fingerprint"] for r in rows if r["doc_id"] in (1, 2)}) == 1


def test_block_tables(spark):
    rng = np.random.default_rng(2)
    marks = [rng.bytes(16) for _ in range(30)]
    for m in marks[:15]:
        value = int.from_bytes(m)
        for bit in rng.integers(0, 128, int(rng.integers(1, 6))):
            value ^= 1 << int(bit)
        marks.append(value.to_bytes(16))
    distinct = {*marks}
    near = {
        a.hex(): n for a in distinct if (n := sum(a != b and (int.from_bytes(a) ^ int.from_bytes(b)).bit_count() <= 3 for b in distinct))
    }
    frame = spark.createDataFrame([(m.hex(),) for m in marks], "fingerprint string")
    assert {r["fingerprint"]: r["n_near"] for r in simhash.near_sets(frame).collect()} == near


def test_simhash_near_copies(spark):
    """Texts with some words replaced are near, copies are one class, pairs equal brute force."""
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(5000)}" for _ in range(300)) for _ in range(40)]
    for text in texts[:20]:
        words = text.split()
        words[rng.randrange(300)] = words[rng.randrange(300)] = "other"
        texts.append(" ".join(words))
    rows = [*enumerate(texts), (100, texts[0]), (101, texts[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = {t: simhash.fingerprint(t) for t in texts}
    want = {}
    for a in range(len(texts)):
        for b in range(a + 1, len(texts)):
            distance = (int.from_bytes(marks[texts[a]]) ^ int.from_bytes(marks[texts[b]])).bit_count()
            if distance <= simhash.NEAR:
                want[a, b] = distance
    assert want.keys() >= {(k, k + 40) for k in range(20)}
    found = simhash.near_documents(docs).collect()
    assert len(found) == len(want) and {(r["a"], r["b"]): r["distance"] for r in found} == want
    near = by_id(simhash.with_near(simhash.fingerprint_documents(docs)))
    for k in (0, 100, 101):
        assert (near[k]["class_id"], near[k]["n_copies"], near[k]["n_near"]) == (0, 3, 1)
    assert [near[k]["n_near"] for k in range(60)] == [sum(k in pair for pair in want) for k in range(60)]


def test_sampled_tables_hold_their_recall(spark):
    """Keys and tiles at a small group size: pairs once each, and the promised share of all."""
    rng = np.random.default_rng(4)
    marks = [rng.bytes(16) for _ in range(300)]
    for m in marks[:]:
        flips = rng.permutation(128)[: int(rng.integers(1, simhash.NEAR + 1))]
        marks.append((int.from_bytes(m) ^ sum(1 << int(f) for f in flips)).to_bytes(16))
    ids = {m.hex(): k for k, m in enumerate(marks)}
    numbers = [int.from_bytes(m) for m in marks]
    want = {(a, b) for a in range(600) for b in range(a + 1, 600) if (numbers[a] ^ numbers[b]).bit_count() <= simhash.NEAR}
    classes = spark.createDataFrame([(f, k) for f, k in ids.items()], "fingerprint string, class_id long")
    assert simhash.sampled_bits(600, group=40).shape[1] == 4
    found = [(r["a"], r["b"]) for r in simhash.near_pairs(classes, group=40).collect()]
    assert len(found) == len({*found}) and {*found} <= want and len(found) >= 0.99 * len(want)
    counts = {r["fingerprint"]: r["n_near"] for r in simhash.near_counts(classes, group=40).collect()}
    assert counts == {f: n for f, k in ids.items() if (n := sum(k in pair for pair in found))}
    assert {(r["a"], r["b"]) for r in simhash.near_pairs(classes).collect()} == want


def test_near_search_finds_all_at_any_size(spark):
    """Pairs at the full radius among more fingerprints than one small group; all of them, by tables and by comparison."""
    rng = np.random.default_rng(6)
    marks = [rng.bytes(16) for _ in range(3000)]
    for m in marks[:]:
        flips = rng.permutation(128)[: simhash.NEAR]
        marks.append((int.from_bytes(m) ^ sum(1 << int(f) for f in flips)).to_bytes(16))
    lanes = np.frombuffer(b"".join(marks), np.uint64).reshape(-1, 2)
    want = set()
    for k in range(len(lanes)):
        near = np.flatnonzero(np.bitwise_count(lanes[k + 1 :] ^ lanes[k]).sum(1) <= simhash.NEAR) + k + 1
        want |= {(k, j) for j in near.tolist()}
    assert want >= {(k, k + 3000) for k in range(3000)}
    classes = spark.createDataFrame([(m.hex(), k) for k, m in enumerate(marks)], "fingerprint string, class_id long")
    counts = {r["fingerprint"]: r["n_near"] for r in simhash.near_counts(classes).collect()}
    assert counts == {marks[k].hex(): n for k, n in Counter(k for pair in want for k in pair).items()}
    assert {(r["a"], r["b"]) for r in simhash.near_pairs(classes).collect()} == want
    found = [(r["a"], r["b"]) for r in simhash.near_pairs(classes, group=2500, few=0).collect()]
    assert len(found) == len(want) and {*found} == want


def test_near_tables_agree_with_all_pairs():
    """Blocks with every number of errors, and groups of near copies, which the tables leave to the comparison."""
    rng = np.random.default_rng(7)
    assert simhash.NEAR == simhash.COVER_BLOCKS * 8 - 1
    left = rng.integers(0, 1 << 64, (1500, 2), dtype=np.uint64)
    bits = np.unpackbits(left.view(np.uint8), axis=1)
    for row in bits:
        for block in range(4):
            row[32 * block + rng.permutation(32)[: rng.integers(5, 10)]] ^= 1
    right = np.packbits(bits, axis=1).view(np.uint64)
    exact = np.concatenate([*simhash._near_by_all(left, right, simhash.NEAR)])
    assert 500 < len(exact) < 1500
    assert np.array_equal(simhash._near_by_tables(left, right, simhash.NEAR), exact)
    same = left[:1] ^ (np.uint64(1) << rng.integers(0, 64, (700, 2)).astype(np.uint64))
    assert simhash._near_by_tables(same, same, simhash.NEAR) is None
    found = [*simhash._near_in_tile(same, np.zeros(700, np.int32), True, simhash.NEAR, 0)]
    assert sum(len(x) for x, _, _ in found) == 700 * 699 // 2
    assert simhash._near_by_tables(left, right, simhash.NEAR + 1) is None


def test_packing(odd):
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    args = public_tokenizers.path(queries.BYTE_BPE), public_tokenizers.PATTERN, queries.END_OF_TEXT
    for text in ("", "a  b\n c<|endoftext|>d", "é　ü it's"):
        ids = np.frombuffer(packing.token_bytes(text, *args), "<u4").tolist()
        assert ids == exact.encode(text, add_special_tokens=False).ids
    rows = packing.pack_documents(odd.where("doc_id is not null").dropDuplicates(["doc_id"]), *args).collect()
    used = {}
    for r in rows:
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in used.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at == 2048 or at & (at - 1) == 0
    ids = np.array([*exact.encode(LONG, add_special_tokens=False).ids, 1], "<u4")
    at = 0
    for r in sorted((r for r in rows if r["doc_id"] == 6), key=lambda r: r["start"]):
        assert r["start"] == at and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
        at += r["length"]
    assert at == len(ids)


def test_bpe_matches_the_library(odd):
    exact = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    model = bpe.vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["", " ", "Hello it's ΑΣ", "x<|endoftext|>Y", "日本語 كتاب 👍🏽", "ab" * 700, "12 ½ İ ß ſ", "a\x1cb\x85c"]
    for text, (ids, decoded) in zip(texts, model.encode_all(texts)):
        want = exact.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert decoded == exact.decode(want, skip_special_tokens=False)
    rows = bpe.encode_documents(odd, public_tokenizers.path("word_bpe_49k.json")).collect()
    assert len(rows) == odd.count() and by_id(odd.sparkSession.createDataFrame(rows))[3]["n_tokens"] == 0


def test_gradients_of_the_byte_network():
    network = langid.Network.initial(3, 4, np.random.default_rng(1))
    rng = np.random.default_rng(3)
    data, labels = rng.integers(0, 256, (6, 3)).astype(np.uint8), np.array([0, 2, 1])

    def loss():
        return -np.log(network.probabilities(data)[labels, :, np.arange(3)]).mean()

    for weights, slope in zip(network.parameters(), network.gradients(data, np.ones((6, 3), bool), labels)):
        at = np.unravel_index(np.abs(slope).argmax(), slope.shape)
        old = weights[at]
        weights[at] = old + 1e-2
        more = loss()
        weights[at] = old - 1e-2
        less = loss()
        weights[at] = old
        assert abs((more - less) / 2e-2 - slope[at]) < 2e-3


def test_language_held_out(spark, odd):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.95
    found = by_id(langid.identify(odd))
    assert found[3]["lang_pred"] == found[5]["lang_pred"] == "und"


def test_toxicity_held_out(spark, odd, labels):
    sf_dir = "/root/testdata/sf0.1"
    docs, marks = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels"))
    rows = toxicity.score(docs, marks).join(marks, "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] == r["toxic"] for r in rows]) > 0.96
    assert toxicity.score(odd, labels).count() == odd.count()
    assert toxicity.drop_toxic(odd, labels).columns == odd.columns


def test_isotonic_levels_ascend():
    rng = np.random.default_rng(4)
    margin = rng.standard_normal(300)
    knots, levels = toxicity.isotonic(margin, (margin + rng.standard_normal(300) > 0).astype(float))
    assert (np.diff(knots) > 0).all() and (np.diff(levels) > 0).all()


def test_extraction(spark):
    page = (
        "<html><head><title>t</title><style>p{}</style></head><body><nav><ul><li><a href=x>Home</a></li></ul></nav>"
        "<article><h1>Title &amp; more</h1><p><b>First  para.<br><p>Second\nline of the text, with words.</article>"
        '<div class="comments"><p>Nice post!</p></div><footer>&copy; us</footer>'
    )
    frame = spark.createDataFrame(
        [(1, "u", page), (2, None, None), (None, "v", ""), (2, "u", "<p")], "page_id long, url string, html string"
    )
    rows = extraction.extract(frame).collect()
    assert rows[0]["text"] == "Title & more First para. Second line of the text, with words."
    assert [r["n_chars"] for r in rows[1:]] == [0, 0, 0]


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ('<p>one<svg class="icon" />two<p>three', "one two three"),
        ("<p>one<SVG/>two</p><svg><text>no</text></svg>three", "one two three"),
        ("<title-bar>one</title-bar><template-x>two</template-x><object-view>three</object-view>", "one two three"),
        ("<title>no</title-bar>no</title>one<select-box><p>two</select-box>", "one two"),
        ("<p>one<iframe src=x>two<p>three<select><option>four", "one two three four"),
        ('<p>one<object title="a>b">no</object>two', "one two"),
        ("<p>one<script\n>no</p></script >two<style>no</p>no", "one two"),
        ("<p>one<textarea>no<p>no", "one"),
        ("<p>one" + "<canvas>" * 50_000 + "two", "one two"),
    ],
)
def test_skipped_elements(page, text):
    blocks = html_blocks.blocks_of(page, html_blocks.PathCodes(64))
    assert " ".join(b.text for b in blocks) == text


def test_extraction_of_the_test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    right = 0
    rows = extraction.extract(pages).join(pages.select("page_id", "html"), "page_id").collect()
    for r in rows:
        body = re.search(r"<article>(.*?)(</article>|<footer>|\Z)", r["html"], re.S)[1]
        words = re.sub(r"</?(p|h1|b|br)>", " ", body).replace("&amp;", "&").replace("&quot;", '"').split()
        right += words == r["text"].split()
    assert right >= 0.95 * len(rows)


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n != "op1_html_extraction"])
def test_empty_tables(spark, tmp_path, name):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert queries.QUERIES[name](spark, str(tmp_path)).count() == 0
