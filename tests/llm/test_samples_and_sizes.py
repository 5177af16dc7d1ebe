"""Bounded samples, exact draws and memory of the learned text operators."""

import zlib

import numpy as np
import pytest

from scorewatch.llm import extraction, html_blocks, langid, resampling

LABELS = "doc_id long, quality int"


def test_a_rare_language_is_learned(spark):
    """Two rows of a language among 40,000; a bounded number of rows of the others."""
    rare = [k for k in range(17, 40_000) if zlib.crc32(str(k).encode()) % 4 != 2][:2]
    docs = spark.range(40_000).selectExpr(
        "id as doc_id", "concat('text number ', id, ' of many') as text",
        f"case when id in ({rare[0]}, {rare[1]}) then 'xx' when id % 2 = 0 then 'en' else 'de' end as lang",
    )
    counts = {r["lang"]: r["count"] for r in langid.labelled_sample(docs, 300).groupBy("lang").count().collect()}
    assert counts == {"en": 300, "de": 300, "xx": 2}


def test_a_repeated_id_does_not_fill_the_sample(spark):
    """One id with one text on 20,000 rows is one text; different texts of an id count up to the bound."""
    learned = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 4 != 2)
    rows = spark.range(20_000).selectExpr(f"{learned}L as doc_id", "if(id < 19000, 'the same', concat('own ', id)) as text", "'en' as lang")
    found = [r["text"] for r in langid.labelled_sample(rows, 400).collect()]
    assert len(found) == len(set(found)) == 400
    docs = rows.where("text = 'the same'")
    assert langid.sample_windows(docs).count() == 1
    assert langid.labelled_sample(docs.limit(0)).count() == 0


@pytest.mark.parametrize("share", [0.1, 0.5, 0.9])
def test_the_draw_is_exact(spark, share):
    """Of 100 rows, 90 of them one repeated row, the share is drawn to the row."""
    rows = [(1, "one repeated row of words")] * 90 + [(k, f"own words {k} here") for k in range(2, 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = resampling.resample(docs, spark.createDataFrame([(1, 1), (2, 0)], LABELS), share=share).collect()
    kept = [r["sample_key"] for r in found if r["kept"]]
    assert len(found) == 100 and len(kept) == round(100 * share)
    assert min(kept) >= max(r["sample_key"] for r in found if not r["kept"])


def test_weights_equal_plain_counts(spark):
    """Mean log ratio per n-gram from counts in plain Python, over the same buckets."""
    texts = {1: "good words are here", 2: "bad stuff", 3: "good stuff here", 4: ""}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], LABELS)
    ids = {g: r for g, r in _grams(spark, texts.values()).items()}
    grams = lambda t: (w := t.split()) + [" ".join(p) for p in zip(w, w[1:])]
    raw, target = np.zeros(10_000), np.zeros(10_000)
    for k, t in texts.items():
        for g in grams(t):
            raw[ids[g]] += 1
            target[ids[g]] += k == 1
    ratio = np.log((target + 1) / (target.sum() + 10_000)) - np.log((raw + 1) / (raw.sum() + 10_000))
    for r in resampling.resample(docs, labels).collect():
        own = [ratio[ids[g]] for g in grams(texts[r["doc_id"]])]
        assert abs(r["log_ratio"] - (np.mean(own) if own else 0)) < 0.001


def _grams(spark, texts):
    """Bucket of every word and pair, by the rule of the operator: words by hash, pairs by a shifted combination."""
    code = lambda w: spark.sql(f"select xxhash64('{w}')").first()[0]
    mask = (1 << 64) - 1
    out = {}
    for text in texts:
        words = text.split()
        for w in words:
            out[w] = code(w) % 10_000
        for a, b in zip(words, words[1:]):
            mixed = ((code(a) << 1) & mask) ^ (code(b) & mask)
            out[f"{a} {b}"] = (mixed - (1 << 64) if mixed >> 63 else mixed) % 10_000
    return out


def test_a_page_of_many_blocks_stands_alone(monkeypatch):
    """Labels are those of the pages alone, and no more than the limit is padded beside a long page."""
    model = extraction.trained()
    codes = html_blocks.PathCodes(extraction.PATH_CODES)
    short = "<html><body><nav><a href=x>Home</a></nav><article><h1>Title</h1><p>Some words of text here.</article></body></html>"
    long = "<html><body><article>" + "<p>A paragraph with some words in it." * 3000 + "</article></body></html>"
    pages = [html_blocks.blocks_of(p, codes) for p in [short] * 40 + [long] + [short] * 40 + [""]]
    sizes = []
    vectors = model.vectors
    monkeypatch.setattr(model, "vectors", lambda part: sizes.append(len(part) * max(len(p.numbers) for p in part)) or vectors(part))
    monkeypatch.setattr(extraction, "TOGETHER", 400)
    found = extraction.label_pages(model, pages)
    assert sorted(sizes)[-1] == len(pages[40]) and max(sorted(sizes)[:-1]) <= 400
    for blocks, marks in zip(pages, found, strict=True):
        alone = extraction.label_pages(model, [blocks])[0]
        assert (marks == alone).all() and len(marks) == len(blocks)


def test_extraction_of_odd_tables(spark):
    """An empty table, and columns whose names clash with inner ones."""
    schema = "page_id long, url string, html string, text long, n_chars string, blocks int"
    none = spark.createDataFrame([], schema)
    assert extraction.extract(none).count() == 0
    page = "<article><h1>Title</h1><p>Some words of text are here.</article>"
    rows = extraction.extract(spark.createDataFrame([(1, "u", page, 5, "x", 1), (1, "u", page, 5, "x", 1)], schema)).collect()
    assert [r["text"] for r in rows] == ["Title Some words of text are here."] * 2
