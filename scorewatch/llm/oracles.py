"""DuckDB equivalents of the text queries, where SQL can express them in reasonable time.

The repeated strings (op3) and near duplicates (op4) could be written in SQL, but took too long over the
whole tables; like the others they are tested against brute force.
"""

from __future__ import annotations

import corpus_pipeline

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: One row with the table of the byte-wise CRC-32, from its polynomial.
_CRC_TABLE = """crc AS (SELECT list(list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) AS r(i))"""


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of a text's UTF-8 bytes; the query joins the one row of ``crc``."""
    return f"""xor(list_reduce(list_prepend(4294967295::BIGINT,
        list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::BIGINT)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"""


def _features(table: str) -> str:
    return f"""SELECT row, n_words, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))) AS g
        FROM (SELECT row, ws, len(ws) AS n_words FROM (SELECT row_number() OVER () AS row,
              regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM {table}))"""


_TARGET_RESAMPLING = f"""WITH {_CRC_TABLE},
d AS (SELECT row_number() OVER () AS row, doc_id,
        len(regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS n_words FROM documents),
df AS (SELECT row, g, count(*) AS n FROM ({_features("documents")}) GROUP BY row, g),
bf AS (SELECT g, count(*) AS n FROM ({_features("benchmark")}) GROUP BY g),
codes AS (SELECT g, {_crc32("g")} % 10000 AS b FROM (SELECT g FROM df UNION SELECT g FROM bf), crc),
s AS (SELECT b, sum(n) AS n FROM df JOIN codes USING (g) GROUP BY b),
t AS (SELECT b, sum(n) AS n FROM bf JOIN codes USING (g) GROUP BY b),
gains AS (SELECT i AS b, CAST(floor(1000 * ln(CAST((coalesce(t.n, 0) + 1) * ((SELECT sum(n) FROM s) + 10000) AS DOUBLE)
        / CAST((coalesce(s.n, 0) + 1) * ((SELECT coalesce(sum(n), 0) FROM t) + 10000) AS DOUBLE))) AS BIGINT) AS gain
    FROM range(10000) AS r(i) LEFT JOIN s ON s.b = i LEFT JOIN t ON t.b = i),
sums AS (SELECT row, CAST(sum(n) AS BIGINT) AS n, CAST(sum(n * gain) AS BIGINT) AS total
    FROM df JOIN codes USING (g) JOIN gains USING (b) GROUP BY row),
w AS (SELECT doc_id, n_words, coalesce(n, 0) AS n_features,
        coalesce((total - ((total % n + n) % n)) // n, 0) AS weight,
        ('0x' || substr(sha256('7:' || doc_id), 1, 8))::BIGINT AS h
    FROM d LEFT JOIN sums USING (row)),
scored AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM w),
placed AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place FROM scored)
SELECT doc_id, n_features, weight, score,
    CASE WHEN n_words >= 20 AND place <= 25 * (SELECT count(*) FROM scored WHERE n_words >= 20) // 100 THEN place END AS rank
FROM placed"""

#: Two words are one edit apart if they are alike without the letter at one place, or one is the other without a letter.
_SPELLING = f"""WITH RECURSIVE {_CRC_TABLE},
runs AS (SELECT doc_id, run, count(*) AS k FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWERED}, '[a-z\u00c0-\u00ff]+')) AS run
    FROM documents) WHERE length(run) >= 7 GROUP BY doc_id, run),
hashed AS (SELECT run, k, {_crc32("doc_id || ':' || run")} AS h FROM runs, crc),
words AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
    sum(k)::BIGINT AS n FROM hashed GROUP BY 1 HAVING length(word) >= 7 AND sum(k) >= 2),
cut AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
    UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
near AS (SELECT word, count(*) AS n_near, max(other_n) AS best FROM pairs GROUP BY word),
forms AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best >= 10 * w.n THEN best END AS form_n,
    (SELECT min(other) FROM pairs p WHERE p.word = w.word AND p.other_n = best AND best >= 10 * w.n) AS form
    FROM words w LEFT JOIN near USING (word)),
chain AS (SELECT word, word AS root FROM forms
    UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM forms f JOIN chain c USING (word)
    JOIN forms r ON r.word = c.root AND r.form IS NULL"""

ORACLES: dict[str, str] = {
    "op12_target_resampling": _TARGET_RESAMPLING,
    "op13_spelling_variants": _SPELLING,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
