"""The registered queries of this folder and, where SQL can express them, their equal SQL texts."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from roadtally.llm.decontaminate import contamination
from roadtally.llm.language_id import identify
from roadtally.llm.line_dedup import dedup_lines
from roadtally.llm.lm_scoring import lm_scores
from roadtally.llm.mixing import mixed_counts
from roadtally.llm.near_dedup import near_duplicates
from roadtally.llm.prefix_trie import conversation_trie
from roadtally.llm.secret_scan import scan
from roadtally.llm.spelling_variants import spelling_variants
from roadtally.llm.substring_dedup import dedup_substrings
from roadtally.llm.suffix_dedup import dedup_suffixes
from roadtally.llm.token_output import token_output
from roadtally.llm.vector_search import nearest


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


def near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(_docs(spark, sf))


NEAR_DEDUP = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS parts FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, list_aggregate(parts[i:i + 4], 'string_agg', ' ') AS shingle
  FROM words, unnest(range(1, greatest(len(parts) - 4, least(len(parts), 1)) + 1)) AS u(i)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * shared >= 75 * (x.n + y.n - shared)
), ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, w.b FROM reach r JOIN ways w ON r.b = w.a
), smallest AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, s.component_id, d.doc_id = s.component_id AS kept
FROM documents d JOIN smallest s ON d.doc_id = s.doc_id LEFT JOIN sizes z ON d.doc_id = z.doc_id
"""


def line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return dedup_lines(_docs(spark, sf)).drop("kept")


LINE_DEDUP = r"""
WITH lines AS (
  SELECT doc_id, i, parts[i] AS line FROM (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
  ), unnest(range(1, len(parts) + 1)) AS u(i)
), keys AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
), firsts AS (
  SELECT key, min(doc_id) AS first FROM keys WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1
), marked AS (
  SELECT k.*, f.first IS NOT NULL AND k.doc_id > f.first AS gone FROM keys k LEFT JOIN firsts f ON k.key = f.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixed_counts(_docs(spark, sf)).drop("position")


MIXING = r"""
WITH sized AS (
  SELECT doc_id, source AS s, md5(CAST(doc_id AS VARCHAR)) AS m,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), sources AS (
  SELECT s, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY s IS NULL, s) - 1 AS place FROM sized GROUP BY s
), weighed AS (
  SELECT *, CAST([5, 2, 1][place % 3 + 1] AS DOUBLE) AS weight, CAST(source_size AS DOUBLE) * 2 AS cap FROM sources
), steps AS (
  SELECT *, (sum(source_size) OVER () * CAST(1.5 AS DOUBLE)
             - coalesce(sum(cap) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM weighed
), levels AS (
  SELECT level AS final FROM steps WHERE level * weight <= cap ORDER BY cap / weight, place LIMIT 1
), goals AS (
  SELECT s, source_size, least(cap, (SELECT final FROM levels) * weight) AS target FROM steps
), placed AS (
  SELECT z.*, g.source_size, g.target,
         coalesce(sum(z.size) OVER (PARTITION BY z.s ORDER BY z.m, z.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM sized z JOIN goals g ON z.s IS NOT DISTINCT FROM g.s
)
SELECT doc_id, size, source_size, target,
       CAST(greatest(0, least(size, floor(target) - start)) + greatest(0, least(size, floor(target) - source_size - start)) AS BIGINT) AS taken
FROM placed
"""


def decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return contamination(_docs(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet")).drop("items")


DECONTAMINATION = r"""
WITH parts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
), windows AS (
  SELECT DISTINCT item, least(len(words), 10) AS size, list_aggregate(words[i:i + least(len(words), 10) - 1], 'string_agg', ' ') AS run
  FROM items, unnest(range(1, len(words) - least(len(words), 10) + 2)) AS u(i) WHERE len(words) > 0
), sizes AS (
  SELECT DISTINCT size FROM windows
), runs AS (
  SELECT doc_id, i, size, list_aggregate(words[i:i + size - 1], 'string_agg', ' ') AS run
  FROM parts, sizes, unnest(range(1, len(words) - size + 2)) AS u(i)
), hits AS (
  SELECT r.doc_id, r.i, r.size, w.item FROM runs r JOIN windows w ON r.size = w.size AND r.run = w.run
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM hits, unnest(range(i, i + size)) AS u(p) GROUP BY doc_id
), held AS (
  SELECT doc_id, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY doc_id
)
SELECT p.doc_id, CAST(len(p.words) AS BIGINT) AS n_words, coalesce(c.n, 0) AS n_hit, coalesce(h.n, 0) AS n_items,
       sha256(coalesce(h.items, '')) AS items_sha256, coalesce(c.n, 0) > 0 AS contaminated
FROM parts p LEFT JOIN covered c ON p.doc_id = c.doc_id LEFT JOIN held h ON p.doc_id = h.doc_id
"""


def secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return scan(_docs(spark, sf))


def suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return dedup_suffixes(_docs(spark, sf)).drop("kept")


def vector_search(spark: SparkSession, sf: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf}/embeddings.parquet"))


def language_id(spark: SparkSession, sf: str) -> DataFrame:
    return identify(_docs(spark, sf))


def substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return dedup_substrings(_docs(spark, sf)).drop("kept")


SUBSTRING_DEDUP = r"""
WITH words AS (
  SELECT doc_id, i, list_aggregate(parts[i:i + 34], 'string_agg', ' ') AS run, len(parts) AS n, parts[i] AS word FROM (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS parts FROM documents
  ), unnest(range(1, len(parts) + 1)) AS u(i)
), runs AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY run) > 1 AS again FROM words WHERE i + 34 <= n
), marked AS (
  SELECT w.doc_id, w.i, w.word,
         coalesce(max(CASE WHEN r.again THEN w.i END) OVER (PARTITION BY w.doc_id ORDER BY w.i), -99) > w.i - 35 AS gone
  FROM words w LEFT JOIN runs r ON w.doc_id = r.doc_id AND w.i = r.i
), kept AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed,
         coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone), '') AS kept
  FROM marked GROUP BY doc_id
)
SELECT d.doc_id, coalesce(k.n_words, 0) AS n_words, coalesce(k.n_removed, 0) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""

def _tokenizer() -> str:
    """The tokenizer's own file; its path belongs to the machine of the driver only."""
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        return file.read()


def token_ids(spark: SparkSession, sf: str) -> DataFrame:
    return token_output(_docs(spark, sf), _tokenizer()).drop("ids")


def lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    return lm_scores(_docs(spark, sf))


def spelling_groups(spark: SparkSession, sf: str) -> DataFrame:
    return spelling_variants(_docs(spark, sf), every=31)


#: The table of crc32 as a relation with one list, `steps`; _crc is the value of a list of bytes where that relation is joined.
CRC_TABLE = """
crc_table AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS steps
  FROM (SELECT CAST(range AS BIGINT) AS i FROM range(256))
)"""


def _crc(bytes_: str) -> str:
    return f"""xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {bytes_}),
               lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295)"""


def trie(spark: SparkSession, sf: str) -> DataFrame:
    return conversation_trie(spark.read.parquet(f"{sf}/conversations.parquet"))


TRIE = rf"""
WITH {CRC_TABLE}, turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS i
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT DISTINCT c, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT)) AS raw FROM turns
), heads AS (
  SELECT c, c - c % 100 AS base, {_crc("raw")} % 6 AS h FROM convs, crc_table
), lent AS (
  SELECT h.c, t.i, t.role, t.text FROM heads h JOIN turns t ON t.c = h.base AND t.i <= h.h
), parts AS (
  SELECT c, 0 AS own, i, role, text FROM lent
  UNION ALL
  SELECT h.c, 1, t.i, t.role, t.text FROM heads h JOIN turns t ON t.c = h.c AND t.i > h.h
), rebuilt AS (
  SELECT c, row_number() OVER w AS depth, length(text) AS size, string_agg(md5(role) || md5(text), '') OVER w AS path
  FROM parts WINDOW w AS (PARTITION BY c ORDER BY own, i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), prefixes AS (
  SELECT c, depth, size, path, path[:64 * (depth - 1)] AS up FROM rebuilt
  UNION ALL
  SELECT c, 0, 0, '', NULL FROM convs
), nodes AS (
  SELECT depth, path, min(up) AS up, min(c) AS conv, count(*) AS n, min(size) AS size FROM prefixes GROUP BY depth, path
), children AS (
  SELECT up, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY up
), full_nodes AS (
  SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM nodes n LEFT JOIN children k ON n.path = k.up
), sums AS (
  SELECT a.path, count(*) FILTER (WHERE b.n_children = 0) AS n_leaves, sum((b.n - 1) * b.size) AS saved
  FROM full_nodes a JOIN full_nodes b ON starts_with(b.path, a.path) GROUP BY a.path
), lasts AS (
  SELECT c, arg_max(path, depth) AS path FROM prefixes GROUP BY c
), ends AS (
  SELECT path, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids FROM lasts GROUP BY path
)
SELECT n.conv AS conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv AS parent_conv_id, n.n AS n_convs, n.n_children, s.n_leaves,
       CAST(s.saved AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM full_nodes n JOIN sums s ON n.path = s.path LEFT JOIN nodes p ON n.depth > 0 AND n.up = p.path LEFT JOIN ends e ON n.path = e.path
"""


SPELLING_VARIANTS = rf"""
WITH RECURSIVE {CRC_TABLE}, runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents
  ) GROUP BY ALL
), hexed AS (
  SELECT *, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS h FROM runs WHERE length(run) >= 7
), bytes AS (
  SELECT *, list_transform(range(1, length(h), 2), lambda i: CAST(instr('0123456789ABCDEF', h[i]) * 16 + instr('0123456789ABCDEF', h[i + 1]) - 17 AS BIGINT)) AS raw
  FROM hexed
), hashed AS (
  SELECT run, n, {_crc("raw")} AS crc FROM bytes, crc_table
), slipped AS (
  SELECT CASE WHEN crc % 31 = 0 THEN run[:crc % length(run)] || run[crc % length(run) + 2:] ELSE run END AS word, n FROM hashed
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM slipped WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), shorter AS (
  SELECT word, n, i, word[:i - 1] || word[i + 1:] AS rest FROM words, unnest(range(1, length(word) + 1)) AS u(i)
), pairs AS (
  SELECT DISTINCT a.word, b.word AS near, b.n AS near_n FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION
  SELECT a.word, b.word, b.n FROM words a JOIN shorter b ON a.word = b.rest
  UNION
  SELECT b.word, a.word, a.n FROM words a JOIN shorter b ON a.word = b.rest
), best AS (
  SELECT word, count(*) AS n_near, max(near_n) AS most FROM pairs GROUP BY word
), forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.most >= 10 * w.n THEN b.most END AS form_n,
         CASE WHEN b.most >= 10 * w.n THEN (SELECT min(encode(p.near)) FROM pairs p WHERE p.word = w.word AND p.near_n = b.most) END AS form
  FROM words w LEFT JOIN best b ON w.word = b.word
), chains AS (
  SELECT word, word AS root, 0 AS steps FROM forms
  UNION ALL
  SELECT c.word, decode(f.form), steps + 1 FROM chains c JOIN forms f ON c.root = f.word WHERE f.form IS NOT NULL
), ends AS (
  SELECT word, arg_max(root, steps) AS root FROM chains GROUP BY word
)
SELECT f.word, decode(f.form) AS form, e.root, f.n, f.n_near, f.form_n FROM forms f JOIN ends e ON f.word = e.word
"""


QUERIES = {
    "op1_near_dedup": (near_dedup, NEAR_DEDUP),
    "op2_line_dedup": (line_dedup, LINE_DEDUP),
    "op3_mixing": (mixing, MIXING),
    "op4_suffix_dedup": (suffix_dedup, None),
    "op5_vector_search": (vector_search, None),
    "op6_decontamination": (decontamination, DECONTAMINATION),
    "op7_secret_scan": (secret_scan, None),
    "op8_language_id": (language_id, None),
    "op9_substring_dedup": (substring_dedup, SUBSTRING_DEDUP),
    "op10_token_output": (token_ids, None),
    "op11_prefix_trie": (trie, TRIE),
    "op12_lm_scoring": (lm_scoring, None),
    "op13_spelling_variants": (spelling_groups, SPELLING_VARIANTS),
}
