"""The registered queries: each applies an operator to its whole table.

SQL stands beside those queries that it can express; the others are tested against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontaminate,
    lines,
    neighbours,
    phrases,
    pieces,
    simhash,
    substrings,
    suffixes,
    tokencounts,
    tokenfiles,
    toxicity,
    turntrie,
    warc,
)
from .registry import ORACLES, QUERIES, query, table

__all__ = ["ORACLES", "QUERIES"]

# A single line, or two in a row, with as many words is a repeat without a third line.
LINE_WORDS = 50


@query("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op2_warc", """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
r AS (
  SELECT *, max(page_id) OVER (PARTITION BY html) AS leader FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> leader THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> leader THEN leader END AS refers_to
FROM r""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op3_nearest")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = neighbours.usable_vectors(table(spark, sf_dir, "embeddings"))
    return neighbours.search(vectors, vectors.where("id % 100 = 0"))


@query("op4_pieces")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_pieces(table(spark, sf_dir, "documents"))


@query("op5_decontaminate", r"""
WITH w AS (
  SELECT doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
b AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, size, array_to_string(words[i:i + size - 1], ' ') AS piece
  FROM (SELECT item_id, words, least(10, len(words)) AS size,
               unnest(range(1, len(words) - least(10, len(words)) + 2)) AS i FROM b WHERE len(words) > 0)),
sizes AS (SELECT DISTINCT size FROM item_windows),
doc_windows AS (
  SELECT doc_id, i, size, array_to_string(words[i:i + size - 1], ' ') AS piece
  FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM w, sizes
        WHERE len(words) >= size)),
hits AS (SELECT doc_id, item_id, i, size FROM doc_windows JOIN item_windows USING (size, piece)),
covered AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT w.doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query("op6_simhash")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op7_suffixes")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.dedup_bytes(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op8_lines", r"""
WITH l AS (
  SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
u AS (
  SELECT doc_id, list_filter(range(1, len(lines) + 1), lambda i: length(trim(lines[i])) > 0) AS units, lines FROM l),
sized AS (
  SELECT doc_id, units, lines, least(3, len(units)) AS whole, unnest([1, 2, 3]) AS size FROM u WHERE len(units) > 0),
runs AS (
  SELECT doc_id, size = whole AS is_whole, units[i] AS a, units[i + size - 1] AS b,
         list_transform(units[i:i + size - 1], lambda k: lines[k]) AS piece
  FROM (SELECT *, unnest(range(1, len(units) - size + 2)) AS i FROM sized WHERE size <= whole)),
w AS (
  SELECT doc_id, a, b, piece FROM runs WHERE is_whole OR list_sum(list_transform(
    piece, lambda line: len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')))) >= 50),
later AS (
  SELECT doc_id, a, b FROM (
    SELECT *, row_number() OVER (PARTITION BY piece ORDER BY doc_id, a) AS n FROM w) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(a, b + 1)) AS i FROM later),
kept AS (
  SELECT x.doc_id, string_agg(line, chr(10) ORDER BY i) AS kept
  FROM (SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS i FROM l) x
  ANTI JOIN gone ON gone.doc_id = x.doc_id AND gone.i = x.i GROUP BY x.doc_id)
SELECT d.doc_id, CAST(coalesce(len(l.lines), 0) AS INTEGER) AS n_lines,
       CAST((SELECT count(*) FROM gone WHERE gone.doc_id = d.doc_id) AS INTEGER) AS n_removed,
       sha256(coalesce(kept.kept, '')) AS kept_sha256
FROM documents d JOIN l USING (doc_id) LEFT JOIN kept USING (doc_id)""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(table(spark, sf_dir, "documents"), words=LINE_WORDS).select(
        F.col("row.doc_id").alias("doc_id"), "n_lines", "n_removed",
        F.sha2(F.coalesce(F.col("kept"), F.lit("")), 256).alias("kept_sha256"))


@query("op9_tokens")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.read_documents(tokenfiles.write_shards(table(spark, sf_dir, "documents")))


@query("op10_substrings", r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 34], ' ') AS piece
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS i FROM w WHERE len(words) >= 35)),
again AS (SELECT piece FROM windows GROUP BY piece HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM windows SEMI JOIN again USING (piece)),
cut AS (SELECT doc_id, list(i) AS places FROM gone GROUP BY doc_id),
kept AS (
  SELECT x.doc_id, string_agg(word, ' ' ORDER BY i) AS kept
  FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM w) x
  ANTI JOIN gone ON gone.doc_id = x.doc_id AND gone.i = x.i GROUP BY x.doc_id)
SELECT w.doc_id, len(words) AS n_words, coalesce(len(places), 0) AS n_removed,
       sha256(coalesce(kept.kept, '')) AS kept_sha256
FROM w LEFT JOIN cut USING (doc_id) LEFT JOIN kept USING (doc_id)""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup_substrings(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", "kept_sha256")


@query("op11_phrases", r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?
-
]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS words FROM p),
totals AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM w GROUP BY lang),
grams AS (
  SELECT lang, size, phrase, count(*) AS a
  FROM (SELECT lang, size, array_to_string(words[i:i + size - 1], ' ') AS phrase
        FROM (SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS i
              FROM w, range(1, 6) AS sizes(size) WHERE len(words) >= size))
  GROUP BY lang, size, phrase HAVING count(*) >= 100),
phrases AS (SELECT lang, phrase, size, a, string_split(phrase, ' ') AS words FROM grams WHERE size > 1),
held AS (
  SELECT lang, array_to_string(words[i:i + n - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT lang, words, size, a, n, unnest(range(1, size - n + 2)) AS i
        FROM phrases, range(2, 5) AS inner_sizes(n) WHERE n < size)
  GROUP BY ALL),
kept AS (
  SELECT phrases.* FROM phrases LEFT JOIN held USING (lang, phrase)
  WHERE longer IS NULL OR NOT 100 * longer >= 100 * a),
cuts AS (
  SELECT lang, phrase, a, k, array_to_string(words[1:k], ' ') AS first, array_to_string(words[k + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, size)) AS k FROM kept)),
scored AS (
  SELECT c.lang, c.phrase, c.a, f.a AS l, g.a AS r, t.n, c.k,
         CAST(1000::HUGEINT * c.a * t.n // (f.a::HUGEINT * g.a) AS BIGINT) AS score
  FROM cuts c JOIN grams f ON f.lang = c.lang AND f.phrase = c.first
  JOIN grams g ON g.lang = c.lang AND g.phrase = c.rest JOIN totals t ON t.lang = c.lang),
lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM lowest QUALIFY rank <= 2000""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


@query("op12_prefix_trie", r"""
WITH o AS (
  SELECT conv_id AS c, words, m, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, m) AS pos
  FROM (SELECT conv_id, turn, len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+')) AS words,
               md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS m
        FROM conversations WHERE conv_id IS NOT NULL)),
convs AS (
  SELECT c, count(*) AS own, c - c % 20 AS base,
         xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST(c AS VARCHAR), ''),
               lambda x: ascii(x)::BIGINT)),
             lambda s, x: list_reduce(list_concat([xor(s, x)], range(8)),
               lambda y, z: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384::BIGINT) ELSE y >> 1 END)),
           4294967295::BIGINT) % 4 AS h
  FROM o GROUP BY c),
shifted AS (
  SELECT v.*, least(v.h, coalesce(b.own, 0)) AS taken FROM convs v LEFT JOIN convs b ON b.c = v.base),
rebuilt AS (
  SELECT v.c, o.pos AS i, o.m, o.words FROM shifted v JOIN o ON o.c = v.base AND o.pos <= v.h
  UNION ALL
  SELECT v.c, o.pos - v.h + v.taken, o.m, o.words FROM shifted v JOIN o ON o.c = v.c AND o.pos > v.h),
paths AS (
  SELECT c, i AS depth, words, string_agg(m, ',') OVER (PARTITION BY c ORDER BY i) AS node FROM rebuilt
  UNION ALL SELECT c, 0, 0, '' FROM convs),
linked AS (SELECT *, lag(node) OVER (PARTITION BY c ORDER BY depth) AS up FROM paths),
nodes AS (
  SELECT depth, node, min(up) AS up, min(c) AS conv_id, count(*) AS n, min(words) AS words FROM linked GROUP BY depth, node),
children AS (SELECT up, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY up),
valued AS (
  SELECT nodes.*, coalesce(children.n, 0) AS n_children, (nodes.n - 1) * words AS worth
  FROM nodes LEFT JOIN children ON children.up = nodes.node),
sums AS (
  SELECT p.depth, p.node, sum(worth) AS saved, count(*) FILTER (n_children = 0) AS n_leaves
  FROM valued v JOIN paths p ON p.c = v.conv_id AND p.depth <= v.depth GROUP BY p.depth, p.node),
ends AS (
  SELECT depth, node, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids
  FROM (SELECT c, depth, node FROM paths QUALIFY row_number() OVER (PARTITION BY c ORDER BY depth DESC) = 1)
  GROUP BY depth, node)
SELECT v.conv_id, CAST(v.depth AS BIGINT) AS depth, a.conv_id AS parent_conv_id, v.n AS n_convs,
       CAST(v.n_children AS BIGINT) AS n_children, s.n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens,
       sha256(coalesce(e.ids, '')) AS ends_sha256
FROM valued v JOIN sums s USING (depth, node) LEFT JOIN ends e USING (depth, node)
LEFT JOIN nodes a ON a.node = v.up AND a.depth = v.depth - 1""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turntrie.prefix_trie(table(spark, sf_dir, "conversations"))


@query("op13_token_counts")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencounts.count_tokens(table(spark, sf_dir, "documents"))
