"""One query for each operator, over its whole table, and the SQL twins where SQL can say it."""

import public_tokenizers
from pyspark.sql import functions as F

from tablemart.llm.decontaminate import decontaminate
from tablemart.llm.jaccard_join import ngram_components
from tablemart.llm.mixing import mix_sources, mix_sql
from tablemart.llm.near_vectors import near_duplicate_vectors
from tablemart.llm.packing import pack_documents
from tablemart.llm.prefix_trie import conversation_trie
from tablemart.llm.quality import score_quality
from tablemart.llm.runs import periodic_documents, run_digest
from tablemart.llm.substring_dedup import remove_repeated_words
from tablemart.llm.suffix_dedup import remove_repeated_bytes
from tablemart.llm.tables import read
from tablemart.llm.token_counts import count_tokens
from tablemart.llm.token_files import token_file_digest
from tablemart.llm.topk import top_k

QUERIES, ORACLES = {}, {}


def query(sql=None):
    """Register a function under its own name, with its SQL twin if there is one."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


@query()
def op4_embedding_near_dedup(spark, folder):
    return near_duplicate_vectors(read(spark, folder, "embeddings"))


@query("""
WITH points AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS point
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.point, c.point) AS BIGINT) AS score
  FROM points q JOIN points c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5
""")
def op10_exact_top_k(spark, folder):
    vectors = read(spark, folder, "embeddings")
    return top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


@query()
def op6_token_counts(spark, folder):
    return count_tokens(read(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query(mix_sql())
def op5_source_mixing(spark, folder):
    return mix_sources(read(spark, folder, "documents"))


@query()
def op8_token_files(spark, folder):
    return token_file_digest(read(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query()
def op9_best_fit_packing(spark, folder):
    return pack_documents(read(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query()
def op3_quality_classifier(spark, folder):
    return score_quality(read(spark, folder, "documents"), read(spark, folder, "labels"))


@query()
def op1_suffix_array_dedup(spark, folder):
    return remove_repeated_bytes(read(spark, folder, "documents"))


@query()
def op2_substring_dedup(spark, folder):
    return remove_repeated_words(read(spark, folder, "documents"))


@query()
def op7_ngram_jaccard_join(spark, folder):
    return ngram_components(read(spark, folder, "documents"))


@query(r"""
WITH item_words AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark),
item_windows AS (
  SELECT DISTINCT item, least(10, len(words)) AS size,
         array_to_string(words[low : low + least(10, len(words)) - 1], ' ') AS name
  FROM (SELECT item, words, unnest(generate_series(1, greatest(1, len(words) - 9))) AS low FROM item_words WHERE len(words) > 0)),
doc_words AS (
  SELECT row_number() OVER () AS row_id, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
sizes AS (SELECT DISTINCT size FROM item_windows),
doc_windows AS (
  SELECT row_id, low, size, array_to_string(words[low : low + size - 1], ' ') AS name
  FROM (SELECT row_id, words, size, unnest(generate_series(1, len(words) - size + 1)) AS low
        FROM doc_words, sizes WHERE len(words) >= size)),
met AS (SELECT d.row_id, d.low, d.size, i.item FROM doc_windows d JOIN item_windows i ON d.size = i.size AND d.name = i.name),
hits AS (
  SELECT row_id, count(DISTINCT word) AS n_hit
  FROM (SELECT row_id, unnest(generate_series(low, low + size - 1)) AS word FROM (SELECT DISTINCT row_id, low, size FROM met))
  GROUP BY row_id),
items AS (
  SELECT row_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT row_id, item FROM met) GROUP BY row_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hits USING (row_id) LEFT JOIN items USING (row_id)
""")
def op11_benchmark_decontamination(spark, folder):
    return decontaminate(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


@query()
def op12_periodic_runs(spark, folder):
    return run_digest(periodic_documents(read(spark, folder, "documents")))


@query("""
WITH ids AS (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL),
bits AS (
  SELECT c, list_transform(generate_series(0, 8 * length(CAST(c AS VARCHAR)) - 1),
    lambda i: (ascii(substr(CAST(c AS VARCHAR), CAST(i // 8 + 1 AS BIGINT), 1)) >> CAST(i % 8 AS INTEGER)) & 1) AS bits FROM ids),
heads AS (
  SELECT c, c - c % 100 AS base,
    xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(bits, lambda b: CAST(b AS BIGINT))),
        lambda x, y: xor(x >> 1, CASE WHEN xor(x, y) & 1 = 1 THEN 3988292384 ELSE 0 END)), 4294967295) % 6 AS h FROM bits),
turns AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place,
    sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS name, length(coalesce(text, '')) AS chars
  FROM conversations WHERE conv_id IS NOT NULL),
rebuilt AS (
  SELECT h.c, t.place, t.name, t.chars FROM heads h JOIN turns t ON t.c = h.base AND t.place <= h.h
  UNION ALL SELECT h.c, t.place + 1000000, t.name, t.chars FROM heads h JOIN turns t ON t.c = h.c AND t.place > h.h),
paths AS (
  SELECT h.c, coalesce(list(r.name ORDER BY place) FILTER (r.name IS NOT NULL), []) AS names,
    coalesce(list(r.chars ORDER BY place) FILTER (r.name IS NOT NULL), []) AS sizes
  FROM heads h LEFT JOIN rebuilt r ON r.c = h.c GROUP BY h.c),
members AS (
  SELECT c, d, sha256(array_to_string(names[1:d], ',')) AS node, d = len(names) AS ends,
    CASE WHEN d > 0 THEN sha256(array_to_string(names[1:d - 1], ',')) END AS parent, CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS chars
  FROM (SELECT *, unnest(generate_series(0, len(names))) AS d FROM paths)),
nodes AS (
  SELECT node, d, any_value(parent) AS parent, any_value(chars) AS chars, min(c) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM members GROUP BY node, d),
children AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY parent),
below AS (
  SELECT a.node AS top, a.d AS top_d, n.node, n.d, n.n_convs, n.chars, c.n_children
  FROM nodes n JOIN members m ON m.c = n.conv_id AND m.d <= n.d JOIN nodes a ON a.node = m.node AND a.d = m.d
  LEFT JOIN children c ON c.node = n.node),
sums AS (
  SELECT top, top_d, count(*) FILTER (n_children IS NULL) AS n_leaves, sum((n_convs - 1) * chars) AS saved_tokens
  FROM below GROUP BY top, top_d)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children, s.n_leaves,
  CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n LEFT JOIN nodes p ON p.node = n.parent AND p.d = n.d - 1 LEFT JOIN children c ON c.node = n.node
JOIN sums s ON s.top = n.node AND s.top_d = n.d
""")
def op13_conversation_trie(spark, folder):
    return conversation_trie(read(spark, folder, "conversations"), block=100, heads=6)
