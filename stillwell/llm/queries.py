"""The operators over their whole tables, with production parameters, and their SQL."""

import public_tokenizers

from stillwell.llm.common import table

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function
    return register


@query("""
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER (PARTITION BY norm) AS kept,
       sha256(norm) AS text_sha256
FROM t
""")
def op10_exact_dedup(spark, sf_dir):
    from stillwell.llm.exact_dedup import exact_dedup
    return exact_dedup(table(spark, sf_dir, "documents"))


@query()
def op9_token_counts(spark, sf_dir):
    from stillwell.llm.token_counts import token_counts
    return token_counts(table(spark, sf_dir, "documents"),
                        public_tokenizers.path("word_bpe_49k.json"))


@query()
def op4_toxicity(spark, sf_dir):
    from stillwell.llm.toxicity import toxicity
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op5_near_dedup(spark, sf_dir):
    from stillwell.llm.near_dedup import near_dedup
    return near_dedup(table(spark, sf_dir, "documents"))


@query()
def op6_best_fit_packing(spark, sf_dir):
    from stillwell.llm.packing import best_fit_packing
    return best_fit_packing(table(spark, sf_dir, "documents"),
                            public_tokenizers.path("byte_bpe_50k.json"),
                            ranks=public_tokenizers.path("byte_bpe_50k.tiktoken"))


@query()
def op1_suffix_dedup(spark, sf_dir):
    from stillwell.llm.repeats import suffix_dedup
    return suffix_dedup(table(spark, sf_dir, "documents")).drop("kept")


URL_RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
             ("block", "net/es/"), ("block", "net/fr/"))


@query("""
WITH u AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '^(.*?)://([^/?#]*)', 2, 's'), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^(.*?)://[^/?#]*([^?#]*)', 2, 's'), '') AS path
  FROM pages),
r(verdict, host, path) AS (VALUES
  ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
  ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
m AS (
  SELECT u.page_id, r.host || r.path AS rule, r.verdict,
         row_number() OVER (PARTITION BY u.page_id ORDER BY length(r.host || r.path) DESC) AS n
  FROM u JOIN r ON (u.host = r.host OR ends_with(u.host, '.' || r.host))
               AND starts_with(u.path, r.path))
SELECT u.page_id, u.host, u.path, m.rule, coalesce(m.verdict, 'allow') AS verdict
FROM u LEFT JOIN m ON m.page_id = u.page_id AND m.n = 1
""")
def op7_url_filter(spark, sf_dir):
    from stillwell.llm.url_filter import url_filter
    return url_filter(table(spark, sf_dir, "pages"), list(URL_RULES))


@query()
def op8_html_text(spark, sf_dir):
    from stillwell.llm.html_text import html_text
    return html_text(table(spark, sf_dir, "pages"))


@query()
def op3_neighbours(spark, sf_dir):
    from stillwell.llm.neighbours import nearest
    return nearest(table(spark, sf_dir, "embeddings"), "id % 20 = 0")


@query()
def op2_mixing(spark, sf_dir):
    from stillwell.llm.mixing import mixing
    return mixing(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op13_sentence_pieces(spark, sf_dir):
    from stillwell.llm.sentence_pieces import encode_and_decode
    return encode_and_decode(table(spark, sf_dir, "documents"),
                             public_tokenizers.path("piece_bpe_32k.model"))


def _fields(*columns):
    """SQL of the digest over columns."""
    return "sha256(" + " || ".join(
        f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in columns) + ")"


def _tree(name, leaves):
    """SQL of all nodes of the trees over ``leaves`` (s, idx, n, digest), and of each one's siblings."""
    return f"""
{name}(s, level, idx, n, digest) AS (
  SELECT s, 0, idx, n, digest FROM {leaves}
  UNION ALL
  SELECT s, level + 1, idx // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY idx))
  FROM {name} WHERE n > 1 GROUP BY s, level, n, idx // 3),
{name}_beside AS (
  SELECT a.s, a.level, a.idx,
         coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS before,
         coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS after
  FROM {name} a LEFT JOIN {name} b ON a.s = b.s AND a.level = b.level AND a.idx // 3 = b.idx // 3
                                 AND a.idx <> b.idx
  WHERE a.n > 1 GROUP BY a.s, a.level, a.idx)"""


def _walk(name, start, tree):
    """SQL of the way of each row of ``start`` (r, s, level, idx, digest, proof) to its root."""
    return f"""
{name}(r, s, level, idx, digest, proof) AS (
  SELECT r, s, 0, idx, digest, proof FROM {start}
  UNION ALL
  SELECT w.r, w.s, w.level + 1, w.idx // 3, sha256(before || w.digest || after),
         w.proof || before || after
  FROM {name} w JOIN {tree}_beside b ON b.s = w.s AND b.level = w.level AND b.idx = w.idx)"""


@query(f"""
WITH RECURSIVE crc_steps AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z:
           CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps),
d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce('+' || source, '') AS s,
         {_fields("doc_id", "source", "lang", "n_chars", "text")} AS leaf,
         {_fields("doc_id", "source", "lang", "n_chars", "replace(text, chr(10), '')")} AS changed,
         coalesce(xor(4294967295, list_reduce(
           list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''),
                                                   lambda x: ascii(x)::BIGINT)),
           lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]))) % 2 = 0, false) AS tampered
  FROM documents, crc_steps),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
         count(*) OVER (PARTITION BY s) AS n, leaf AS digest FROM d),
{_tree("low", "leaves")},
subroots AS (
  SELECT s AS own, '' AS s, row_number() OVER (ORDER BY s) - 1 AS idx, count(*) OVER () AS n, digest,
         level AS top FROM low WHERE n = 1),
{_tree("high", "subroots")},
starts AS (
  SELECT r, s, idx, CASE WHEN tampered THEN changed ELSE leaf END AS digest, '' AS proof FROM leaves),
{_walk("up", "starts", "low")},
middle AS (
  SELECT u.r, '' AS s, p.idx, u.digest, u.proof FROM up u JOIN subroots p ON p.own = u.s
                                                                       AND p.top = u.level),
{_walk("over", "middle", "high")},
whole AS (SELECT digest AS root, level AS top FROM high WHERE n = 1)
SELECT l.doc_id, l.leaf, p.digest AS subroot, w.root, sha256(o.proof) AS proof_sha256,
       o.digest AS folded_root, o.digest = w.root AS verified
FROM over o JOIN whole w ON w.top = o.level JOIN leaves l ON l.r = o.r JOIN subroots p ON p.own = l.s
""")
def op11_merkle_manifest(spark, sf_dir):
    from stillwell.llm.merkle import tamper_check
    return tamper_check(table(spark, sf_dir, "documents"))


@query("""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         list_inner_product(a.x, b.x)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS n
  FROM s WHERE same),
g AS (
  SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score,
         s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
             AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
  WHERE p.n <= 5)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
FROM g WHERE rank <= 5
""")
def op12_hard_negatives(spark, sf_dir):
    from pyspark.sql import functions as F
    from stillwell.llm.hard_negatives import hard_negatives
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", label.alias("label"), "embedding")
    return hard_negatives(vectors, "id % 100 = 0")
