"""Registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm import alignment, covertree, language, lm, mixing, pages, pieces, pii, repeats, secrets, simhash, tiling, tries
from millrace.llm.common import table

QUERIES, ORACLES = {}, {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    weights = mixing.quality_weights(table(spark, folder, "labels"))
    return mixing.mix(table(spark, folder, "documents"), weights).select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op1_mix_sources"] = r"""
WITH docs AS (
 SELECT d.doc_id, d.source, coalesce(len(regexp_extract_all(d.text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
  (-ln((('0x' || substr(md5(CAST(d.doc_id AS VARCHAR)), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0)) /
  CASE WHEN l.quality IS NULL THEN 1.0 WHEN l.quality > 0 THEN 2.0 ELSE 0.5 END AS k
 FROM documents d LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY 1) l ON d.doc_id = l.doc_id),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY 1),
weighed AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS w,
 row_number() OVER (ORDER BY source NULLS LAST) AS place, source_size * 3 AS cap FROM totals),
levels AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
 / sum(w) OVER (ORDER BY cap / w, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
final AS (SELECT arg_min(level, (cap / w, place)) AS level FROM levels WHERE level * w < cap),
targets AS (SELECT source, source_size, coalesce(least(cap::DOUBLE, final.level * w), cap::DOUBLE) AS target FROM levels, final),
placed AS (SELECT d.doc_id, d.size, t.source_size, t.target,
  CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size)::BIGINT ELSE 0 END AS epochs,
  sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.size, d.doc_id ROWS UNBOUNDED PRECEDING) AS up_to
 FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
 (least(epochs + CASE WHEN up_to - size / 2.0 < target - epochs * source_size THEN 1 ELSE 0 END, 3) * size)::BIGINT AS taken
FROM placed"""


@query
def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    from pyspark.sql import functions as F

    docs = table(spark, folder, "documents")
    found = language.predict(docs, language.train(docs), ["doc_id"])
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op5_find_secrets(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return secrets.digest(docs, secrets.train(docs))


@query
def op6_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return tiling.find_tests(table(spark, folder, "documents"), table(spark, folder, "benchmark"), ["doc_id"])


@query
def op8_simhash_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query
def op9_find_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digest(table(spark, folder, "documents"))


@query
def op7_embedding_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return covertree.near_duplicates(table(spark, folder, "embeddings"))


ORACLES["op7_embedding_duplicates"] = """
WITH RECURSIVE sound AS (
 SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
 WHERE label IS NOT NULL AND coalesce((SELECT bool_and(x IS NOT NULL AND isfinite(x)) AND bool_or(x <> 0) FROM unnest(embedding) t(x)), false)),
links AS (SELECT a.vec_id AS u, b.vec_id AS v FROM sound a JOIN sound b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
 WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT u, v FROM links UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u),
least AS (SELECT u, min(v) AS m FROM reach GROUP BY 1),
counts AS (SELECT u, count(*) AS n FROM links GROUP BY 1)
SELECT e.vec_id, coalesce(c.n, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(l.m, e.vec_id)) AS component_id,
 e.vec_id = least(e.vec_id, coalesce(l.m, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN counts c ON e.vec_id = c.u LEFT JOIN least l ON e.vec_id = l.u"""


@query
def op2_score_texts(spark: SparkSession, folder: str) -> DataFrame:
    return lm.score(table(spark, folder, "documents"))


@query
def op10_remove_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, folder, "documents"))


@query
def op3_extract_pages(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extract(table(spark, folder, "pages"))


@query
def op13_piece_codec(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.digest(table(spark, folder, "documents"), ["doc_id"], pieces.share(spark, public_tokenizers.path("piece_bpe_32k.model")))


@query
def op11_align_tokenizers(spark: SparkSession, folder: str) -> DataFrame:
    tokenizers = alignment.Tokenizers(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return alignment.align(table(spark, folder, "documents"), ["doc_id"], tokenizers)


@query
def op12_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return tries.trie(table(spark, folder, "conversations"))


ORACLES["op12_conversation_trie"] = """
WITH turns AS (SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, list({r: role, t: text} ORDER BY turn NULLS FIRST, role, text) AS l FROM turns GROUP BY c),
crc AS (SELECT c, CAST(c AS VARCHAR) AS s, 4294967295::BIGINT AS k, 1 AS i FROM own),
bits AS (SELECT i::BIGINT AS i, list_reduce(list_concat([i::BIGINT], range(8)), lambda a, x: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM range(256) t(i)),
tab AS (SELECT list(v ORDER BY i) AS v FROM bits),
h AS (SELECT c, (xor(list_reduce(list_concat([4294967295::BIGINT], [ord(x)::BIGINT for x in string_split(s, '')]),
  lambda a, x: xor(a >> 8, tab.v[(xor(a, x) & 255) + 1])), 4294967295) % 6)::INT AS h FROM crc, tab),
built AS (SELECT o.c, coalesce(b.l[1:h.h], []) || o.l[h.h + 1:] AS l FROM own o JOIN h USING (c) LEFT JOIN own b ON b.c = o.c - o.c % 100),
nodes AS (SELECT c, d, l[1:d] AS p, len(l) = d AS ended FROM built, LATERAL (SELECT unnest(range(len(l) + 1)) AS d)),
merged AS (SELECT p, d, min(c) AS conv_id, count(*) AS n, sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ended), '')) AS ends_sha256 FROM nodes GROUP BY 1, 2),
kids AS (SELECT p[1:d - 1] AS p, count(*) AS kids FROM merged WHERE d > 0 GROUP BY 1),
figures AS (SELECT m.*, coalesce(k.kids, 0) AS kids, (n - 1) * CASE WHEN d > 0 THEN length(m.p[d].t) ELSE 0 END AS own FROM merged m LEFT JOIN kids k ON m.p = k.p),
sums AS (SELECT p[1:a] AS p, sum((kids = 0)::BIGINT)::BIGINT AS n_leaves, sum(own)::BIGINT AS saved_tokens
 FROM figures, LATERAL (SELECT unnest(range(d + 1)) AS a) GROUP BY 1)
SELECT f.conv_id, f.d AS depth, q.conv_id AS parent_conv_id, f.n AS n_convs, f.kids AS n_children, s.n_leaves, s.saved_tokens, f.ends_sha256
FROM figures f JOIN sums s ON f.p = s.p LEFT JOIN merged q ON f.d > 0 AND q.p = f.p[1:f.d - 1]"""
