"""Registered queries of the subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockwatch.llm import (
    alignment, chat, embedding_dups, fingerprints, importance, jaccard, ngram_lm, packing, pieces, quality, topk, toxicity, urls,
)
from dockwatch.llm.shared import read_table

Query = Callable[[SparkSession, str], DataFrame]
#: Fixed values of the query: (host, path, verdict).
URL_RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"),
]
WORD_BPE = "word_bpe_49k.json"


def op1_sentencepiece(spark: SparkSession, d: str) -> DataFrame:
    model = pieces.Model.load(packing.tokenizer_path("piece_bpe_32k.model"))
    return pieces.encode(read_table(spark, d, "documents"), model, decoded=True)


def op2_exact_top_k(spark: SparkSession, d: str) -> DataFrame:
    return topk.exact_top_k(read_table(spark, d, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_toxicity(spark: SparkSession, d: str) -> DataFrame:
    return toxicity.score_documents(read_table(spark, d, "documents"), read_table(spark, d, "labels"))


def op4_embedding_near_dups(spark: SparkSession, d: str) -> DataFrame:
    return embedding_dups.near_duplicates(read_table(spark, d, "embeddings"))


def op5_quality_classifier(spark: SparkSession, d: str) -> DataFrame:
    return quality.score_documents(read_table(spark, d, "documents"), read_table(spark, d, "labels"))


def _lm_scores(s: DataFrame) -> DataFrame:
    # sums differ in the last digits with the order of addition
    return s.select("doc_id", "n_words", F.round("log_score", 4).alias("log_score"),
                    F.round("mean_log_score", 6).alias("mean_log_score"))


def op6_lm_scoring(spark: SparkSession, d: str) -> DataFrame:
    return _lm_scores(ngram_lm.score_by_folds(read_table(spark, d, "documents")))


def op6_lm_scoring_given_corpus(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "documents")
    return _lm_scores(ngram_lm.score_documents(docs, docs))


def op7_url_filters(spark: SparkSession, d: str) -> DataFrame:
    return urls.judge_urls(read_table(spark, d, "pages"), urls.rules_frame(spark, URL_RULES))


def op8_ngram_jaccard_join(spark: SparkSession, d: str) -> DataFrame:
    return jaccard.jaccard_links(read_table(spark, d, "documents"))


def op9_best_fit_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, d, "documents"), lambda: packing.tokenizer_path(WORD_BPE))


def op10_chat_formatting(spark: SparkSession, d: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                  "conv_id long, turn long, role string, text string")
    turns = read_table(spark, d, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    tree, paths = chat.prefix_tree(turns, lambda: packing.tokenizer_path("byte_bpe_50k.json"))
    return chat.read_back(tree, paths)


def op11_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    return fingerprints.fingerprint_versions(read_table(spark, d, "documents"))


def op12_tokenizer_alignment(spark: SparkSession, d: str) -> DataFrame:
    groups = F.col("groups")
    return alignment.align(
        read_table(spark, d, "documents"), lambda: packing.tokenizer_path("byte_bpe_50k.json"),
        lambda: packing.tokenizer_path("piece_bpe_32k.model"),
        groups_sha256=F.when(groups == "", "").otherwise(F.sha2(groups, 256)))


def op13_importance_resampling(spark: SparkSession, d: str) -> DataFrame:
    drawn = importance.resample(read_table(spark, d, "documents"), read_table(spark, d, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def queries() -> dict[str, Query]:
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}


OP2_SQL = """
WITH v AS (
    SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE) for x in embedding] AS q
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
      AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
    SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM s QUALIFY rank <= 20
"""


# rules only; no page of the given tables has a canonical link or a refresh redirect, and if one had
# the verdicts here would be null
OP7_SQL = """
WITH p AS (
    SELECT page_id, coalesce(CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END, '') AS rest,
           coalesce(regexp_matches(html, '(?i)canonical|refresh'), false) AS links
    FROM pages
), q AS (
    SELECT page_id, links, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                     'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM p
), rules(h, pre, v) AS (
    VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
           ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), fit AS (
    SELECT q.page_id, q.host, q.path, q.links, r.h || r.pre AS rule, r.v,
           row_number() OVER (PARTITION BY q.page_id ORDER BY length(r.h || r.pre) DESC NULLS LAST) AS k
    FROM q LEFT JOIN rules r ON (q.host = r.h OR ends_with(q.host, '.' || r.h)) AND starts_with(q.path, r.pre)
)
SELECT page_id, host, path, rule, CASE WHEN v IS NOT NULL THEN v WHEN NOT (SELECT bool_or(links) FROM q) THEN 'allow' END AS verdict
FROM fit WHERE k = 1
"""


OP6_GIVEN_SQL = """
WITH w AS (
    SELECT doc_id, [x for x in regexp_split_to_array(coalesce(text, ''), '\\s+') if x <> ''] AS ws FROM documents
), u AS (
    SELECT x, count(*) AS n FROM (SELECT unnest(ws) AS x FROM w) GROUP BY x
), g AS (
    SELECT doc_id, i, ws[i - 1] AS v, ws[i] AS x FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM w)
), b AS (
    SELECT v, x, count(*) AS n FROM g WHERE i > 1 GROUP BY v, x
), s AS (
    SELECT g.doc_id, CASE WHEN g.i = 1 THEN ln(ux.n / (SELECT sum(n) FROM u)::DOUBLE) ELSE ln(b.n / uv.n::DOUBLE) END AS s
    FROM g LEFT JOIN u ux ON g.x = ux.x LEFT JOIN u uv ON g.v = uv.x LEFT JOIN b ON g.i > 1 AND g.v = b.v AND g.x = b.x
), t AS (
    SELECT doc_id, sum(len(ws))::BIGINT AS n_words FROM w GROUP BY doc_id
)
SELECT t.doc_id, t.n_words, round(coalesce(sum(s.s), 0), 4) AS log_score, round(sum(s.s) / nullif(t.n_words, 0), 6) AS mean_log_score
FROM t LEFT JOIN s ON t.doc_id = s.doc_id GROUP BY t.doc_id, t.n_words
"""


OP6_SQL = """
WITH w AS (
    SELECT coalesce(doc_id, -9223372036854775808) AS doc_id, [x for x in regexp_split_to_array(coalesce(text, ''), '\\s+') if x <> ''] AS ws
    FROM documents
), d AS (
    SELECT *, md5(doc_id::VARCHAR)[1] AS f FROM w
), g AS (
    SELECT doc_id, f, i, ws[i - 1] AS v, ws[i] AS x FROM (SELECT doc_id, f, ws, unnest(range(1, len(ws) + 1)) AS i FROM d)
), uf AS (SELECT f, x, count(*) AS n FROM g GROUP BY f, x), u AS (SELECT x, sum(n) AS n FROM uf GROUP BY x),
bf AS (SELECT f, v, x, count(*) AS n FROM g WHERE i > 1 GROUP BY f, v, x), b AS (SELECT v, x, sum(n) AS n FROM bf GROUP BY v, x),
nf AS (SELECT f, greatest((SELECT sum(n) FROM uf) - sum(n), 1)::DOUBLE AS n FROM uf GROUP BY f),
c AS (
    SELECT g.doc_id, g.i, nf.n AS words, greatest(ux.n - xf.n, 1) AS cx, greatest(coalesce(uv.n - vf.n, 1), 1) AS cv,
           coalesce(b.n - bf.n, 0) AS cb
    FROM g JOIN nf ON g.f = nf.f JOIN u ux ON g.x = ux.x JOIN uf xf ON g.f = xf.f AND g.x = xf.x
    LEFT JOIN u uv ON g.v = uv.x LEFT JOIN uf vf ON g.f = vf.f AND g.v = vf.x
    LEFT JOIN b ON g.i > 1 AND g.v = b.v AND g.x = b.x LEFT JOIN bf ON g.i > 1 AND g.f = bf.f AND g.v = bf.v AND g.x = bf.x
), s AS (
    SELECT doc_id, sum(CASE WHEN i = 1 THEN ln(cx / words) WHEN cb > 0 THEN ln(cb / cv::DOUBLE) ELSE ln(0.4 * cx / words) END) AS s
    FROM c GROUP BY doc_id
), t AS (SELECT doc_id, sum(len(ws))::BIGINT AS n_words FROM w GROUP BY doc_id)
SELECT nullif(t.doc_id, -9223372036854775808) AS doc_id, t.n_words, round(coalesce(s.s, 0), 4) AS log_score,
       round(s.s / nullif(t.n_words, 0), 6) AS mean_log_score
FROM t LEFT JOIN s ON t.doc_id = s.doc_id
"""


# CRC-32 by a fold over the bytes of each distinct run of words
OP13_SQL = r"""
WITH crc_table AS (
    SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                            lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
    FROM (SELECT unnest(range(256)) AS i)
), words AS (
    SELECT *, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM (SELECT row_number() OVER () AS row, true AS own, doc_id, text FROM documents
          UNION ALL SELECT NULL, false, NULL, text FROM benchmark)
), runs AS (
    SELECT row, own, unnest(list_concat(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])),
        list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS f
    FROM words
), features AS (
    SELECT row, own, f, count(*) AS n FROM runs GROUP BY ALL
), hashed AS (
    SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, len(x) // 2 + 1),
                      lambda i: ('0x' || x[2 * i - 1:2 * i])::BIGINT)),
                  lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
    FROM (SELECT f, hex(encode(f)) AS x FROM (SELECT DISTINCT f FROM features)), crc_table
), totals AS (
    SELECT bucket, sum(n) FILTER (own) AS s, sum(n) FILTER (NOT own) AS t FROM features JOIN hashed USING (f) GROUP BY bucket
), gains AS (
    SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE
               / ((coalesce(s, 0) + 1)::DOUBLE * (coalesce(sum(t) OVER (), 0) + 10000)::DOUBLE)))::BIGINT AS gain
    FROM totals
), weights AS (
    SELECT row, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight
    FROM features JOIN hashed USING (f) JOIN gains USING (bucket) WHERE own GROUP BY row
), scored AS (
    SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('42:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT + 0.5::DOUBLE)
                                                      / 4294967296::DOUBLE)))::BIGINT AS score
    FROM words LEFT JOIN weights USING (row) WHERE own
), places AS (
    SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place,
           5 * count(*) FILTER (n_words >= 20) OVER () // 100 AS drawn
    FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= drawn THEN place END AS rank FROM places
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_exact_top_k": OP2_SQL, "op6_lm_scoring": OP6_SQL, "op6_lm_scoring_given_corpus": OP6_GIVEN_SQL, "op7_url_filters": OP7_SQL,
            "op13_importance_resampling": OP13_SQL}
