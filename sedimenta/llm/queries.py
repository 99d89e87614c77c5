"""Registered queries of the operators, each over a whole table, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm import (
    alignment,
    bpe,
    context_tree,
    exact_dedup,
    html,
    importance,
    jaccard,
    kneser_ney,
    language,
    mixing,
    neighbours,
    order_minhash,
    toxicity,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(n: int) -> Column:
    """crc32 of the document's id as text, modulo ``n``; NULL ids count as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % n


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.groups(table(spark, sf_dir, "documents"), width=4, num=85, den=100)
    return found.select("doc_id", "n_shingles", "component_id")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = kneser_ney.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "perplexity", "threshold", "kept")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").filter(remainder(4) != 2))
    return judged.select("doc_id", (remainder(4) == 2).alias("held_out"), "score", "predicted")


def op6_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = context_tree.score(table(spark, sf_dir, "documents"), remainder(7) != 2)
    return scored.select("doc_id", (remainder(7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs.filter(remainder(3) != 1))
    return language.predict(docs, model).select("doc_id", (remainder(3) == 1).alias("held_out"), "lang_pred", "score")


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op11_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.compare_edited(table(spark, sf_dir, "documents"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.link_counts(table(spark, sf_dir, "documents"), *paths)


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_mixing": op2_mixing,
    "op3_jaccard": op3_jaccard,
    "op4_quality": op4_quality,
    "op5_toxicity": op5_toxicity,
    "op6_context_tree": op6_context_tree,
    "op7_html": op7_html,
    "op8_language": op8_language,
    "op9_bpe": op9_bpe,
    "op10_neighbours": op10_neighbours,
    "op11_order_minhash": op11_order_minhash,
    "op12_alignment": op12_alignment,
    "op13_importance": op13_importance,
}

ORACLES = {
    "op1_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t, length(coalesce(text, '')) AS n FROM documents),
        r AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY n DESC, doc_id NULLS LAST) AS k FROM d)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY t) AS group_size, k = 1 AS kept,
               sha256(t) AS text_sha256
        FROM r WINDOW w AS (PARTITION BY t ORDER BY k)""",
    "op2_mixing": r"""
        WITH d AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
        s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
        w AS (SELECT *, [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM s),
        -- The level at which targets meet the budget: sources reach their cap in order of cap to weight.
        c AS (SELECT *, 1.5::DOUBLE * sum(source_size) OVER () AS budget, sum(weight) OVER () AS weights,
                     coalesce(sum(2 * source_size) OVER (ORDER BY source_size::DOUBLE / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
                     coalesce(sum(weight) OVER (ORDER BY source_size::DOUBLE / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used
              FROM w),
        l AS (SELECT arg_min((budget - capped) / (weights - used), used) AS level FROM c
              WHERE (budget - capped) / (weights - used) * weight <= 2.0 * source_size),
        t AS (SELECT source, source_size, least(2.0::DOUBLE * source_size, weight * level)::DOUBLE AS target FROM w, l),
        r AS (SELECT d.*, t.source_size, t.target, CASE WHEN t.source_size = 0 THEN 0 ELSE t.target / t.source_size END AS rate,
                     row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id) AS k
              FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
        SELECT doc_id, size, source_size, target,
               (size * (floor(rate * k + 0.3819660112501051) - floor(rate * (k - 1) + 0.3819660112501051)))::BIGINT AS taken
        FROM r""",
    "op3_jaccard": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        s AS (SELECT doc_id, CASE WHEN len(w) >= 4 THEN list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))
                                  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS g FROM d),
        n AS (SELECT doc_id, len(g) AS n FROM s),
        e AS (SELECT doc_id, unnest(g) AS g FROM s),
        p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
        l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 85 * (a.n + b.n - k)),
        r AS (SELECT doc_id, doc_id AS c FROM n UNION SELECT r.doc_id, l.y FROM r JOIN l ON l.x = r.c)
        SELECT n.doc_id, n.n::BIGINT AS n_shingles, min(r.c) AS component_id FROM n JOIN r USING (doc_id) GROUP BY 1, 2""",
    "op13_importance": r"""
        WITH
        -- CRC-32 by half bytes, the low one first; a table entry is four steps of the polynomial.
        steps AS (SELECT i, list_reduce(range(4), lambda c, j: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS v FROM range(16) t(i)),
        half AS (SELECT list(v ORDER BY i) AS t FROM steps),
        texts AS (
            SELECT 0 AS side, doc_id, text FROM documents UNION ALL SELECT 1, NULL, text FROM benchmark),
        words AS MATERIALIZED (
            SELECT side, doc_id, row_number() OVER () AS r,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM texts),
        each AS (SELECT side, r, unnest(w) AS word FROM words),
        bytes AS (SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM each)),
        halves AS (
            SELECT word, list_transform(range(2 * (length(h) // 2)), lambda i: strpos('0123456789ABCDEF', h[i + 2 - 2 * (i % 2)]) - 1) AS n FROM bytes),
        hashed AS (
            SELECT word, xor(list_reduce(n, lambda c, x: xor(c >> 4, t[1 + (xor(c, x) & 15)]), 4294967295), 4294967295) % 10000 AS bucket FROM halves, half),
        counts AS (SELECT bucket, sum((1 - side)::BIGINT) AS s, sum(side::BIGINT) AS t FROM each JOIN hashed USING (word) GROUP BY bucket),
        sums AS (SELECT coalesce(sum(s), 0)::DOUBLE AS all_s, coalesce(sum(t), 0)::DOUBLE AS all_t FROM counts),
        gains AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (all_s + 10000) / ((s + 1)::DOUBLE * (all_t + 10000))))::BIGINT AS gain FROM counts, sums),
        weights AS (SELECT r, sum(gain)::BIGINT AS weight FROM each JOIN hashed USING (word) JOIN gains USING (bucket) WHERE side = 0 GROUP BY r),
        scored AS (
            SELECT doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
                   (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score
            FROM words LEFT JOIN weights USING (r) WHERE side = 0),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features) AS k,
                   count(*) FILTER (n_features >= 20) OVER () AS n FROM scored)
        SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND k <= 10 * n // 100 THEN k END::BIGINT AS rank FROM placed""",
}
