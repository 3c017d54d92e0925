"""The operators' queries over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from occulink.llm.common import table


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_least_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from occulink.llm.packing import pack

    pieces = pack(table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_bayesian_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from occulink.llm.jaccard import jaccard_join

    return jaccard_join(table(spark, sf_dir, "documents"))


def op3_content_defined_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from occulink.llm.linedup import EVERY, remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"), EVERY).select("doc_id", "removed_chunks", "removed_chars", "text")


def op4_va_file_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from occulink.llm.topk import top_k

    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op5_quality_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    from occulink.llm.classifiers import quality_scores

    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_one_bit_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from occulink.llm.onebit import nearest

    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op7_recursive_query_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from occulink.llm.bpe import digests

    return digests(table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op8_toxicity_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    from occulink.llm.classifiers import toxicity_scores

    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    from occulink.llm.backoff import backoff_scores

    return backoff_scores(table(spark, sf_dir, "documents"))


def op10_histogram_sort_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from occulink.llm.sharding import histogram_sort_shards

    return histogram_sort_shards(table(spark, sf_dir, "documents"), shards=40)


def op11_source_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from occulink.llm.divergence import divergence_audit

    return divergence_audit(table(spark, sf_dir, "documents"), min_docs=30, top=50)


def op12_multinomial_block_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from occulink.llm.mixing import Mixture, mix, taken_words

    return taken_words(mix(table(spark, sf_dir, "documents"), Mixture(weights=(3, 1, 2), share=1.5, most=2)))


def op13_pca_filtered_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from occulink.llm.centroids import centroid_clusters

    return centroid_clusters(table(spark, sf_dir, "embeddings"), k=40, rounds=5, dim=64, scale=256, seed=2)


ALL = {
    f.__name__: f
    for f in (
        op1_least_squares_packing,
        op2_bayesian_jaccard_join,
        op3_content_defined_line_dedup,
        op4_va_file_top_k,
        op5_quality_factorisation_machine,
        op6_one_bit_neighbours,
        op7_recursive_query_bpe,
        op8_toxicity_factorisation_machine,
        op9_stupid_backoff,
        op10_histogram_sort_shards,
        op11_source_divergence_audit,
        op12_multinomial_block_mixing,
        op13_pca_filtered_centroids,
    )
}

ORACLE_SQL = {
    "op4_va_file_top_k": """
        WITH v AS (
            SELECT row_number() OVER () AS row, vec_id,
                   list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS z
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT q.row AS q_row, q.vec_id AS query_id, c.row, c.vec_id,
                   CAST(list_sum(list_transform(list_zip(q.z, c.z), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM v q JOIN v c ON q.row <> c.row AND len(q.z) = len(c.z)
            WHERE q.vec_id % 100 = 0),
        r AS (
            SELECT query_id, vec_id, score,
                   CAST(row_number() OVER (PARTITION BY q_row ORDER BY score DESC, vec_id, row) AS INTEGER) AS rank
            FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
    "op9_stupid_backoff": r"""
        WITH docs AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
        words AS (
            SELECT row, list_filter(regexp_split_to_array(lower(text), '\s+'), lambda x: x <> '') AS w FROM docs),
        g AS (
            SELECT row, unnest(w) AS w2, unnest(list_prepend(NULL, w)[:len(w)]) AS w1,
                   unnest(list_prepend(NULL, list_prepend(NULL, w))[:len(w)]) AS w0
            FROM words WHERE len(w) > 0),
        n AS (
            SELECT row, count(*) OVER (PARTITION BY w0, w1, w2) - 1 AS n3, count(*) OVER (PARTITION BY w0, w1) - 1 AS c3,
                   count(*) OVER (PARTITION BY w1, w2) - 1 AS n2, count(*) OVER (PARTITION BY w1) - 1 AS c2,
                   count(*) OVER (PARTITION BY w2) - 1 AS n1, count(*) OVER () AS total
            FROM g),
        s AS (
            SELECT row, count(*) AS n_words,
                   sum(ln(CASE WHEN n3 > 0 THEN n3 / c3 WHEN n2 > 0 THEN n2 / c2 * 0.4::DOUBLE
                               ELSE greatest(n1, 1) / total * 0.4::DOUBLE * 0.4::DOUBLE END)) AS total_log
            FROM n GROUP BY row)
        SELECT doc_id, coalesce(n_words, 0) AS n_words, round(coalesce(total_log, 0), 6) AS log_score,
               round(total_log / n_words, 6) AS mean_log
        FROM docs LEFT JOIN s USING (row)""",
}

ORACLE_SQL["op11_source_divergence_audit"] = r"""
        WITH d AS (
            SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
            FROM documents),
        t AS MATERIALIZED (
            SELECT row, lang, source, term, count(*) AS n
            FROM (SELECT row, lang, source,
                         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d)
            GROUP BY ALL),
        kept AS MATERIALIZED (SELECT lang, term, sum(n) AS total FROM t GROUP BY lang, term HAVING count(*) >= 30),
        langs AS (SELECT lang, count(*) AS v, sum(total) AS total FROM kept GROUP BY lang),
        own AS MATERIALIZED (SELECT lang, source, term, sum(n) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
        g AS MATERIALIZED (
            SELECT lang, source, coalesce(any_value(langs.v), 0) AS v, any_value(langs.total) AS lang_total,
                   coalesce((SELECT sum(n) FROM own WHERE own.lang = d.lang AND own.source = d.source), 0) AS total
            FROM d LEFT JOIN langs USING (lang) GROUP BY lang, source),
        cells AS MATERIALIZED (
            SELECT g.lang, g.source, kept.term, coalesce(own.n, 0) AS n,
                   1 + (1000000000::HUGEINT * (coalesce(own.n, 0) + 5)::HUGEINT) // (g.total + 5 * g.v)::HUGEINT AS p,
                   1 + (1000000000::HUGEINT * (kept.total + 5)::HUGEINT) // (g.lang_total + 5 * g.v)::HUGEINT AS q
            FROM g JOIN kept USING (lang) LEFT JOIN own ON own.lang = g.lang AND own.source = g.source AND own.term = kept.term),
        sums AS (
            SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
            FROM cells a JOIN cells b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
        parts AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sums.value, 0) AS value
            FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source
            UNION ALL
            SELECT lang, source, 'term', term, p - q FROM cells WHERE n > 0 AND p > q),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
        FROM ranked WHERE part = 'pair' OR rank <= 50"""

_ASSIGN = """
        a{i} AS MATERIALIZED (
            SELECT row, arg_min(c, (d, c)) AS c, min(d) AS d
            FROM (SELECT v.row, k.c, list_sum(list_transform(list_zip(v.z, k.z), lambda p: CAST((p[1] - p[2]) * (p[1] - p[2]) AS HUGEINT))) AS d
                  FROM v, k{i} k) GROUP BY row),"""
_MOVE = """
        m{i} AS (
            SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS z
            FROM (SELECT a.c, j.i, sum(v.z[j.i]) AS s, count(*) AS n FROM a{i} a JOIN v USING (row), range(1, 65) AS j(i) GROUP BY a.c, j.i) GROUP BY c),
        k{j} AS MATERIALIZED (SELECT k.c, coalesce(m.z, k.z) AS z FROM k{i} k LEFT JOIN m{i} m USING (c)),"""
ORACLE_SQL["op13_pca_filtered_centroids"] = (
    """
        WITH v AS MATERIALIZED (
            SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS z
            FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        k0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), z) - 1 AS c, z FROM v
            QUALIFY row_number() OVER (ORDER BY sha256('2:' || vec_id), z) <= 40),"""
    + "".join(_ASSIGN.format(i=i) + _MOVE.format(i=i, j=i + 1) for i in range(5))
    + _ASSIGN.format(i=5)
    + """
        s AS (SELECT c, sum(d) AS own FROM a5 GROUP BY c)
        SELECT v.vec_id, CAST(a5.c AS INTEGER) AS cluster, CAST(a5.d AS BIGINT) AS distance, CAST(s.own AS BIGINT) AS cluster_inertia,
               CAST((SELECT sum(own) FROM s) AS BIGINT) AS inertia, sha256(array_to_string(k5.z, ',')) AS centroid_sha256
        FROM a5 JOIN v USING (row) JOIN s USING (c) JOIN k5 USING (c)"""
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(ALL)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
