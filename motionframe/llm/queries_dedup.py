"""Queries of the operators that compare documents with each other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import neardup, substrings
from .frames import table


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove(table(spark, sf_dir, "documents"), digest=True)


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


QUERIES = {"op5_substring_dedup": op5_substring_dedup, "op6_minhash": op6_minhash}

SQL = {
    "op5_substring_dedup": r"""
        WITH doc AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
        win AS (SELECT doc_id, i, w[i:i + 12] AS run FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM doc WHERE len(w) >= 13)),
        dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY run) AS first_id FROM win) WHERE first_id < doc_id),
        gone AS (SELECT DISTINCT doc_id, i + j AS k FROM dup, range(13) AS r(j)),
        lost AS (SELECT doc_id, list(k) AS ks FROM gone GROUP BY doc_id),
        word AS (SELECT d.doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM doc d JOIN lost USING (doc_id)),
        kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY k) AS text FROM word ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id)
        SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(len(l.ks), 0)::BIGINT AS n_removed,
               sha256(CASE WHEN l.ks IS NULL THEN array_to_string(w, ' ') ELSE coalesce(k.text, '') END) AS kept_sha256
        FROM doc d LEFT JOIN lost l USING (doc_id) LEFT JOIN kept k USING (doc_id)
    """,
    "op6_minhash": r"""
        WITH RECURSIVE doc AS (
            SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
        sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w]
                 ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: w[i:i + 4])) END AS s FROM doc),
        item AS (SELECT doc_id, unnest(s) AS sh FROM sets),
        common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM item a JOIN item b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL),
        link AS (SELECT a, b FROM common c JOIN sets x ON x.doc_id = c.a JOIN sets y ON y.doc_id = c.b WHERE 100 * n >= 85 * (len(x.s) + len(y.s) - n)),
        both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
        reach AS (SELECT doc_id AS id, doc_id AS root FROM doc UNION SELECT l.b, r.root FROM reach r JOIN both_ways l ON l.a = r.id),
        comp AS (SELECT id, min(root) AS component_id FROM reach GROUP BY id)
        SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN comp ON id = doc_id
    """,
}
