"""All queries of this subpackage, and the SQL for those that SQL can express."""

from __future__ import annotations

from . import queries_dedup, queries_mix, queries_rows, queries_scores, queries_texts, queries_vectors

MODULES = (queries_dedup, queries_mix, queries_rows, queries_scores, queries_texts, queries_vectors)
QUERIES = {k: v for m in MODULES for k, v in m.QUERIES.items()}
SQL = {k: v for m in MODULES for k, v in m.SQL.items()}
