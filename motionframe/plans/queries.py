"""The queries of the catalogue, and the SQL that checks them."""

from __future__ import annotations

from . import queries_augment, queries_catalog, queries_frames, queries_runs, queries_tracks

MODULES = (queries_tracks, queries_catalog, queries_augment, queries_runs, queries_frames)
QUERIES = {k: v for m in MODULES for k, v in m.QUERIES.items()}
SQL = {k: v for m in MODULES for k, v in m.SQL.items()}
