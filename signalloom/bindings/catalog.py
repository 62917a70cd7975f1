"""All registered queries and their check SQL."""

from __future__ import annotations

from . import accounts, files, ingest, rollup, runs, state, text, views

_MODULES = (text, accounts, rollup, state, views, ingest, runs, files)
QUERIES = {name: query for m in _MODULES for name, query in m.QUERIES.items()}
SQL = {name: sql for m in _MODULES for name, sql in m.SQL.items()}
