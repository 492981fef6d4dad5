"""All queries and their SQL counterparts."""

from __future__ import annotations

from tablefold.queries import annotation, extraction, parsing, preparation, privacy, statistics, writing

MODULES = [extraction, preparation, parsing, annotation, privacy, statistics, writing]

QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: sql.strip() for module in MODULES for name, sql in module.ORACLE.items()}
