"""All named queries and their SQL."""

from __future__ import annotations

from tessera.plans import core, linked, relational, retrieval, textual

QUERIES, ORACLE_SQL = dict(core.QUERIES), dict(core.ORACLE_SQL)
for _module in (relational, linked, textual, retrieval):
    QUERIES |= _module.P.queries
    ORACLE_SQL |= _module.P.sql
