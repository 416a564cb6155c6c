"""The library's queries by name, and the SQL that gives the same rows. EXAMPLES are queries over rows given in the code, for tests."""

from __future__ import annotations

from . import queries_aggregates, queries_functions, queries_library, queries_relational, queries_rules

QUERIES: dict = {}
ORACLE_SQL: dict = {}
EXAMPLES: dict = {}
for _module in (queries_functions, queries_relational, queries_aggregates, queries_rules, queries_library):
    QUERIES |= {name: run for name, (run, _) in _module.DEFINED.items()}
    ORACLE_SQL |= {name: sql for name, (_, sql) in _module.DEFINED.items() if sql}
    EXAMPLES |= _module.DEFINED.golden
