"""All registered queries of the library and their DuckDB SQL."""

from __future__ import annotations

from . import imports, oracle, panel, testdata

QUERIES = {**testdata.QUERIES, **panel.QUERIES, **imports.QUERIES}
ORACLE_SQL = {**oracle.ORACLE_SQL, **panel.ORACLE_SQL, **imports.ORACLE_SQL}
