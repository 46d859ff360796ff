"""Every registered query and, where SQL can say it, the same in ANSI SQL."""

from __future__ import annotations

from tidewater.plans import features, jobs, operations, records, streams

QUERIES = features.QUERIES | operations.QUERIES | records.QUERIES | streams.QUERIES | jobs.QUERIES
ORACLE_SQL = features.ORACLE_SQL | operations.ORACLE_SQL | records.ORACLE_SQL | streams.ORACLE_SQL | jobs.ORACLE_SQL
