"""The registry of queries and their DuckDB oracles."""

from __future__ import annotations

from tidemark.plans.ingest_oracle import INGEST_ORACLE
from tidemark.plans.ingest_queries import INGEST_QUERIES
from tidemark.plans.oracle import SEARCH_ORACLE
from tidemark.plans.quality_queries import QUALITY_ORACLE, QUALITY_QUERIES
from tidemark.plans.queries import SEARCH_QUERIES
from tidemark.plans.service_queries import SERVICE_ORACLE, SERVICE_QUERIES

QUERIES = {**SEARCH_QUERIES, **INGEST_QUERIES, **QUALITY_QUERIES, **SERVICE_QUERIES}
ORACLE = {**SEARCH_ORACLE, **INGEST_ORACLE, **QUALITY_ORACLE, **SERVICE_ORACLE}
