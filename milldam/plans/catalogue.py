"""The reference operators' queries by name, and the SQL that each is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from milldam.plans import ingestion, monitoring, stations

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = stations.QUERIES | ingestion.QUERIES | monitoring.QUERIES
ORACLE_SQL: dict[str, str] = stations.ORACLE_SQL | ingestion.ORACLE_SQL | monitoring.ORACLE_SQL
