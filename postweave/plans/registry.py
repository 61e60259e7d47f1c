"""All queries of the core, by name, and the SQL each is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from postweave.plans import data_queries, reference_queries

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {**reference_queries.QUERIES, **data_queries.QUERIES}
SQL: dict[str, str] = {**reference_queries.SQL, **data_queries.SQL}
