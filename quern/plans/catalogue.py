"""All queries of the engine's own operators, with the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quern.plans import analysis, contracts, curation

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {**curation.QUERIES, **analysis.QUERIES, **contracts.QUERIES}
ORACLES: dict[str, str] = {**curation.ORACLES, **analysis.ORACLES, **contracts.ORACLES}
