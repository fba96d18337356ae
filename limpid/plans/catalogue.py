"""All queries of the core, by name, with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from limpid.plans import general, reference, workflow

FLAGSHIP = "curate_pipeline"
#: Modules whose queries are kept in reference.QUERIES.
PARTS = (reference, workflow)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {**reference.QUERIES, **general.QUERIES}
ORACLES: dict[str, str] = {**reference.ORACLES, **general.ORACLES}
