"""Named queries with their SQL twins."""

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgertone.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = build
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return register


def scratch_database(spark: SparkSession) -> str:
    """A database of its own on shared storage, for queries about table writes."""
    name = f"ledgertone_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, name)}'")
    return name
