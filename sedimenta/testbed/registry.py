"""Registration of queries and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        @wraps(fn)
        def in_utc(spark: SparkSession, sf: str) -> DataFrame:
            # the SQL twins read timestamps without a zone
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf)

        QUERIES[name] = in_utc
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add
