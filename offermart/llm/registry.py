"""Where the queries of this subpackage register themselves, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None, tested_by: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its name. One that SQL cannot express names the tests with its plain version."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            ORACLES[fn.__name__] = oracle
        elif tested_by is not None:
            fn.tested_by = tested_by
        return fn

    return register
