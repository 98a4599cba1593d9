"""Registry of the queries and of the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import lodestone

# Python functions travel with their code: executors need no copy of this library.
cloudpickle.register_pickle_by_value(lodestone)

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its name, with SQL that gives the same rows where there is one."""

    def add(f: Query) -> Query:
        if name in _queries:
            raise ValueError(f"{name} is registered twice")
        _queries[name] = f
        if oracle:
            _oracles[name] = oracle
        return f

    return add


def queries() -> dict[str, Query]:
    from lodestone import plans  # noqa: F401  registers its queries

    return dict(_queries)


def oracles() -> dict[str, str]:
    queries()
    return dict(_oracles)
