"""All core queries and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tidewell.plans import behavior, models, problems, star
from tidewell.session import prepare

FLAGSHIP = "transactional_obt"
_MODULES = (star, models, behavior, problems)


Query = Callable[[SparkSession, str], DataFrame]


def prepared(query: Query) -> Query:
    """The query on a session that has the settings it expects."""

    @wraps(query)
    def run(spark: SparkSession, d: str) -> DataFrame:
        prepare(spark)
        return query(spark, d)

    return run


def queries() -> dict[str, Query]:
    return {k: prepared(q) for m in _MODULES for k, q in m.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {k: q for m in _MODULES for k, q in m.ORACLES.items()}
