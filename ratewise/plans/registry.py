"""Named query registry: Spark builder + DuckDB oracle text per name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ratewise.plans.views import with_views
from ratewise.sources.fixtures import Fixtures

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None, extra_views: dict[str, str] | None = None):
    """Register ``fn(fx: Fixtures) -> DataFrame`` as query ``name``.

    ``sql`` (optional) is the DuckDB oracle; fixture views it names are
    added as CTEs.  No ``sql`` means the result is checked by row count
    and by our own tests only (non-SQL operators: ALS, streams)."""
    def deco(fn: Callable[[Fixtures], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Fixtures(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = with_views(sql, extra_views)
        return fn
    return deco
