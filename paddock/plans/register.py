"""Where queries are registered with DuckDB SQL of the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import views
from .views import Views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str, with_views: bool = True):
    def register(function: Callable[[Views], DataFrame]):
        QUERIES[name] = lambda spark, folder: function(Views(spark, folder))
        body = sql.strip()
        if with_views:
            body = f"WITH {views.SQL}{', ' + body[5:] if body.startswith('WITH ') else body}"
        SQL[name] = body
        return function

    return register
