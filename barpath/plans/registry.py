"""Every query of the library by name, and the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from barpath.plans.binding import WITH, Views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, recursive: bool = False):
    """Register a function of the views. ``sql`` goes after the common views; it may begin with ', more AS (...)'."""

    def register(f: Callable[[Views], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(Views(spark, sf_dir))
        if sql:
            ORACLE_SQL[name] = (WITH.replace("WITH ", "WITH RECURSIVE ", 1) if recursive else WITH) + sql
        return f

    return register


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["flagship_top3"](spark, sf_dir)


from barpath.plans import row_queries, set_queries, entity_queries, file_queries  # noqa: E402, F401
