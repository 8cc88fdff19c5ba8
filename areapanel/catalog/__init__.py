"""Named queries over the given tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import apply_runtime_conf

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Collects queries; ``sql`` is left out where SQL cannot express the operator."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def __call__(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def add(fn: Query) -> Query:
            def run(spark: SparkSession, sf_dir: str) -> DataFrame:
                return fn(apply_runtime_conf(spark), sf_dir)

            run.__name__, run.__doc__ = name, fn.__doc__
            self.queries[name] = run
            if sql is not None:
                self.sql[name] = sql
            return fn

        return add

    def merge(self, *others: "Registry") -> "Registry":
        for other in others:
            self.queries.update(other.queries)
            self.sql.update(other.sql)
        return self


def registry() -> Registry:
    from . import chains, events, panel, profiles, quality, scalars, scoring, spatial

    return Registry().merge(
        panel.query, scalars.query, events.query, spatial.query, profiles.query, quality.query, scoring.query, chains.query
    )
