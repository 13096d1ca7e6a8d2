"""Registration helper shared by the query modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import tune
from .views import Views, oracle


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.oracles: dict[str, str] = {}

    def query(self, name: str, sql: str | None = None):
        """Register a function of :class:`Views` under ``name`` with its check SQL."""

        def register(function: Callable[[Views], DataFrame]):
            def run(spark: SparkSession, folder: str) -> DataFrame:
                return function(Views(tune(spark), folder))

            run.__name__ = name
            self.queries[name] = run
            if sql is not None:
                self.oracles[name] = oracle(sql)
            return function

        return register
