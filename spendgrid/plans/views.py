"""Named views: register query functions under names, run them by name.

The reference keeps its SQL in a dictionary and runs an entry by key; here
each entry is a function of the session that returns a DataFrame, and
running it also registers a temporary view under the same name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class ViewRegistry:
    def __init__(self):
        self._views: dict[str, Callable[[SparkSession], DataFrame]] = {}

    def add(self, name: str, build: Callable[[SparkSession], DataFrame]) -> None:
        self._views[name] = build

    def names(self) -> list[str]:
        return list(self._views)

    def run(self, spark: SparkSession, name: str) -> DataFrame:
        if name not in self._views:
            raise ValueError(f"no view is called {name!r}; there are {sorted(self._views)}")
        frame = self._views[name](spark)
        frame.createOrReplaceTempView(name)
        return frame
