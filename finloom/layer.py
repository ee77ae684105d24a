"""A layer: named DataFrames, each built on first use."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from finloom.functions.joins import is_small
from finloom.sinks.tables import quoted


class Layer(Mapping):
    """Named DataFrames. A table nobody asks for is never planned, so a query over one fact does not
    touch the files of the others."""

    def __init__(self, makers: Mapping[str, Callable[[], DataFrame]]):
        self._makers = dict(makers)
        self._frames: dict[str, DataFrame] = {}
        self._small: dict[str, bool] = {}

    @classmethod
    def stored(cls, spark: SparkSession, schema: str, names: Iterable[str]) -> Layer:
        """The tables of a catalog schema."""
        return cls({name: lambda name=name: spark.table(quoted(f"{schema}.{name}")) for name in names})

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._makers[name]()
        return self._frames[name]

    def is_small(self, name: str) -> bool:
        """Whether a whole table stays under the bounds of a broadcast; measured once."""
        if name not in self._small:
            self._small[name] = is_small(self[name])
        return self._small[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)
