"""Extension points: own episode sources as Spark data sources, generators as table functions."""

from __future__ import annotations

import importlib
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: What a source yields for each frame.
SCHEMA = "source string, source_episode string, frame_index bigint, task string, state array<double>, action array<double>"


class _Episode(InputPartition):
    def __init__(self, name: str):
        self.name = name


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        module, cls = options["class"].rsplit(".", 1)
        self.source = getattr(importlib.import_module(module), cls)(options.get("path", ""))

    def partitions(self) -> list[_Episode]:
        return [_Episode(n) for n in self.source.episodes()]

    def read(self, partition: _Episode) -> Iterator[tuple]:
        for i, (task, state, action) in enumerate(self.source.frames(partition.name)):
            yield (self.source.name, partition.name, i, task, [float(x) for x in state], [float(x) for x in action])


class EpisodeSource(DataSource):
    """Format 'episodes': option ``class`` names a class made with the path, with ``name``, ``episodes()`` and ``frames(episode)`` (UD5).

    Every episode is one task. The class must be importable on the executors.
    """

    @classmethod
    def name(cls) -> str:
        return "episodes"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(EpisodeSource)


def from_generator(names: DataFrame, make: Callable[[str], Iterable[tuple]], column: str = "source_episode") -> DataFrame:
    """The frames that ``make(name)`` yields for every name, as (task, state, action) tuples (UD6)."""

    def run(it):
        import pandas as pd

        for pdf in it:
            for n in pdf[column]:
                rows = [("generated", n, i, t, list(map(float, s)), list(map(float, a))) for i, (t, s, a) in enumerate(make(n))]
                yield pd.DataFrame(rows, columns=["source", "source_episode", "frame_index", "task", "state", "action"])

    return names.select(column).mapInPandas(run, SCHEMA)
