"""Documents asked for by season and round, as a Spark data source.

A request is one (season, round). Spark deals the requests to tasks; a task asks the caller's
``fetch`` for each of its own, so the driver sees no document. ``fetch(season, round)`` gives the
documents of a request, page by page, or nothing where the round was not held. It travels to the
executors and must be picklable. A failed call is made again after a growing pause; what fails
``attempts`` times fails the task, which Spark then runs again elsewhere.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyarrow import RecordBatch
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .documents import SEQ

Fetch = Callable[[int, int], Iterable[str]]

_REQUEST = T.StructType([T.StructField(c, T.IntegerType()) for c in ("season", "round", "page")])
_SCHEMA = T.StructType([T.StructField("value", T.StringType()), T.StructField(SEQ, _REQUEST)])
PAGES_PER_BATCH = 1000  # pages that travel to Spark at a time


class Requests(InputPartition):
    """Rounds ``first`` to ``last`` of one season."""

    def __init__(self, season: int, first: int, last: int):
        super().__init__((season, first, last))


class RequestReader(DataSourceReader):
    def __init__(self, fetch: Fetch, plan: list[Requests], attempts: int, pause: float):
        self.fetch, self.plan, self.attempts, self.pause = fetch, plan, attempts, pause

    def partitions(self) -> list[Requests]:
        return self.plan

    def read(self, partition: Requests) -> Iterator[RecordBatch]:
        season, first, last = partition.value
        for number in range(first, last + 1):
            texts = self._documents(season, number)
            for begin in range(0, len(texts), PAGES_PER_BATCH):
                some = texts[begin : begin + PAGES_PER_BATCH]
                pages = range(begin, begin + len(some))
                place = [pa.array(c, pa.int32()) for c in ([season] * len(some), [number] * len(some), pages)]
                asked = pa.StructArray.from_arrays(place, _REQUEST.names)
                yield RecordBatch.from_arrays([pa.array(some, pa.string()), asked], _SCHEMA.names)

    def _documents(self, season: int, number: int) -> list[str]:
        """All pages of one request, or none: a call that breaks off gives no part of them."""
        for attempt in range(1, self.attempts + 1):
            try:
                return list(self.fetch(season, number))
            except Exception:
                if attempt == self.attempts:
                    raise
                time.sleep(self.pause * 2 ** (attempt - 1))
        return []


def request_source(
    fetch: Fetch, plan: list[Requests], attempts: int, pause: float
) -> type[DataSource]:
    """A data source that asks ``fetch`` for the requests of ``plan``."""

    class RequestSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return "requests"

        def schema(self) -> T.StructType:
            return _SCHEMA

        def reader(self, schema: T.StructType) -> DataSourceReader:
            return RequestReader(fetch, plan, attempts, pause)

    return RequestSource


def read_requests(
    spark: SparkSession,
    fetch: Fetch,
    seasons: Iterable[int],
    first: int,
    last: int,
    rounds_per_task: int = 1,
    attempts: int = 5,
    pause: float = 1.0,
) -> DataFrame:
    """The documents of rounds ``first`` to ``last`` of every season.

    ``value`` holds a document and ``_seq`` its season, round and page. The requests are made when
    the result is read, each time it is read: land them with ``write_documents`` to read them twice.
    """
    if rounds_per_task < 1 or attempts < 1:
        raise ValueError("rounds_per_task and attempts are at least 1")
    plan = [
        Requests(season, begin, min(begin + rounds_per_task - 1, last))
        for season in seasons
        for begin in range(first, last + 1, rounds_per_task)
    ]
    if not plan:
        return spark.createDataFrame([], _SCHEMA)
    spark.dataSource.register(request_source(fetch, plan, attempts, pause))
    return spark.read.format("requests").load()
