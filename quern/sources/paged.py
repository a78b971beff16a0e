"""Sources that come page by page. What fetches a page and what waits are parameters, so that a dump can be replayed; a page is small, and each
becomes a row of JSON that Spark parses."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Seconds before each new attempt.
WAITS = (1, 4, 15, 60)


class FetchError(Exception):
    """A failed request; status is None for a network error."""

    def __init__(self, status: int | None, message: str = "") -> None:
        super().__init__(message or f"status {status}")
        self.status = status


def retrying(fetch: Callable[..., object], *args: object, sleep: Callable[[float], None] = time.sleep) -> object:
    """fetch(*args), up to five times where a network error, 429 or a server's error may pass; other errors are told at once."""
    for wait in (*WAITS, None):
        try:
            return fetch(*args)
        except FetchError as e:
            if wait is None or not (e.status is None or e.status == 429 or e.status >= 500):
                raise
            sleep(wait)
    raise AssertionError


def numbered(fetch: Callable[[int], dict], sleep: Callable[[float], None] = time.sleep) -> Iterator[dict]:
    """Pages 1 to lastPage (data, total, lastPage). An error if a page is empty, or if the rows aren't as many as the total says."""
    first = retrying(fetch, 1, sleep=sleep)
    last, total, rows = first.get("lastPage") or 0, first.get("total") or 0, 0
    if last < 1 or total <= 0:
        raise ValueError("the source is empty")
    for k in range(1, last + 1):
        page = first if k == 1 else retrying(fetch, k, sleep=sleep)
        if not page.get("data"):
            raise ValueError(f"page {k} is empty")
        rows += len(page["data"])
        yield page
    if rows != total:
        raise ValueError(f"{rows} of {total} rows")


def offset(fetch: Callable[[int], tuple[list[dict], int]], pause: float = 0.5, sleep: Callable[[float], None] = time.sleep) -> Iterator[list[dict]]:
    """Batches from an offset on, until there are as many rows as the total says or a batch is empty."""
    at = 0
    while True:
        rows, total = retrying(fetch, at, sleep=sleep)
        if not rows:
            return
        yield rows
        at += len(rows)
        if at >= total:
            return
        sleep(pause)


def table(spark: SparkSession, pages: Iterator[object], schema: str) -> DataFrame:
    """The rows of pages as a table of the schema; fields that it doesn't name are never read."""
    lines = [(json.dumps(p["data"] if isinstance(p, dict) else p),) for p in pages]
    return spark.createDataFrame(lines, "page string").select(F.explode(F.from_json("page", f"array<{schema}>")).alias("x")).select("x.*")


class _Group(InputPartition):
    def __init__(self, path: str) -> None:
        super().__init__(path)


class JsonPages(DataSource):
    """Replays a dump: spark.read.format("quern_pages").schema(...).load(folder) reads folder/*.json on a driver-visible path, a file a
    partition, each with an array of objects under data."""

    @classmethod
    def name(cls) -> str:
        return "quern_pages"

    def schema(self) -> str:
        return "value string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(schema, self.options)


class _Reader(DataSourceReader):
    def __init__(self, schema, options: dict) -> None:
        self.names, self.folder = schema.fieldNames(), options["path"]

    def partitions(self) -> list[InputPartition]:
        from pathlib import Path

        return [_Group(str(p)) for p in sorted(Path(self.folder.removeprefix("file:")).glob("*.json"))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        with open(partition.value, encoding="utf-8") as f:
            for row in json.load(f)["data"]:
                yield tuple(json.dumps(row) if self.names == ["value"] else row.get(n) for n in (self.names if self.names != ["value"] else ["value"]))
