"""A Python data source: subclass ``ItemSource``, and a failing item is skipped."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def with_retries(call: Callable, *, attempts: int = 4, first_wait: float = 1.0, longest_wait: float = 30.0, factor: float = 2.0, sleep=time.sleep):
    """``call()``, again after growing waits if input, connection or time fails it."""
    wait = first_wait
    for left in range(attempts - 1, -1, -1):
        try:
            return call()
        except (OSError, TimeoutError):
            if not left:
                raise
            sleep(min(wait, longest_wait))
            wait *= factor


class _Items(InputPartition):
    def __init__(self, items: list):
        self.items = items


class ItemReader(DataSourceReader):
    """Reads each item of a list; what fails is left out, or given as an error row."""

    def __init__(self, items: list, fetch: Callable, per_partition: int, keep_errors: bool):
        self.items, self.fetch, self.per_partition, self.keep_errors = items, fetch, per_partition, keep_errors

    def partitions(self) -> list[InputPartition]:
        n = self.per_partition
        return [_Items(self.items[k : k + n]) for k in range(0, len(self.items), n)] or [_Items([])]

    def read(self, partition: _Items) -> Iterator[tuple]:
        for item in partition.items:
            try:
                yield (item, with_retries(lambda item=item: self.fetch(item)), None)
            except Exception as e:  # noqa: BLE001 - one bad item must not end the scan
                if self.keep_errors:
                    yield (item, None, str(e))


class ItemSource(DataSource):
    """Base of sources: override ``items`` and ``fetch``; rows are (item, body, error)."""

    @classmethod
    def name(cls) -> str:
        return "millrace_items"

    def schema(self) -> str:
        return "item string, body string, error string"

    def items(self) -> list[str]:
        return [x for x in self.options.get("items", "").split("\n") if x]

    @staticmethod
    def fetch(item: str) -> str:
        with open(item, encoding="utf-8") as f:
            return f.read()

    def reader(self, schema) -> DataSourceReader:
        return ItemReader(self.items(), self.fetch, int(self.options.get("per_partition", "16")), self.options.get("errors", "false") == "true")
