"""A paged remote table as a Spark source."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan,
    LessThanOrEqual,
)


@dataclass
class PageRange(InputPartition):
    """Rows at key positions ``low <= key < high``, to be read ``page`` positions at a time."""

    low: int
    high: int
    page: int


def _narrowed(filters: list[Filter], key: str, low: int, high: int) -> tuple[int, int, list[Filter]]:
    """The key range that filters leave, and the filters that Spark still has to apply."""
    left = []
    for f in filters:
        value = getattr(f, "value", None)
        if getattr(f, "attribute", None) != (key,):
            left.append(f)
        elif isinstance(f, IsNotNull):
            continue  # a key is never null
        elif isinstance(f, In) and f.value and all(type(v) is int for v in f.value):
            low, high = max(low, min(f.value)), min(high, max(f.value) + 1)
            left.append(f)  # the range may hold other keys
        elif type(value) is not int:
            left.append(f)
        elif isinstance(f, (EqualTo, EqualNullSafe)):
            low, high = max(low, value), min(high, value + 1)
        elif isinstance(f, GreaterThan):
            low = max(low, value + 1)
        elif isinstance(f, GreaterThanOrEqual):
            low = max(low, value)
        elif isinstance(f, LessThan):
            high = min(high, value)
        elif isinstance(f, LessThanOrEqual):
            high = min(high, value + 1)
        else:
            left.append(f)
    return low, high, left


def paged_source(bounds: Callable[[], tuple[int, int]], fetch: Callable[[int, int], Iterator[tuple]], schema: str,
                 name: str = "paged", key: str | None = None, cuts: Callable[[int, int, int], list[int]] | None = None) -> type[DataSource]:
    """A source for ``spark.read.format(name)`` once registered with ``spark.dataSource.register``.

    ``bounds()`` gives the first key and the key after the last; ``fetch(low, high)`` yields the rows
    with ``low <= key < high`` as tuples. Pages are ranges of a stated key, not offsets: ranges stay
    disjoint however the table is ordered or grows, and a lost task simply reads its range again.

    With the ``key`` column named, comparisons of it with whole numbers narrow the range before pages are
    planned, so pages outside a query's window are never asked for (the session needs
    ``spark.sql.python.filterPushdown.enabled``). ``cuts(low, high, n)`` gives up to n - 1 keys at quantiles of
    the range's rows: tasks then begin and end there, and gaps or crowds of keys do not make them unequal.

    Options: ``pagesize`` (keys per call), ``pagespertask``, and ``maxtasks``, within which a wide span of
    keys is divided, so that the number of tasks does not follow the keys.
    """

    class PagedReader(DataSourceReader):
        def __init__(self, options: dict):
            self.page = int(options.get("pagesize", 1000))
            self.span = self.page * int(options.get("pagespertask", 16))
            self.tasks = int(options.get("maxtasks", 10_000))
            self.range: tuple[int, int] | None = None

        def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
            if key is None:
                yield from filters
                return
            low, high, left = _narrowed(filters, key, *bounds())
            self.range = (low, max(low, high))
            yield from left

        def partitions(self) -> list[PageRange]:
            first, stop = self.range or bounds()
            if first >= stop:
                return [PageRange(first, first, self.page)]  # without any, Spark would read once without a range
            pages = -(-(stop - first) // self.page)
            span = max(self.span, self.page * -(-pages // self.tasks))
            if cuts is None:
                return [PageRange(low, min(low + span, stop), self.page) for low in range(first, stop, span)]
            wanted = -(-(stop - first) // span)
            edges = sorted({first, stop, *(c for c in cuts(first, stop, wanted) if first < c < stop)})
            return [PageRange(low, high, self.page) for low, high in zip(edges, edges[1:])]

        def read(self, partition: PageRange) -> Iterator[tuple]:
            for low in range(partition.low, partition.high, partition.page):
                yield from fetch(low, min(low + partition.page, partition.high))

    class PagedSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return schema

        def reader(self, schema) -> DataSourceReader:
            return PagedReader(self.options)

    return PagedSource
