"""Tables computed from others, of which only the days whose sources changed are computed anew.

A source is a ``PeriodTable``.  A load replaces whole partitions, and every job names its files anew, so a partition's files tell
whether it changed since the view was refreshed; they are listed, not read.  This finds each change, whatever made it: loads,
restored snapshots, emptied days, loads that stopped half-way.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridclear.sources.period_table import PeriodTable, within
from gridclear.sources.small_files import delete, names_in, read_note, write_note

Range = tuple[dt.date, dt.date]
MOST_RANGES = 100  # beyond it the nearest ranges are joined: some unchanged days are computed too
STATE = "source string, first date, last date, files long, mark decimal(38,0)"


@dataclass(frozen=True)
class Source:
    """A table that a view is computed from.

    ``day`` is its column of days; ``first`` and ``last`` are the days of a partition, from its partition columns (``day`` itself by default).
    """

    table: PeriodTable
    day: str
    first: Column | None = None
    last: Column | None = None

    def bounds(self) -> tuple[Column, Column]:
        day = F.col(self.day)
        return (day if self.first is None else self.first).cast("date"), (day if self.last is None else self.last).cast("date")

    def files(self, name: str) -> DataFrame:
        """One row per partition with the number of its files and a sum over their names, sizes and times."""
        spark, folder = self.table.spark, f"{self.table.root}/rows"
        if not any("=" in entry for entry in names_in(spark, folder)):
            return spark.createDataFrame([], STATE)
        found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folder)
        if self.table.partition_by[0] not in found.columns:  # folders without files
            return spark.createDataFrame([], STATE)
        first, last = self.bounds()
        mark = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
        per_partition = found.groupBy(F.lit(name).alias("source"), first.alias("first"), last.alias("last"))
        return per_partition.agg(F.count("*").alias("files"), F.sum(mark).cast("decimal(38,0)").alias("mark"))

    def rows(self, ranges: Iterable[Range]) -> DataFrame:
        """Rows of the ranges; partitions beyond them are pruned."""
        first, last = self.bounds()
        touched = [(first <= F.lit(b)) & (last >= F.lit(a)) for a, b in ranges]
        return self.table.read().filter(reduce(lambda x, y: x | y, touched)).filter(within(F.col(self.day), ranges))


def merged(ranges: Iterable[Range], most: int = MOST_RANGES) -> list[Range]:
    """Ranges without overlap, in order, neighbours joined; at most ``most``, which cover some days in between if need be."""
    joined: list[Range] = []
    for first, last in sorted(ranges):
        if joined and first <= joined[-1][1] + dt.timedelta(days=1):
            joined[-1] = (joined[-1][0], max(joined[-1][1], last))
        else:
            joined.append((first, last))
    gaps = sorted(range(1, len(joined)), key=lambda i: joined[i][0] - joined[i - 1][1], reverse=True)
    starts = [0, *sorted(gaps[: most - 1])] if joined else []
    return [(joined[a][0], joined[b - 1][1]) for a, b in zip(starts, [*starts[1:], len(joined)])]


class StoredView:
    """``table`` holds what ``build`` makes of the sources' rows, by name.

    A row of the result has to depend only on source rows of its own day, which is the table's first partition column.  The states of the sources are taken before
    rows are read, and become the view's when its rows are stored: a refresh that stops is repeated by the next one,
    and a load that comes in between is seen by it.  One process may refresh a view at a time.  Rows that ``build`` gives ``arranged``
    (by day, dealt out and ordered as files shall have them) are stored without another shuffle or sort.
    """

    def __init__(
        self, table: PeriodTable, sources: dict[str, Source], build: Callable[[dict[str, DataFrame]], DataFrame], arranged: bool = False
    ):
        self.table, self.sources, self.build, self.arranged = table, sources, build, arranged
        self.spark, self.root = table.spark, table.root

    def read(self) -> DataFrame:
        return self.table.read()

    def _states(self, name: str | None) -> DataFrame:
        if name is None:
            return self.spark.createDataFrame([], STATE)
        return self.spark.read.schema(STATE).parquet(f"{self.root}/states/{name}")

    def refresh(self) -> list[Range]:
        """Computes the days anew whose sources changed, and returns their ranges; the first one computes all."""
        self.table.recover()
        before, now = read_note(self.spark, f"{self.root}/current_state"), uuid.uuid4().hex
        files = [source.files(name) for name, source in self.sources.items()]
        reduce(DataFrame.unionByName, files).coalesce(1).write.parquet(f"{self.root}/states/{now}")
        ranges = self._changed(before, now)
        if ranges:
            rows = self.build({name: source.rows(ranges) for name, source in self.sources.items()})
            self.table.replace_ranges(rows, ranges, "refresh", self.sources, self.arranged)
        write_note(self.spark, f"{self.root}/current_state", now)
        for name in names_in(self.spark, f"{self.root}/states"):
            if name != now:
                delete(self.spark, f"{self.root}/states/{name}")
        return ranges

    def _changed(self, before: str | None, now: str) -> list[Range]:
        """Ranges of partitions that came, went or have other files; there is a row per partition, so they are as few as days."""
        key = ["source", "first", "last"]
        old = self._states(before).select(*key, F.struct("files", "mark").alias("old"))
        new = self._states(now).select(*key, F.struct("files", "mark").alias("new"))
        differ = old.join(new, key, "full").filter(~F.col("old").eqNullSafe(F.col("new")))
        return merged((r["first"], r["last"]) for r in differ.select("first", "last").distinct().collect())
