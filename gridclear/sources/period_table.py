"""Partitioned Parquet tables of Spark's catalog, whose periods are replaced as a whole.

A ``PeriodTable`` is an external table at ``<root>/rows``, partitioned by days, months or four-hour blocks.  Loads are
Spark's own dynamic partition overwrites: the partitions that an import has rows for are swapped when its job commits, all others stay,
and a failed job changes nothing.  Next to it lie ``<root>/lineage``, a plain appended table with a row per load, and
``<root>/snapshots``, copies taken on demand.  The catalog prunes partitions before any file is listed.
"""

from __future__ import annotations

import datetime as dt
import getpass
import hashlib
import json
import uuid
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridclear.operators.reconcile import numbered
from gridclear.schema import conform_to_schema, quoted
from gridclear.sources.small_files import delete, names_in, read_note, write_note

LINEAGE_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("operation_type", T.StringType()),
        T.StructField("source_files", T.StringType()),
        T.StructField("username", T.StringType()),
    ]
)


def within(day: Column, ranges: Iterable[tuple[dt.date, dt.date]]) -> Column:
    """Whether a day lies in one of the ranges (first, last)."""
    return reduce(lambda a, b: a | b, [day.between(F.lit(a), F.lit(b)) for a, b in ranges], F.lit(False))


class PeriodTable:
    """``sort_by`` orders the rows inside each file, so that scans can skip parts of files by their statistics."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: T.StructType,
        partition_by: list[str],
        sort_by: Iterable[str] = (),
    ):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.partition_by, self.sort_by = list(partition_by), list(sort_by)
        self.name = f"period_{hashlib.md5(self.root.encode()).hexdigest()[:20]}"
        data = [f for f in schema.fields if f.name not in self.partition_by]
        self.columns = [f.name for f in data] + self.partition_by
        self.create_if_absent()

    def create_if_absent(self) -> None:
        """The table in the catalog, empty at first; partitions that lie in its folder already are found."""
        if self.spark.catalog.tableExists(self.name):
            return
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        parts = ", ".join(f"`{c}`" for c in self.partition_by)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}) USING parquet OPTIONS ('partitionOverwriteMode' = 'dynamic') "
            f"PARTITIONED BY ({parts}) LOCATION '{self.root}/rows'"
        )
        if self._folder("rows"):
            self.spark.sql(f"MSCK REPAIR TABLE {self.name}")

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _folder(self, name: str) -> list[str]:
        """Names in one of the table's folders, none if it is absent."""
        path, system = self._path(name)
        return [f.getPath().getName() for f in system.listStatus(path)] if system.exists(path) else []

    def read(self) -> DataFrame:
        return self.spark.table(self.name).select(*[quoted(f.name) for f in self.schema.fields])

    # --- loads ---

    def _gathered(self, df: DataFrame, arranged: bool = False) -> DataFrame:
        """Rows in the table's columns, few files per partition; one without its period fails the job before it commits.

        Rows that are ``arranged`` are dealt out and ordered as files shall have them, partition columns first, and stay so.
        """
        rows = conform_to_schema(df, self.schema)
        for c in self.partition_by:
            refused = F.raise_error(F.lit(f"rows without {c} cannot be loaded; quarantine them first"))
            if arranged:  # a changed column would have no order, and the writer would sort all rows
                rows = rows.filter(F.when(quoted(c).isNull(), refused.cast("boolean")).otherwise(True))
                continue
            rows = rows.withColumn(c, F.when(quoted(c).isNull(), refused.cast(self.schema[c].dataType)).otherwise(quoted(c)))
        if arranged:
            return rows.select(*[quoted(c) for c in self.columns])
        # A rebalance splits a partition that is too large for a task.
        gathered = rows.hint("rebalance", *self.partition_by)
        if self.sort_by:
            gathered = gathered.sortWithinPartitions(*[quoted(c) for c in (*self.partition_by, *self.sort_by)])
        return gathered.select(*[quoted(c) for c in self.columns])

    def replace_partitions(self, df: DataFrame, operation: str = "replace_partitions", source_files: Iterable[str] = ()) -> str:
        """Replaces every partition that the import has rows for (a month, a day or a four-hour block)."""
        self._gathered(df).write.mode("overwrite").insertInto(self.name)
        return self.append_lineage(operation, source_files)

    def replace_range(
        self, df: DataFrame, operation: str = "replace_range", source_files: Iterable[str] = (), spare: Iterable[dt.date] = ()
    ) -> str:
        """Replaces everything between the first and the last date of the import; days that it lacks are emptied but for those to ``spare``.

        The first partition column is the date.
        """
        day, kept = F.col(self.partition_by[0]), list(spare)

        def lost(days: list[dt.date]) -> Column:
            return day.between(F.lit(min(days)), F.lit(max(days))) & ~day.isin([*days, *kept]) if days else F.lit(False)

        return self._replace(df, lost, operation, source_files)

    def replace_ranges(
        self,
        df: DataFrame,
        ranges: Iterable[tuple[dt.date, dt.date]],
        operation: str = "replace_ranges",
        source_files: Iterable[str] = (),
        arranged: bool = False,
    ) -> str:
        """Replaces the days of ``ranges`` (first, last), whether the rows, which all lie within them, have those days or not.

        Rows that are ``arranged`` are written as they come, without a shuffle or a sort.
        """
        day = self.partition_by[0]
        inside = within(F.col(day), ranges)
        return self._replace(df, lambda days: inside & ~F.col(day).isin(days), operation, source_files, arranged)

    def _replace(
        self, df: DataFrame, lost: Callable[[list[dt.date]], Column], operation: str, source_files: Iterable[str], arranged: bool = False
    ) -> str:
        """Replaces the days that ``df`` has rows for and empties those that ``lost`` names, given the former.

        One job commits the rows, and observes their days.  Partitions to be emptied are then noted in ``pending`` and leave the catalog by
        one statement; if anything stops in between, ``recover`` carries the note out.  It runs before the next such load, and can
        be called at any time.
        """
        self.recover()
        day, seen = self.partition_by[0], Observation()
        note = {"operation": operation, "source_files": list(source_files), "gone": None}
        path = self._pending(uuid.uuid4().hex)
        write_note(self.spark, path, json.dumps(note))
        observed = self._gathered(df, arranged).observe(seen, F.collect_set(quoted(day)).alias("days"))
        observed.write.mode("overwrite").insertInto(self.name)
        gone = self.spark.table(self.name).filter(lost(seen.get["days"] or []))
        gone = gone.select(*[quoted(c) for c in self.partition_by]).distinct().collect()  # calendar days
        write_note(self.spark, path, json.dumps({**note, "gone": [[str(v) for v in row] for row in gone]}))
        return self._complete(path)

    def _pending(self, name: str) -> str:
        return f"{self.root}/pending/{name}"

    def recover(self) -> list[str]:
        """Completes loads that stopped after their rows were committed; returns the operations of those that stopped before and must be repeated.

        A load that stopped earlier has either changed nothing or committed its rows; its days were not emptied.  Only one process
        may load a table at a time.
        """
        repeat = []
        for name in sorted({n.removesuffix(".part") for n in names_in(self.spark, f"{self.root}/pending")}):
            path = self._pending(name)
            note = json.loads(read_note(self.spark, path) or "{}")
            if note.get("gone") is None:
                repeat.append(note.get("operation", "unknown"))
                delete(self.spark, path)
                delete(self.spark, f"{path}.part")
            else:
                self._complete(path)
        return repeat

    def _complete(self, path: str) -> str:
        """Empties the partitions of a note, all by one statement, and takes the note away; each step may be repeated."""
        note = json.loads(read_note(self.spark, path))
        if note["gone"]:
            self._drop_partitions(note["gone"])
        run_id = self.append_lineage(note["operation"], note["source_files"])
        delete(self.spark, path)
        delete(self.spark, f"{path}.part")
        return run_id

    def _drop_partitions(self, gone: list[list[str]]) -> None:
        specs = ", ".join("PARTITION (" + ", ".join(f"`{c}` = '{v}'" for c, v in zip(self.partition_by, values)) + ")" for values in gone)
        self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS {specs}")
        for values in gone:  # the table is external: files stay until they are deleted, but no reader finds them
            delete(self.spark, f"{self.root}/rows/" + "/".join(f"{c}={v}" for c, v in zip(self.partition_by, values)))

    def overwrite(self, df: DataFrame, operation: str = "create_or_replace", source_files: Iterable[str] = ()) -> str:
        """Replaces the whole table, which the rows must not come from."""
        writer = self._gathered(df).write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer.partitionBy(*self.partition_by).parquet(f"{self.root}/rows")
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")  # external: the rows stay
        self.create_if_absent()
        return self.append_lineage(operation, source_files)

    # --- lineage ---

    def append_lineage(self, operation: str, source_files: Iterable[str]) -> str:
        run_id = uuid.uuid4().hex
        row = (run_id, dt.datetime.now(dt.timezone.utc), operation, ",".join(source_files), getpass.getuser())
        self.spark.createDataFrame([row], LINEAGE_SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.root}/lineage")
        return run_id

    def history(self) -> DataFrame:
        """One row per load, numbered in order."""
        empty = self.spark.createDataFrame([], LINEAGE_SCHEMA)
        if not self._folder("lineage"):
            return empty.select(F.lit(0).cast("long").alias("version_id"), "*")
        rows = self.spark.read.schema(LINEAGE_SCHEMA).parquet(f"{self.root}/lineage")
        return numbered(rows, F.to_date("timestamp"), ["timestamp", "run_id"], "version_id")

    # --- snapshots ---

    def snapshot(self) -> str:
        """Copies the current rows; returns the name to restore them by."""
        name = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
        self.read().write.partitionBy(*self.partition_by).parquet(f"{self.root}/snapshots/taken={name}")
        return name

    def restore(self, snapshot: str) -> str:
        rows = self.spark.read.schema(self.schema).parquet(f"{self.root}/snapshots/taken={snapshot}")
        return self.overwrite(rows, f"restore {snapshot}")

    def snapshots(self) -> list[str]:
        """Names of all snapshots, newest first."""
        return sorted((name.removeprefix("taken=") for name in self._folder("snapshots")), reverse=True)

    def drop_old_snapshots(self, keep: int = 3) -> list[str]:
        """Deletes all but the newest ``keep`` snapshots; returns those deleted."""
        old = self.snapshots()[keep:]
        for name in old:
            path, system = self._path(f"snapshots/taken={name}")
            system.delete(path, True)
        return old
