"""Tables that keep every value a key ever had, with the time from which and until which it held.

A row has ``ingested_at``, ``effective_from`` and ``effective_to``, NULL in the open row that a key has at most one of.  Times are UTC without a zone.  A load
closes the open rows whose values it replaces and adds the new ones in one partition overwrite, so readers see all of it or nothing;
rows that it finds unchanged stay open, and a load that is repeated changes nothing.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridclear.operators.reconcile import latest_per_interval
from gridclear.schema import conform_to_schema, quoted
from gridclear.sources.period_table import PeriodTable
from gridclear.sources.small_files import delete

VALIDITY = ["ingested_at", "effective_from", "effective_to"]


def moment(at: dt.datetime | str) -> Column:
    """A time as literal; one with a zone is brought to UTC."""
    if isinstance(at, dt.datetime) and at.tzinfo is not None:
        at = at.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return F.lit(str(at)).cast("timestamp_ntz")


class HistoryTable:
    """``keys`` tell rows apart, NULLs like any other value, and determine the partition columns; all other columns are values."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, partition_by: list[str], keys: list[str]):
        self.spark, self.row_schema, self.keys = spark, schema, list(keys)
        self.values = [f.name for f in schema.fields if f.name not in keys and f.name not in partition_by]
        validity = [T.StructField(name, T.TimestampNTZType()) for name in VALIDITY]
        self.table = PeriodTable(spark, root, T.StructType([*schema.fields, *validity]), partition_by, [k for k in keys if k not in partition_by])

    def read(self) -> DataFrame:
        """Every row that ever held."""
        return self.table.read()

    def current(self) -> DataFrame:
        return self.read().filter("effective_to IS NULL").drop(*VALIDITY)

    def as_of(self, at: dt.datetime | str) -> DataFrame:
        """The table as it was at a time; a row holds from ``effective_from`` until just before ``effective_to``."""
        until = F.col("effective_to")
        return self.read().filter((F.col("effective_from") <= moment(at)) & (until.isNull() | (until > moment(at)))).drop(*VALIDITY)

    def load(
        self, rows: DataFrame, at: dt.datetime | str, complete: bool = False, operation: str = "load_history", source_files: Iterable[str] = ()
    ) -> str:
        """Takes in rows that hold from ``at``; with ``complete`` they are all that the partitions they fall in have, and open rows of other keys there are closed.

        Of several rows with one key the last in the order of their values is taken.  Only touched partitions are read and
        written.  A load before the time of a row that it would close fails and changes nothing; one at the same time leaves that row
        with no time at which it held.
        """
        staged = f"{self.table.root}/staged/{uuid.uuid4().hex}"
        # Stored, so that the rows to be merged are those whose partitions were found.
        latest_per_interval(conform_to_schema(rows, self.row_schema), self.keys, self.values[:1]).write.parquet(staged)
        new = self.spark.read.schema(self.row_schema).parquet(staged)
        parts = new.select(*[quoted(c) for c in self.table.partition_by]).distinct()
        touched = self.table.read().join(parts, self.table.partition_by, "left_semi")
        closed = touched.filter("effective_to IS NOT NULL")
        merged = self._merged(touched.filter("effective_to IS NULL"), new, moment(at), complete)
        run_id = self.table.replace_partitions(closed.unionByName(merged), operation, source_files)
        delete(self.spark, staged)
        return run_id

    def _merged(self, open_rows: DataFrame, new: DataFrame, at: Column, complete: bool) -> DataFrame:
        """Open rows as they are, closed or followed by new ones."""
        names = [f.name for f in self.row_schema.fields]
        old, brought = open_rows.withColumn("here", F.lit(True)).alias("old"), new.withColumn("here", F.lit(True)).alias("new")

        def side(which: str, name: str) -> Column:
            return F.col(f"{which}.`{name}`")

        same_key = [side("old", k).eqNullSafe(side("new", k)) for k in self.keys]
        was, comes = side("old", "here").isNotNull(), side("new", "here").isNotNull()
        differs = F.lit(False)
        for name in self.values:
            differs = differs | ~side("old", name).eqNullSafe(side("new", name))
        closes = was & F.when(comes, differs).otherwise(F.lit(complete))
        late = F.raise_error(F.lit("the load lies before the time of a row that it replaces")).cast("timestamp_ntz")
        until = F.when(closes, F.when(side("old", "effective_from") > at, late).otherwise(at))
        kept = [*[side("old", n).alias(n) for n in names], side("old", "ingested_at").alias("ingested_at"),
                side("old", "effective_from").alias("effective_from"), until.alias("effective_to")]
        added = [*[side("new", n).alias(n) for n in names], at.alias("ingested_at"), at.alias("effective_from"),
                 F.lit(None).cast("timestamp_ntz").alias("effective_to")]
        result = F.array_compact(F.array(F.when(was, F.struct(*kept)), F.when(comes & (~was | differs), F.struct(*added))))
        return old.join(brought, same_key, "full").select(F.inline(result))
