"""What a stream's batches did, kept beside the table they load: a batch that is repeated after a failure does nothing twice."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession

from gridclear.sources.bid_import import DEAD_LETTERS
from gridclear.sources.period_table import PeriodTable
from gridclear.sources.small_files import names_in, read_note, write_note


class Ledger:
    """Batches of one stream, told apart by its checkpoint folder.

    A batch's steps are: dead letters, rows, entry, files moved away.  Until its entry is written everything is done again, and each step
    replaces what it wrote before; afterwards only the files are left to be moved.
    """

    def __init__(self, table: PeriodTable, checkpoint: str):
        self.spark, self.root = table.spark, table.root
        self.stream = hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:12]

    def _entry_path(self, batch_id: int) -> str:
        return f"{self.root}/ledger/{self.stream}/{batch_id:012d}.json"

    def entry(self, batch_id: int) -> dict | None:
        text = read_note(self.spark, self._entry_path(batch_id))
        return json.loads(text) if text else None

    def record(self, batch_id: int, entry: dict) -> None:
        write_note(self.spark, self._entry_path(batch_id), json.dumps(entry))

    def entries(self) -> list[dict]:
        names = [n for n in names_in(self.spark, f"{self.root}/ledger/{self.stream}") if n.endswith(".json")]
        return [self.entry(int(n.removesuffix(".json"))) for n in names]

    def write_dead_letters(self, batch_id: int, rows: DataFrame) -> None:
        """Rows of ``DEAD_LETTERS``; those of an earlier attempt at the batch are replaced."""
        rows.write.mode("overwrite").parquet(f"{self.root}/dead_letters/stream={self.stream}/batch={batch_id}")


def dead_letters(spark: SparkSession, table: PeriodTable) -> DataFrame:
    """What streams could not load into the table: (source_file, sheet, reason, raw, stream, batch)."""
    schema = f"{DEAD_LETTERS}, stream string, batch long"
    if not names_in(spark, f"{table.root}/dead_letters"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{table.root}/dead_letters")
