"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridclear.session import scratch_dir

#: Fixed by the contracts of the operators: words are runs of anything but these six characters.
#: ``bytes.split()`` splits at exactly these.
WHITE = " \t\n\r\x0b\x0c"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


ROWS_PER_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` stored in the shared scratch folder and read back: computed once, and safe from lost executors.

    Meanwhile rows go to Python in small batches, so that neither side holds much text at a time.
    """
    spark = df.sparkSession
    path, usual = scratch_dir(spark, label), spark.conf.get(ROWS_PER_BATCH)
    spark.conf.set(ROWS_PER_BATCH, "1000")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(ROWS_PER_BATCH, usual)
    return spark.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null.

    Counts the characters that end a word: no character but white space follows them.
    """
    stripped = F.regexp_replace(F.coalesce(text, F.lit("")), WORD_PATTERN, "x")
    return F.length(F.translate(stripped, WHITE, "")).cast("long")


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch, null as empty."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def small_batches(batches: Iterable[pa.RecordBatch], most_bytes: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Non-empty slices of the batches, of about ``most_bytes`` at most (a larger row is alone), to bound a worker's memory."""
    for batch in batches:
        if batch.num_rows:
            step = max(1, min(batch.num_rows, batch.num_rows * most_bytes // max(batch.nbytes, 1)))
            for start in range(0, batch.num_rows, step):
                yield batch.slice(start, step)


def map_batches(
    df: DataFrame, rows: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str
) -> DataFrame:
    """``rows`` applied to slices of rows inside the tasks, without a shuffle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            yield rows(batch)

    return df.mapInArrow(run, schema)


_model: dict[tuple, object] = {}


def resident(key: tuple, build: Callable[[], object]) -> object:
    """A worker's model by key, with whatever it has learned; only one is kept, so that the next stage finds memory."""
    if key not in _model:
        release()
        _model[key] = build()
        trim()  # what only its construction took
    return _model[key]


def release() -> None:
    """Gives up what a worker has kept for earlier stages."""
    _model.clear()
    trim()


def trim() -> None:
    """Gives memory that is free already back to the system."""
    pa.default_memory_pool().release_unused()
    found = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library only
    if found is not None:
        found(0)


def batch_of(**columns: tuple[list, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(values, kind) for values, kind in columns.values()], names=list(columns)
    )
