"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash of the last eight bytes decides where a chunk ends: at block size 2^k where its k lowest bits are all ones,
so the boundaries of a block size are among those of the one below.  Each chunk gives two characters of a
signature.  A fingerprint has the signatures at three successive block sizes, the first being the smallest with no more than
64 chunks; two fingerprints are compared by the edit distance of their signatures at block sizes that both have.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 8
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
MIN_BITS = 2  # the smallest block size is 4 bytes
MAX_CHUNKS = 64
LEVELS = 3
LARGEST = (1 << 63) - 1  # null ids sort below all others
SLICE = 1 << 20  # bytes hashed at a time
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"  # that of base64
SYMBOLS = [a + b for a in ALPHABET for b in ALPHABET]


def boundaries(data: bytes, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Chunk ends at block size 2^bits, and the rolling hash at each."""
    mask = np.uint64((1 << bits) - 1)
    ends, hashes = [], []
    for start in range(0, len(data) - WINDOW + 1, SLICE):
        n = min(SLICE, len(data) - WINDOW + 1 - start)
        windows = np.ndarray((n,), "<u8", buffer=data, offset=start, strides=(1,))
        rolled = windows * MULTIPLIER
        rolled >>= np.uint64(32)
        at = np.flatnonzero((rolled & mask) == mask)
        ends.append(at + (start + WINDOW))
        hashes.append(rolled[at])
    if not ends:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(ends), np.concatenate(hashes)


def signature(data: bytes, ends: np.ndarray) -> str:
    view, start, out = memoryview(data), 0, []
    for end in [*ends.tolist(), len(data)]:
        if end > start:
            out.append(SYMBOLS[xxhash.xxh3_64_intdigest(view[start:end]) & 4095])
        start = end
    return "".join(out)


def fingerprint(text: str) -> str:
    """``bits:signature:signature:signature``; equal texts have equal fingerprints, the empty text has an empty one."""
    data = text.encode()
    if not data:
        return ""
    # Start where about four times too many chunks are expected, and go down if chance made them few.
    bits = max(MIN_BITS, (len(data) // (4 * MAX_CHUNKS)).bit_length())
    while True:
        ends, hashes = boundaries(data, bits)
        if len(ends) >= MAX_CHUNKS or bits == MIN_BITS:
            break
        bits -= 1
    while len(ends) >= MAX_CHUNKS:
        bits += 1
        ends, hashes = coarser(ends, hashes, bits)
    parts = [str(bits)]
    for level in range(LEVELS):
        if level:
            ends, hashes = coarser(ends, hashes, bits + level)
        parts.append(signature(data, ends))
    return ":".join(parts)


def coarser(ends: np.ndarray, hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << bits) - 1)
    keep = (hashes & mask) == mask
    return ends[keep], hashes[keep]


def common_length(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, one machine word of bits per element of ``a``."""
    places: dict[str, int] = {}
    for i, symbol in enumerate(a):
        places[symbol] = places.get(symbol, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for symbol in b:
        match = places.get(symbol)
        if match is not None:
            met = row & match
            row = ((row + met) | (row - met)) & full
    return len(a) - row.bit_count()


def likeness(one: str, other: str) -> float:
    """1 for equal fingerprints, else 1 - (insertions and deletions) / (both lengths), the best of the shared block sizes.

    Fingerprints without a shared block size, or of which one is empty, have likeness 0.
    """
    if one == other:
        return 1.0
    if not one or not other:
        return 0.0
    levels = []
    for print_ in (one, other):
        bits, *signatures = print_.split(":")
        levels.append({int(bits) + k: s for k, s in enumerate(signatures)})
    best = 0.0
    for bits in levels[0].keys() & levels[1].keys():
        a, b = ([s[i : i + 2] for i in range(0, len(s), 2)] for s in (levels[0][bits], levels[1][bits]))
        best = max(best, 2 * common_length(a, b) / (len(a) + len(b)))
    return best


def edited(text: str, following: str) -> str:
    """``text`` whose last half is replaced by as many first characters of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


# ---------------------------------------------------------------------------------------------------------------------


def bucket_bounds(docs: DataFrame, buckets: int) -> np.ndarray:
    """Keys that split the descending order into about equal buckets, from a mergeable quantile sketch."""
    at = [i / buckets for i in range(1, buckets)]
    found = docs.agg(F.percentile_approx("key", at, 100_000)).head()[0] if at else []
    return -np.array(sorted(set(found or []), reverse=True), np.int64)


def with_next(docs: DataFrame, buckets: int) -> DataFrame:
    """(bucket, main, doc_id, text): rows dealt into buckets of descending keys, each followed by a copy of the first row after it.

    Copies (``main`` false) are one row per bucket, or as many as share the first key.
    """
    bounds = bucket_bounds(docs, buckets)

    @F.pandas_udf("long")
    def bucket(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, -key.to_numpy(), side="left"))

    dealt = docs.withColumn("bucket", bucket("key"))
    firsts = dict(dealt.groupBy("bucket").agg(F.max("key")).collect())  # a row per bucket
    used = sorted(firsts)
    # The key of each bucket's first row, and the bucket before it; the first bucket follows the last one.
    first_keys = np.array([-firsts[b] for b in used], np.int64)
    before = np.array([used[i - 1] for i in range(len(used))], np.int64)

    @F.pandas_udf("long")
    def copy_to(key: pd.Series) -> pd.Series:
        wanted = -key.to_numpy()
        at = np.minimum(np.searchsorted(first_keys, wanted), len(first_keys) - 1)
        return pd.Series(np.where(first_keys[at] == wanted, before[at], -1))

    targets = F.filter(
        F.array(
            F.struct("bucket", F.lit(True).alias("main")), F.struct(F.col("copy").alias("bucket"), F.lit(False).alias("main"))
        ),
        lambda t: t["bucket"] >= 0,
    )
    copied = dealt.withColumn("copy", copy_to("key")) if used else dealt.withColumn("copy", F.lit(-1).cast("long"))
    return copied.select(F.explode(targets).alias("t"), "key", "doc_id", "text").select("t.bucket", "t.main", "key", "doc_id", "text")


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def fingerprint_neighbours(docs: DataFrame, rows_per_bucket: int = 4096) -> DataFrame:
    """Fingerprints of each row of ``docs`` (doc_id, text) and of its text edited by the next document's, and their likeness.

    Documents follow each other by descending id, rows with equal ids by text, null ids last, and the last is followed by the
    first; a document alone follows itself.  A null text is empty, its fingerprint too: it equals other
    empty ones and is unlike all others.  An empty table gives no rows.  Buckets of neighbouring ids are sorted in the tasks; a copy
    of the first row of each bucket goes to the one before, so no task sees more than its own buckets.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    docs = docs.withColumn("key", F.coalesce("doc_id", F.lit(-LARGEST)))
    # A task reads its buckets as a stream, so a few per task are enough whatever the size of the table.
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(1, min(docs.count() // rows_per_bucket, 4 * tasks))
    ordered = (
        with_next(docs, buckets)
        .repartition(min(buckets, tasks), "bucket")
        .sortWithinPartitions("bucket", F.desc("main"), F.desc("key"), "text")
    )
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # (bucket, doc_id, text, fingerprint) still without its next document
        for batch in batches:
            out = []
            columns = (batch.column(c) for c in ("bucket", "main", "doc_id", "text"))
            for bucket, main, doc_id, text in zip(*columns):
                bucket, main, text = bucket.as_py(), main.as_py(), text.as_py()
                if not main and held is None:
                    continue  # a further copy of the same first row
                print_ = fingerprint(text)
                if held is not None:
                    changed = edited(held[2], text)
                    its = fingerprint(changed)
                    out.append(
                        (held[1], len(held[2]), hashlib.sha256(changed.encode()).hexdigest(), held[3], its, likeness(held[3], its), likeness(held[3], print_))
                    )
                held = (bucket, doc_id.as_py(), text, print_) if main else None
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out], schema=OUT)

    return ordered.mapInArrow(run, SCHEMA)


OUT = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
     ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
)
