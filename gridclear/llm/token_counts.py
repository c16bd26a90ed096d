"""Token counts of whole texts, from pieces counted once per distinct pre-token.

1. Distinct pre-tokens of all texts with their frequencies (summed in the tasks, then by key).
2. Pieces of each distinct pre-token, by the library.
3. Per-document pre-token frequencies joined to the pieces, and the sum; ids are never kept.

A few pre-tokens make up most of any text.  The ``head`` most frequent ones, a fixed number, are broadcast, so step 3
joins them where the text is read; all others go through a shuffled join.  No key of that join can be hot, as
the hot ones are in the head.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridclear.llm.common import batch_of, written
from gridclear.llm.tokenizer_files import pretokens_of

HEAD = 1 << 18  # pre-tokens in the broadcast table: about 10 MB
FLUSH = 1 << 17  # distinct pre-tokens a task holds before it hands them on


def distinct_pretokens(docs: DataFrame, file: str) -> DataFrame:
    """(pretoken, n): every distinct pre-token of all texts and how often it occurs."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rule = pretokens_of(file)
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            done = batch_of(pretoken=(list(held), pa.string()), n=(list(held.values()), pa.int64()))
            held.clear()
            return done

        for batch in batches:
            for text in batch.column(0):
                for segment in rule.parts(text.as_py() or "")[::2]:
                    held.update(rule.split(segment))
                if len(held) > FLUSH:
                    yield out()
        yield out()

    counted = docs.select("text").mapInArrow(count, "pretoken string, n long")
    return counted.groupBy("pretoken").agg(F.sum("n").alias("n"))


def with_pieces(pretokens: DataFrame, file: str) -> DataFrame:
    """(pretoken, n, pieces): the number of pieces of each distinct pre-token."""

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rule = pretokens_of(file)
        for batch in batches:
            pieces = [len(ids) for ids in rule.encode(batch.column("pretoken").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("pretoken"), batch.column("n"), pa.array(pieces, pa.int32())], names=["pretoken", "n", "pieces"]
            )

    return pretokens.mapInArrow(encode, "pretoken string, n long, pieces int")


def document_frequencies(docs: DataFrame, file: str, head: dict[str, int]) -> DataFrame:
    """One row per document: its tokens from the head table and the frequencies of its other pre-tokens.

    ``row`` tells rows apart, also those with equal ids.
    """
    known = docs.sparkSession.sparkContext.broadcast(head)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rule, pieces = pretokens_of(file), known.value
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            rows, sizes, sums, tails = [], [], [], []
            for text in batch.column("text"):
                text = text.as_py() or ""
                parts = rule.parts(text)
                frequencies: Counter[str] = Counter()
                for segment in parts[::2]:
                    frequencies.update(rule.split(segment))
                total, tail = len(parts) // 2, []
                for pretoken, n in frequencies.items():
                    count_ = pieces.get(pretoken)
                    if count_ is None:
                        tail.append((pretoken, n))
                    else:
                        total += count_ * n
                rows.append(row)
                sizes.append(len(text.encode()))
                sums.append(total)
                tails.append(tail)
                row += 1
            kind = pa.list_(pa.struct([("pretoken", pa.string()), ("n", pa.int64())]))
            tails = [[{"pretoken": p, "n": n} for p, n in tail] for tail in tails]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(sums, pa.int64()), pa.array(tails, kind)],
                names=["row", "doc_id", "n_bytes", "n_head", "tail"],
            )

    return docs.mapInArrow(
        count, "row long, doc_id long, n_bytes long, n_head long, tail array<struct<pretoken: string, n: long>>"
    )


def count_tokens(docs: DataFrame, file: str, limit: int = 1024, head: int = HEAD) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for each row of ``docs`` (doc_id, text), whatever else it has.

    Counts are those of the library for the whole text: no begin or end tokens, special strings inside texts as
    one token each.  A null or empty text has 0 bytes and 0 tokens; rows with equal ids each get their own count; a
    null id stays null; an empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    pieces = written(with_pieces(distinct_pretokens(docs, file), file), "pieces")
    top = pieces.orderBy(F.desc("n"), "pretoken").limit(head).select("pretoken", "pieces").toArrow()
    common = dict(zip(top.column(0).to_pylist(), top.column(1).to_pylist()))
    counted = written(document_frequencies(docs, file, common), "frequencies")
    rest = (
        counted.select("row", F.explode("tail").alias("t"))
        .select("row", "t.pretoken", "t.n")
        .join(pieces.select("pretoken", "pieces"), "pretoken")
        .select("row", F.lit(None).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("n_bytes"), (F.col("n") * F.col("pieces")).alias("n"))
    )
    return (
        counted.select("row", "doc_id", "n_bytes", F.col("n_head").alias("n"))
        .unionAll(rest)
        .groupBy("row")
        .agg(F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), F.sum("n").alias("n_tokens"))
        .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
    )
