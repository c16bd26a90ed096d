"""Spelling variants: words that differ by one letter, found by bit-sliced position indexes.

Two words at edit distance one agree outside a window of a few letters, so words of neighbouring lengths are grouped by what lies
before and after each window.  A group is indexed by bitsets: one per (position, letter), a bit for each of its words.  A word is
looked up in 64 others at once: recurrences over its letters track the set without an error, that with one letter
replaced and, at positions shifted by one, that with one letter more.  Only these sets' last members are pairs; all
words of a group are never paired.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridclear.llm.common import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LENGTH, LEAST_COUNT, DOMINANCE = 7, 2, 10
WINDOW, MOST_WINDOWS = 3, 8  # letters of a window; long words have this many wider ones
GROUP = 4096  # words of a group that are indexed, and looked up, by one task at a time
CHUNK = 1 << 17  # rows, or pairs of a word and an index, that are worked on at once


def corpus_words(docs: DataFrame, damage: int = 31) -> DataFrame:
    """(word, n): the words of ``docs`` (doc_id, text) of at least 7 letters that occur twice or more, and how often.

    Words are runs of Latin letters, A to Z in lower case.  One (document, word) in ``damage`` by the checksum has a letter
    deleted.  A null text has no words, a null id reads as empty.  Counts are summed within tasks first, so no word is hot.
    """
    text = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), UPPER, LOWER)
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(text, F.lit(f"([a-zÀ-ÿ]{{{LEAST_LENGTH},}})"), F.lit(1))).alias("run"),
    )
    length = F.length("run")
    checksum = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (checksum % length).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, length))
    words = runs.select(F.when(checksum % damage == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.filter(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def memberships(words: DataFrame) -> DataFrame:
    """(size, part, key, word, inner, n): each word once for every window of the sizes that it is compared in.

    Words of ``size`` and of one letter more share a group if they agree before and after window ``part``; ``inner`` are the letters
    there.  Whichever letter is replaced or inserted lies in some window.  There are at most 8 windows, so a word takes
    16 times its length at most.
    """
    length = F.length("word")
    sizes = F.filter(F.array(length, length - 1), lambda size: size >= 1)
    sized = words.select("word", "n", F.explode(sizes).alias("size"))
    parts = F.least(F.ceil(F.col("size") / WINDOW), F.lit(MOST_WINDOWS)).cast("int")
    parted = sized.withColumn("parts", parts).select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    edge = lambda k: F.floor(F.col("size") * k / F.col("parts")).cast("int")
    start, after = edge(F.col("part")), F.col("size") - edge(F.col("part") + 1)
    placed = parted.withColumns({"start": start, "after": after, "length": F.length("word")})
    end = F.col("length") - F.col("after")
    return placed.select(
        "size", "part", F.concat(F.substring("word", F.lit(1), F.col("start")), F.substring("word", end + 1, F.col("after"))).alias("key"),
        "word", F.substring("word", F.col("start") + 1, end - F.col("start")).alias("inner"), "n", (F.col("length") > F.col("size")).alias("longer"),
    )


GROUP_KEY = ["size", "part", "key"]


def dealt(rows: DataFrame, group: int) -> DataFrame:
    """``rows`` with (cell, member, query): groups of more than ``group`` words are split into cells.

    With k slices of a group there are k x k cells: a word is indexed in the cells of its slice's column and looked up in those of
    its row.  So a cell holds about ``group`` words on either side, however large the group.
    """
    counts = rows.groupBy(*GROUP_KEY).agg(F.count("*").alias("words")).filter(F.col("words") > group)
    hot = written(counts.select(*(F.col(c).alias(f"hot_{c}") for c in GROUP_KEY), F.ceil(F.col("words") / group).cast("long").alias("slices")), "hot")
    whole = {"cell": F.lit(0).cast("long"), "member": F.lit(True), "query": ~F.col("longer")}
    if hot.isEmpty():
        return rows.withColumns(whole)
    same = [F.col(c) == F.col(f"hot_{c}") for c in GROUP_KEY]
    joined = rows.join(hot, same, "left").drop(*(f"hot_{c}" for c in GROUP_KEY))
    cold = joined.filter("slices IS NULL").drop("slices").withColumns(whole)
    split = joined.filter("slices IS NOT NULL").withColumn("own", F.pmod(F.xxhash64("inner"), F.col("slices")))
    others = F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)
    slices, own = F.col("slices"), F.col("own")
    as_member = F.transform(others, lambda k: F.struct((k * slices + own).alias("cell"), F.lit(True).alias("member"), ((k == own) & ~F.col("longer")).alias("query")))
    as_query = F.transform(
        F.filter(others, lambda k: (k != own) & ~F.col("longer")),
        lambda k: F.struct((own * slices + k).alias("cell"), F.lit(False).alias("member"), F.lit(True).alias("query")),
    )
    spread = split.withColumn("place", F.explode(F.concat(as_member, as_query)))
    return cold.unionByName(spread.select(*rows.columns, "place.cell", "place.member", "place.query"))


def look_up(codes: np.ndarray, group: np.ndarray, longer: np.ndarray, member: np.ndarray, query: np.ndarray, first_part: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, other, inserted): pairs of rows at distance one, ``inserted`` where the other has one letter more.

    ``codes`` (rows, width + 1) are the inner letters as small numbers, filled up with 0; ``group`` rises.  Rows that are
    ``longer`` have width + 1 letters.  A pair that the window before also finds is left out, unless this is the first.
    """
    width = codes.shape[1] - 1
    letters = int(codes.max()) + 1
    members = np.flatnonzero(member)
    in_group = group[members]
    starts = np.flatnonzero(np.r_[True, in_group[1:] != in_group[:-1]]) if len(members) else np.zeros(0, np.int64)
    per_group = np.bincount(group[members], minlength=int(group[-1]) + 1)
    rank = np.arange(len(members)) - np.repeat(starts, per_group[per_group > 0])
    words_of = -(-per_group // 64)  # 64 members to a word of bits
    base = np.cumsum(words_of) - words_of
    slot, bit = base[in_group] + rank // 64, np.uint64(1) << (rank % 64).astype(np.uint64)
    slots = int(words_of.sum())
    row_of = np.zeros(slots * 64, np.int64)
    row_of[slot * 64 + rank % 64] = members

    def bits(at: np.ndarray, chosen: np.ndarray, size: int) -> np.ndarray:
        out = np.zeros(size, np.uint64)
        np.bitwise_or.at(out, at[chosen], bit[chosen])
        return out

    every = np.ones(len(members), bool)
    valid = bits(slot, every, slots)
    long_ones = bits(slot, longer[members], slots)
    asking = np.flatnonzero(query)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    steps = np.cumsum(words_of[group[asking]])
    cuts = np.searchsorted(steps, np.arange(CHUNK, (steps[-1] if len(steps) else 0) + CHUNK, CHUNK), "left")
    for some in np.split(asking, np.unique(cuts[(cuts > 0) & (cuts < len(asking))])):
        counts = words_of[group[some]]
        who = np.repeat(some, counts)
        if not len(who):
            continue
        where = np.repeat(base[group[some]], counts) + np.arange(len(who)) - np.repeat(np.cumsum(counts) - counts, counts)
        exact, replaced = valid[where], np.zeros(len(who), np.uint64)
        shifted, later = exact.copy(), exact.copy()

        def holding(position: int, letter: np.ndarray) -> np.ndarray:
            """Members of each word of bits that have the letter at the position."""
            return sliced[position][where * letters + letter]

        sliced = [bits(slot * letters + codes[members, p], every, slots * letters) for p in range(2)]
        for j in range(width):
            letter = codes[who, j]
            here, following = holding(0, letter), holding(1, letter)
            replaced = (replaced & here) | (exact & ~here)
            exact = exact & here
            shifted = (shifted & following) | exact
            later = later & following
            if j + 1 < width:
                sliced = [sliced[1], bits(slot * letters + codes[members, j + 2], every, slots * letters)]
        inserted = shifted & long_ones[where]
        if not first_part:
            inserted &= ~later
        for hits, more in ((replaced & ~long_ones[where], False), (inserted, True)):
            at = np.flatnonzero(hits)
            while len(at):
                lowest = hits[at] & (~hits[at] + np.uint64(1))
                place = np.bitwise_count(lowest - np.uint64(1)).astype(np.int64)
                found.append((who[at], row_of[where[at] * 64 + place], np.full(len(at), more)))
                hits[at] ^= lowest
                at = at[hits[at] != 0]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    return tuple(np.concatenate(part) for part in zip(*found))


def changed(column: pa.ChunkedArray) -> np.ndarray:
    """Where a column's value differs from the one before."""
    codes = column.combine_chunks().dictionary_encode()
    codes = (codes.chunk(0) if isinstance(codes, pa.ChunkedArray) else codes).indices.to_numpy()
    return np.r_[True, codes[1:] != codes[:-1]]


NEAR = pa.schema([("word", pa.string()), ("n", pa.int64()), ("near", pa.string()), ("near_n", pa.int64())])


def pairs_within(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """(word, n, near, near_n) of whole cells, in both directions; rows are sorted by group and cell."""
    new = np.logical_or.reduce([changed(rows.column(c)) for c in ("size", "part", "key", "cell")])
    kinds = changed(rows.column("size")) | changed(rows.column("part"))
    edges = [*np.flatnonzero(kinds), rows.num_rows]
    for start, end in zip(edges, edges[1:]):
        part = rows.slice(start, end - start)
        inner = part.column("inner").to_pylist()
        width = max(map(len, inner))
        longer = part.column("longer").to_numpy()
        if longer.all():
            continue
        width = width if longer.any() else width + 1
        points = np.array(inner, f"U{width}").view(np.uint32).reshape(len(inner), width)
        letters, codes = np.unique(points, return_inverse=True)
        codes = codes.reshape(points.shape) + (letters[0] != 0)
        group = np.cumsum(new[start:end]) - 1
        flags = (part.column(c).to_numpy() for c in ("member", "query"))
        one, other, inserted = look_up(codes, group, longer, *flags, part.column("part")[0].as_py() == 0)
        columns = [part.column("word").combine_chunks(), part.column("n").combine_chunks()]
        for a, b in ((one, other), (other[inserted], one[inserted])):
            for k in range(0, len(a), CHUNK):
                yield pa.RecordBatch.from_arrays([*(c.take(pa.array(a[k : k + CHUNK])) for c in columns), *(c.take(pa.array(b[k : k + CHUNK])) for c in columns)], schema=NEAR)


def near_pairs(words: DataFrame, group: int = GROUP) -> DataFrame:
    """(word, n, near, near_n): all pairs of ``words`` (word, n) that differ by one letter, each once in both directions."""
    rows = dealt(memberships(words), group)
    order = [*GROUP_KEY, "cell"]
    placed = rows.repartition(*order).sortWithinPartitions(*order)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        held, last = 0, None

        def key(batch: pa.RecordBatch, row: int) -> tuple:
            return tuple(batch.column(c)[row].as_py() for c in order)

        for batch in batches:
            if not batch.num_rows:
                continue
            if held >= CHUNK:  # the rows so far are whole cells up to where this batch leaves the last one
                cut = 0
                while cut < batch.num_rows and key(batch, cut) == last:
                    cut += 1
                waiting.append(batch.slice(0, cut))
                if cut < batch.num_rows:
                    yield from pairs_within(pa.Table.from_batches(waiting))
                    waiting, held = [], 0
                    batch = batch.slice(cut)
            if batch.num_rows:
                waiting.append(batch)
                held += batch.num_rows
                last = key(batch, batch.num_rows - 1)
        if held:
            yield from pairs_within(pa.Table.from_batches(waiting))

    return placed.mapInArrow(run, "word string, n long, near string, near_n long")


def with_roots(formed: DataFrame) -> DataFrame:
    """``formed`` (word, form, ...) with ``root``: the last of the forms that follow from a word, or the word itself.

    A form occurs ten times as often as its word, so counts of 64 bits allow 18 steps: pointers are doubled five times.
    """
    pointers = formed.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(5):
        further = pointers.select(F.col("word").alias("at"), F.col("root").alias("further"))
        pointers = written(
            pointers.join(further, F.col("root") == F.col("at"), "left").select("word", F.coalesce("further", "root").alias("root")), "roots"
        )
    return formed.join(pointers, "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(words: DataFrame, dominance: int = DOMINANCE, group: int = GROUP) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each of ``words`` (word, n; distinct words).

    Two words are near if they differ by exactly one inserted, deleted or replaced letter.  A word's form is its most frequent near
    word (ties: the first by code points) if that occurs at least ``dominance`` times as often.  No words give no rows.
    """
    words = written(words.select("word", F.col("n").cast("long")), "words")
    near = near_pairs(words, group)
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("rarity"), F.col("near"))).alias("best"))
    joined = words.join(best, "word", "left")
    count = -F.col("best.rarity")
    is_form = count >= dominance * F.col("n")
    formed = joined.select(
        "word", F.when(is_form, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, count).alias("form_n"),
    )
    return with_roots(written(formed, "forms")).select("word", "form", "root", "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """``variants`` of the words of ``docs`` (doc_id, text), whatever else it has; repeated rows count as often, an empty table gives no rows."""
    return variants(corpus_words(docs))
