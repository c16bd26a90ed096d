"""Near-duplicate groups by an n-gram Jaccard join over a token-group matrix.

Every document is the set of its distinct word shingles; two link when the sets are alike enough.  The join loses no link:

1. Order and prefix.  Shingles have one order for all documents: by hash, but frequent ones last.  Two sets that link share a
   shingle among the first ``n - needed(n) + 1`` of each, so only these are looked up.
2. Groups.  Similar documents are brought together first: each is compared with the document it shares most of its prefix
   with.  Those that may be alike enough form a group; links found join documents of a group.
3. Token-group matrix.  A row per prefix shingle and group that has it.  A document and a group are a candidate if the group has
   a document there to which the first is not joined.  The token unions of the group's parts, as rows of bits, bound
   the overlap with their members; only parts that reach the needed overlap are opened.
4. Opened parts.  Members of fitting size are bounded by their own bits, then compared exactly.  The links join documents.

Sets travel only in steps 2 and 4, for documents whose bounds allow a link.  Copies of a set are compared once.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridclear.llm import shingles as sh
from gridclear.llm.common import release, small_batches, texts, written
from gridclear.llm.components import connected_components

BLOCK = 1 << 21  # shingles whose repetitions a task counts together
FREQUENT = 4  # a shingle repeated this often within blocks comes last in the order
MAX_FREQUENT = 1 << 17  # of these, the most frequent are told to all tasks: 1 MB
CLOSE = 50  # percent of likeness at which documents are put in a group
ROUNDS = 1  # of comparisons before the matrix is made
FILTER_BITS = 22  # size of the filter that spares most texts a second shingling: half a MB

PART = 32  # members of a group that share a token union

LONGS = pa.list_(pa.int64())
PARTS = pa.schema(
    [(c, pa.int64()) for c in ("group", "low", "high")] + [(c, LONGS) for c in ("rows", "sizes", "others", "components")] + [("bits", pa.binary())]
)


def frequent_shingles(docs: DataFrame, size: int) -> np.ndarray:
    """Shingles that many documents have, sorted.

    Each task counts, in blocks of distinct sets, and passes on what occurs twice in a block, which is little.  The order
    of shingles only steers the work: the result is the same for any list.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        held: list[np.ndarray] = []
        seen: set[tuple[int, int]] = set()
        total = 0

        def counted() -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64),) * 2
            often = counts > 1
            return pa.RecordBatch.from_arrays(
                [pa.array(values[often].astype(np.int64)), pa.array(counts[often].astype(np.int64))], names=["token", "n"]
            )

        for batch in small_batches(batches):
            for found in sh.shingle_sets(texts(batch), size):
                key = sh.digest(found)
                if key not in seen:
                    seen.add(key)
                    held.append(found)
                    total += len(found)
                if total >= BLOCK:
                    yield counted()
                    held, seen, total = [], set(), 0
        yield counted()

    counts = docs.select("text").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    top = counts.filter(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "token").limit(MAX_FREQUENT).select("token").toArrow()
    return np.sort(top.column(0).to_numpy().astype(np.uint64))


DOCUMENT = "row long, doc_id long, text_key long, n long, high long, low long, rare array<long>, frequent array<long>, bits binary"


def described(docs: DataFrame, size: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """A row per document: the size and digest of its set, and, for the first document of a task with that set, prefix and bits."""
    known = docs.sparkSession.sparkContext.broadcast(frequent)
    names = [c.split()[0] for c in DOCUMENT.replace("array<long>", "array").split(", ")]
    kinds = [pa.int64()] * 6 + [LONGS, LONGS, pa.binary()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        row = TaskContext.get().partitionId() << 40
        seen: set[tuple[int, int]] = set()
        filter_ = np.zeros(1 << 20, bool)
        filter_[(known.value & np.uint64((1 << 20) - 1)).astype(np.intp)] = True

        def ordered(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            length = len(found) - sh.needed(len(found), percent) + 1
            maybe = np.flatnonzero(filter_[(found & np.uint64((1 << 20) - 1)).astype(np.intp)])
            if len(known.value) and len(maybe):
                at = np.minimum(np.searchsorted(known.value, found[maybe]), len(known.value) - 1)
                often = np.zeros(len(found), bool)
                often[maybe] = known.value[at] == found[maybe]
                rare = found[~often][:length]
                return rare, found[often][: length - len(rare)]
            return found[:length], found[:0]

        for batch in small_batches(batches):
            columns: list[list] = [[] for _ in range(7)]
            for found in sh.shingle_sets(texts(batch), size):
                key = sh.digest(found)
                prefix: tuple = (None, None, None)
                if len(found) and key not in seen:
                    seen.add(key)
                    prefix = (*(p.astype(np.int64) for p in ordered(found)), sh.bit_row(found))
                for column, value in zip(columns, (row, len(found), *key, *prefix)):
                    column.append(value)
                row += 1
            rows, n, high, low, rare, often, bits = columns
            arrays = [rows, batch.column("doc_id"), batch.column("text_key"), n, high, low, rare, often, bits]
            yield pa.RecordBatch.from_arrays([a if isinstance(a, pa.Array) else pa.array(a, k) for a, k in zip(arrays, kinds)], names=names)

    return docs.mapInArrow(run, DOCUMENT)


def meetings(described: DataFrame) -> DataFrame:
    """(token, row): prefix shingles that several rows have.

    Frequent shingles are few and known: they are counted in the tasks first and the result is broadcast (at most
    ``MAX_FREQUENT`` rows), so a hot shingle moves no rows.  All others are dealt out once by shingle: a row has a shingle once, so
    its least and greatest row tell whether several have it, from the rows that are looked up then.
    """
    rare = described.select("row", F.explode("rare").alias("token")).repartition("token")
    several = rare.groupBy("token").agg(F.min("row").alias("x"), F.max("row").alias("y")).filter("x <> y").select("token")
    often = described.select("row", F.explode("frequent").alias("token"))
    often_several = often.groupBy("token").agg(F.count("*").alias("rows")).filter("rows > 1").select("token")
    return rare.join(several.hint("shuffle_hash"), "token").unionAll(often.join(F.broadcast(often_several), "token")).select("token", "row")


def allowed(n_a: int, bits_a: np.ndarray, n_b: np.ndarray, bits_b: np.ndarray, percent: int) -> np.ndarray:
    """Which of the sets b, given by sizes and rows of bits, may link with the set a."""
    not_in_b, not_in_a = sh.missing_bits(bits_a, bits_b)
    shared = np.minimum(n_a - not_in_b, n_b - not_in_a)
    return 100 * shared >= percent * (n_a + n_b - shared)


def bound_by_bits(pairs: DataFrame, least: int, percent: int) -> DataFrame:
    """``pairs`` (a, n_a, bits_a, b, n_b, bits_b) whose rows of bits allow a likeness of ``least``, as (a, b, may_link): may_link tells
    whether they allow one of ``percent``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            near, may_link = [], []
            for n_a, bits_a, n_b, bits_b in zip(*(batch.column(c).to_pylist() for c in ("n_a", "bits_a", "n_b", "bits_b"))):
                sets = n_a, np.frombuffer(bits_a, np.uint8), np.array([n_b]), np.frombuffer(bits_b, np.uint8)[None]
                near.append(bool(allowed(*sets, least)[0]))
                may_link.append(near[-1] and bool(allowed(*sets, percent)[0]))
            out = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(may_link, pa.bool_())], names=["a", "b", "may_link"])
            yield out.filter(pa.array(near, pa.bool_()))

    return pairs.select("a", "b", "n_a", "bits_a", "n_b", "bits_b").mapInArrow(run, "a long, b long, may_link boolean")


def opened(queries: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that bits allow, from ``queries``: a document (a, n_a, bits_a, joined, component) and a part of a group.

    The part's token union comes first; only if it has enough of the document's shingles are its members looked at.  Of two
    documents the one joined to fewer others is the query.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("a", "n_a", "bits_a", "joined", "component", "rows", "sizes", "others", "components", "bits")
        for batch in small_batches(batches):
            left, right = [], []
            for a, n_a, bits_a, joined, component, rows, sizes, others, components, bits in zip(*(batch.column(c).to_pylist() for c in names)):
                query = np.frombuffer(bits_a, np.uint8)
                members = np.frombuffer(bits, np.uint8).reshape(len(rows), -1)
                union = np.bitwise_or.reduce(members, axis=0)[None]
                if n_a - sh.missing_bits(query, union)[0][0] >= sh.needed(n_a, percent):
                    sizes, others, components = np.array(sizes), np.array(others), np.array(components)
                    fit = 100 * np.minimum(sizes, n_a) >= percent * np.maximum(sizes, n_a)
                    fit &= (others > joined) | ((others == joined) & (components > component))
                    at = np.flatnonzero(fit & allowed(n_a, query, sizes, members, percent))
                    left += [a] * len(at)
                    right += [rows[k] for k in at]
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    return queries.select(
        "a", "n_a", "bits_a", "joined", "component", "rows", "sizes", "others", "components", "bits"
    ).mapInArrow(run, "a long, b long")


def sizes_fit(n_a: Column, n_b: Column, percent: int) -> Column:
    return (F.lit(100) * F.least(n_a, n_b)) >= (F.lit(percent) * F.greatest(n_a, n_b))


def place() -> Column:
    """Where a document stands in a filter of fixed size, from 1 on."""
    return (F.pmod(F.xxhash64("doc_id"), F.lit(1 << FILTER_BITS)) + 1).alias("place")


class Join:
    """The steps of the join over ``docs`` (doc_id, text_key, text)."""

    def __init__(self, docs: DataFrame, size: int, percent: int):
        self.docs, self.size, self.percent = docs, size, percent
        self.described = written(described(docs, size, percent, frequent_shingles(docs, size)), "described")
        self.small = self.described.select("row", "doc_id", "text_key", "n", "high", "low")
        self.bits = self.described.filter("bits IS NOT NULL").select("row", "n", "bits")
        least = self.small.groupBy("high", "low").agg(F.min("row").alias("first"))
        self.classes = written(
            self.small.join(least, ["high", "low"]).select("row", "doc_id", "text_key", "n", "high", "low", "first"), "classes"
        )

    def with_bits(self, pairs: DataFrame, percent: int) -> DataFrame:
        """Pairs of rows (a, b) of fitting sizes, with sizes and bits of both."""
        a = self.bits.select(F.col("row").alias("a"), F.col("n").alias("n_a"), F.col("bits").alias("bits_a"))
        b = self.bits.select(F.col("row").alias("b"), F.col("n").alias("n_b"), F.col("bits").alias("bits_b"))
        return pairs.join(a, "a").join(b, "b").filter(sizes_fit(F.col("n_a"), F.col("n_b"), percent))

    def fetched(self, wanted: DataFrame) -> DataFrame:
        """``wanted`` (high, low, place and others) with the sets of these digests, by shingling their texts once more.

        A filter of fixed size keeps most other texts out before that; the join removes the rest.
        """
        blocks = wanted.groupBy(F.bitmap_bucket_number("place").alias("block")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")
        )
        filter_ = np.zeros(1 << FILTER_BITS - 3, np.uint8)
        for block, bits in blocks.collect():  # a row per 32,768 places
            filter_[(block - 1) * len(bits) : block * len(bits)] = np.frombuffer(bytes(bits), np.uint8)
        known = self.docs.sparkSession.sparkContext.broadcast(filter_)
        size = self.size

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            release()
            keep = np.unpackbits(known.value, bitorder="little").astype(bool)
            seen: set[tuple[int, int]] = set()
            for batch in small_batches(batches):
                batch = batch.filter(pa.array(keep[batch.column("place").to_numpy() - 1]))
                rows = []
                for found in sh.shingle_sets(texts(batch), size):
                    key = sh.digest(found)
                    if key not in seen:
                        seen.add(key)
                        rows.append({"high": key[0], "low": key[1], "shingles": sh.packed(found)})
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("high", pa.int64()), ("low", pa.int64()), ("shingles", pa.binary())]))

        found = self.docs.select("text", place()).mapInArrow(run, "high long, low long, shingles binary")
        once = found.groupBy("high", "low").agg(F.first("shingles").alias("shingles"))
        return once.join(wanted.drop("place"), ["high", "low"])

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Those of ``pairs`` (a, b) that link."""
        percent = self.percent

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                both = zip(batch.column("set_a"), batch.column("set_b"))
                keep = [sh.linked(sh.unpacked(a.as_py()), sh.unpacked(b.as_py()), percent) for a, b in both]
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

        named = self.classes.select("row", "high", "low", place())
        left = written(pairs.join(named.withColumnRenamed("row", "a"), "a"), "left")
        right = written(pairs.select("b").distinct().join(named.withColumnRenamed("row", "b"), "b"), "right")
        with_a = self.fetched(left).select("a", "b", F.col("shingles").alias("set_a"))
        with_b = self.fetched(right).select("b", F.col("shingles").alias("set_b"))
        return written(with_a.join(with_b, "b").select("a", "b", "set_a", "set_b").mapInArrow(run, "a long, b long"), "links")

    def first_groups(self, met: DataFrame) -> DataFrame:
        """(row, component, group) of rows that are like others: documents of a component are joined by links, those of a group by
        links and comparisons that came close.

        In a round each row is compared with one row of another component, of those that it meets (the least row of the least and
        of the greatest component at each shingle) the one with most shingles in common that it was not compared with before.
        """
        firsts = self.classes.select("row", "first")
        links = self.bits.select("row").join(firsts, "row").filter("row <> first").select(F.col("row").alias("a"), F.col("first").alias("b"))
        close = links = written(links, "copies")
        joined = self.components_of(links)
        tried: DataFrame | None = None
        least = min(CLOSE, self.percent)
        for _ in range(ROUNDS):
            at = met.join(joined, "row", "left").withColumn("component", F.coalesce("component", "row")).repartition("token")
            ends = at.groupBy("token").agg(F.min(F.struct("component", "row")).alias("x"), F.max(F.struct("component", "row")).alias("y"))
            apart = at.join(ends.filter("x.component <> y.component"), "token")
            other = F.when(F.col("component") != F.col("x.component"), F.col("x.row")).otherwise(F.col("y.row"))
            shared = apart.select("row", other.alias("b")).groupBy("row", "b").agg(F.count("*").alias("shared"))
            if tried is not None:
                shared = shared.join(tried.withColumnRenamed("a", "row"), ["row", "b"], "left_anti")
            best = shared.groupBy("row").agg(F.max_by("b", F.struct("shared", -F.col("b"))).alias("b"))
            chosen = written(best.select(F.col("row").alias("a"), "b"), "chosen")
            tried = chosen if tried is None else tried.unionAll(chosen)
            near = written(bound_by_bits(self.with_bits(chosen, least), least, self.percent), "near")
            close = close.unionAll(near.select("a", "b"))
            found = self.verified(near.filter("may_link").select("a", "b"))
            if found.isEmpty():
                break
            links = links.unionAll(found)
            joined = self.components_of(links)
        groups = self.components_of(close).withColumnRenamed("component", "group")
        return written(groups.join(joined, "row", "left").withColumn("component", F.coalesce("component", "row")), "groups")

    def components_of(self, links: DataFrame) -> DataFrame:
        return written(connected_components(links).select(F.col("node").alias("row"), "component"), "joined")

    def parts(self, members: DataFrame) -> DataFrame:
        """Groups as parts of at most ``PART`` members of like size: arrays of their rows, sizes and components with their counts,
        and ``bits``, their rows of bits one after the other, of one length in a part.

        ``members`` has group, group_rows, row, n, joined, component, bits; a large group is dealt to many tasks.
        """

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names = ("group", "n", "row", "joined", "component", "bits")
            held: list[tuple] = []

            def part() -> dict:
                group, sizes, rows, others, components, bits = zip(*held)
                return {
                    "group": group[0], "low": sizes[0], "high": sizes[-1], "rows": rows, "sizes": sizes, "others": others,
                    "components": components, "bits": b"".join(bits),
                }

            for batch in small_batches(batches):
                done = []
                for member in zip(*(batch.column(c).to_pylist() for c in names)):
                    if held and (len(held) == PART or member[0] != held[0][0] or len(member[-1]) != len(held[0][-1])):
                        done.append(part())
                        held = []
                    held.append(member)
                yield pa.RecordBatch.from_pylist(done, schema=PARTS)
            if held:
                yield pa.RecordBatch.from_pylist([part()], schema=PARTS)

        deals = (F.floor(F.col("group_rows") / (16 * PART)) + 1).cast("long")
        dealt = members.repartition("group", F.pmod("row", deals))
        ordered = dealt.sortWithinPartitions("group", "n", "row").select("group", "n", "row", "joined", "component", "bits")
        return ordered.mapInArrow(
            run, "group long, low long, high long, rows array<long>, sizes array<long>, others array<long>, components array<long>, bits binary"
        )

    def may_fit(self, n: Column, low: Column, high: Column) -> Column:
        return (F.lit(100) * high >= F.lit(self.percent) * n) & (F.lit(self.percent) * low <= F.lit(100) * n)

    def cross_links(self, met: DataFrame, groups: DataFrame) -> DataFrame:
        """Links between documents of different components, as (a, b) of the components' names."""
        named = met.select("row").distinct().join(self.bits.select("row", "n"), "row").join(groups, "row", "left")
        named = written(named.withColumns({c: F.coalesce(c, "row") for c in ("component", "group")}), "named")
        joined = named.groupBy("component").agg(F.count("*").alias("joined"))
        named = written(named.join(joined, "component"), "named")
        ranges = named.groupBy("group").agg(F.count("*").alias("group_rows"), F.min("n").alias("low"), F.max("n").alias("high"))
        # Dealt out by shingle once: tops are whole rows and candidates keep their own group, so that both uses ask for the same columns, none of which
        # is ever null.  A shingle of one component has that as its only top, and makes no candidate.
        placed = met.join(named, "row").select("token", "row", "n", "joined", "component", "group")
        placed = written(placed, "placed").filter(" AND ".join(f"`{c}` IS NOT NULL" for c in placed.columns)).repartition("token")
        order, top = F.struct("joined", "component"), F.max(F.struct("joined", "component", "row", "n"))
        matrix = placed.groupBy("token", "group").agg(top.alias("top"))
        meet = placed.withColumnRenamed("group", "own").join(matrix, "token").filter(order < F.struct("top.joined", "top.component"))
        candidates = meet.select("row", "n", "joined", "component", "own", "group").distinct().join(ranges, "group")
        fits = self.may_fit(F.col("n"), F.col("low"), F.col("high"))
        fitting = written(candidates.filter(fits).select("row", "n", "joined", "component", "group"), "candidates")
        members = named.join(fitting.select("group").distinct(), "group").join(ranges.select("group", "group_rows"), "group")
        parts = self.parts(members.join(self.bits.select("row", "bits"), "row"))
        queries = fitting.join(self.bits.select("row", F.col("bits").alias("bits_a")), "row").join(parts, "group")
        queries = queries.filter(self.may_fit(F.col("n"), F.col("low"), F.col("high")))
        pairs = written(opened(queries.withColumnsRenamed({"row": "a", "n": "n_a"}), self.percent), "pairs")
        links = self.verified(pairs)
        names = named.select("row", "component")
        return (
            links.join(names.select(F.col("row").alias("a"), F.col("component").alias("x")), "a")
            .join(names.select(F.col("row").alias("b"), F.col("component").alias("y")), "b")
            .select(F.col("x").alias("a"), F.col("y").alias("b"))
        )

    def components(self) -> DataFrame:
        """(row, doc_id, text_key, n, component) of every document; ``component`` names it by a row."""
        met = written(meetings(self.described), "meetings")
        groups = self.first_groups(met)
        joined = connected_components(self.cross_links(met, groups))
        merged = joined.select(F.col("node").alias("component"), F.col("component").alias("merged"))
        # Documents that meet no other have no row in ``groups``: their component's name is their row.
        with_groups = self.classes.join(groups.select(F.col("row").alias("first"), "component"), "first", "left").withColumn(
            "component", F.coalesce("component", "first")
        )
        final = with_groups.join(merged, "component", "left").withColumn("component", F.coalesce("merged", "component"))
        return written(
            final.select("row", "doc_id", "text_key", "n", F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("row")).alias("component")),
            "components",
        )


def similar_documents(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """(row, component, doc_id, text_key, n_shingles, component_id) of each row of ``docs`` (doc_id, text), whatever else it has.

    Two documents link when 100 * shared >= percent * union of their sets of distinct ``size``-word shingles (A-Z lower-cased; all
    words as one shingle where there are fewer).  ``component_id`` is the least doc_id reachable by links, itself included.
    A document without words or text has an empty set and no links.  Repeated rows link with each other; a null id takes
    part and gets the least id of its group, null if there is none; an empty table gives no rows.
    """
    chosen = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text", F.length("text")).alias("text_key"), F.col("text").cast("string"))
    found = Join(chosen, size, percent).components()
    least = found.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    joined = found.join(least, "component")
    alone = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select("row", "component", "doc_id", "text_key", F.col("n").alias("n_shingles"), alone.alias("component_id"))
