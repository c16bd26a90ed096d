"""Mixing sources to target weights by weighted sampling without replacement.

Each source gets a target number of words: a share of the whole by weight, no more than a multiple of what it has, the
excess shared again.  A source is taken in complete epochs first.  The rest of its target is a selection by
Efraimidis and Spirakis: each document has the key -ln(u) / weight, u being uniform and fixed by its content, and documents are
taken in the order of their keys until their sizes add up to the rest; the last one is taken in part.

Prefix sums never gather a source in one task: sizes are summed per source and cell of the key, the cell where the budget
ends is cut into finer cells, and only documents of the finest one are put in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridclear.llm.common import word_count, written

#: Cells of the key have these widths as powers of a half; the finest holds about two of ten thousand million documents.
LEVELS = (8, 20, 32)
SYMBOLS = "#*$%&|<>!"


def quality_weight(text: Column) -> Column:
    """1 for a text without symbols, less the more of its characters are symbols, 0.05 at least."""
    text = F.coalesce(text, F.lit(""))
    symbols = F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
    return F.greatest(F.lit(0.05), F.lit(1.0) - F.lit(10.0) * symbols / F.greatest(F.length(text), F.lit(1)))


def uniform(seed: int) -> Column:
    """Uniform in (0, 1), fixed by seed, id and text."""
    text = F.md5(F.coalesce(F.col("text"), F.lit("")))
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def keyed(docs: DataFrame, seed: int, weight: Column | None = None) -> DataFrame:
    """``docs`` with ``place`` (its source as a text that sorts null last), ``size`` and the sampling ``key``."""
    weight = quality_weight(F.col("text")) if weight is None else weight
    return docs.withColumns(
        {
            "place": F.when(F.col("source").isNull(), "1").otherwise(F.concat(F.lit("0"), "source")),
            "size": word_count(F.col("text")),
            "key": -F.log(uniform(seed)) / weight,
        }
    )


def cell(level: int) -> Column:
    return F.floor(F.col("key") * F.lit(float(1 << LEVELS[level])))


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """(place, source_size, weight, target) from (place, source_size).

    Weights repeat along the sources in order.  Positions come from the sorted partitions and their row counts, and the
    level at which sources fill up is found by sums over the table, so any number of sources will do.
    """
    ordered = written(sizes.orderBy("place").withColumn("id", F.monotonically_increasing_id()), "sources")
    part, row = F.shiftright("id", 33), F.col("id").bitwiseAND((1 << 33) - 1)
    counts = sorted(ordered.groupBy(part.alias("part")).count().collect())
    if not counts:
        return ordered.select("place", "source_size", F.lit(0.0).alias("weight"), F.lit(0.0).alias("target"))
    starts, total = [], 0
    for k, n in counts:
        starts.append((k, total))
        total += n
    first = sizes.sparkSession.createDataFrame(starts, "part long, first long")
    placed = ordered.withColumn("part", part.cast("long")).join(first, "part")
    turn = (F.col("first") + row) % len(weights)
    weighted = written(
        placed.select(
            "place", "source_size", F.element_at(F.array(*map(F.lit, map(float, weights))), (turn + 1).cast("int")).alias("weight"),
            (F.col("source_size") * F.lit(float(most))).alias("cap"),
        ),
        "weighted",
    )
    wanted = share * float(weighted.agg(F.sum("source_size")).head()[0])
    level, capped = 0.0, -1
    while True:
        full = F.col("weight") * F.lit(level) > F.col("cap")
        caps, open_weights, n = weighted.agg(
            F.sum(F.when(full, F.col("cap")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight"))), F.sum(full.cast("long"))
        ).head()
        if n == capped or not open_weights:
            break
        level, capped = (wanted - caps) / open_weights, n
    target = F.least(F.col("weight") * F.lit(level), F.col("cap"))
    return weighted.select("place", "source_size", "weight", target.alias("target"))


def sampling_plan(slim: DataFrame, targets: DataFrame) -> DataFrame:
    """(place, source_size, target, epochs, edge, left): documents in cells before ``edge`` join the last epoch whole, those in it
    as far as ``left`` words go; null: none do.  ``slim`` has place, size and key."""
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    plan = targets.withColumn("epochs", epochs).withColumn(
        "left", F.floor(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long")
    )
    plan = written(plan.drop("weight").withColumn("edge", F.lit(None).cast("long")), "plan")
    for level in range(len(LEVELS)):
        here = slim if not level else slim.withColumn("edge", cell(level - 1)).join(plan.select("place", "edge"), ["place", "edge"], "left_semi")
        sums = here.groupBy("place", cell(level).alias("cell")).agg(F.sum("size").alias("words"))
        running = F.sum("words").over(Window.partitionBy("place").orderBy("cell"))
        ends = (
            sums.withColumn("through", running)
            .join(plan.select("place", "left"), "place")
            .filter((F.col("through") >= F.col("left")) & (F.col("through") - F.col("words") < F.col("left")))
            .select("place", F.col("cell").alias("edge"), (F.col("left") - F.col("through") + F.col("words")).alias("left"))
        )
        plan = written(plan.drop("edge", "left").join(ends, "place", "left"), "plan")
    return plan


def take(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """``docs`` (place, size, key and any others) with source_size, target and taken."""
    joined = docs.join(plan, "place").withColumn("cell", cell(len(LEVELS) - 1))
    at_edge = F.coalesce(F.col("cell") == F.col("edge"), F.lit(False))
    whole = F.when(F.col("cell") < F.col("edge"), F.col("size")).otherwise(0)
    before = F.sum("size").over(Window.partitionBy("place").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1))
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("left") - F.coalesce(before, F.lit(0))))
    last = joined.filter(~at_edge).withColumn("part", whole).unionAll(joined.filter(at_edge).withColumn("part", part))
    return last.withColumn("taken", (F.col("epochs") * F.col("size") + F.col("part")).cast("long")).drop(
        "part", "cell", "edge", "left", "epochs"
    )


def first_words(text: Column, n: Column) -> Column:
    """``text`` up to the end of its n-th word."""
    ends = F.split(text, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    return F.array_join(F.slice(ends, F.lit(1), n.cast("int")), "")


class Mix:
    """How ``docs`` (doc_id, text, source) are mixed; the plan is computed once and holds a row per source.

    ``share`` of all words is wanted, no source gives more than ``most`` times what it has.  A null or empty text has
    size 0 and is never taken; null sources form one source, the last; repeated rows are documents of their own; an empty
    table gives no rows.  The same rows and seed give the same result.
    """

    def __init__(self, docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 0):
        self.docs = docs.withColumns({"text": F.col("text").cast("string"), "source": F.col("source").cast("string")})
        self.seed = seed
        chosen = self.docs.select(F.col("doc_id").cast("long"), "text", "source")
        self.slim = written(keyed(chosen, seed).select("doc_id", "place", "size", "key"), "mix")
        sizes = self.slim.groupBy("place").agg(F.sum("size").alias("source_size"))
        self.plan = sampling_plan(self.slim, source_targets(sizes, weights, share, most))

    def decisions(self) -> DataFrame:
        """(doc_id, size, source_size, target, taken) for each document."""
        return take(self.slim, self.plan).select("doc_id", "size", "source_size", "target", "taken")

    def documents(self) -> DataFrame:
        """The rows of ``docs``, each as often as it is taken; the one at the end of a budget is cut after its last word taken."""
        columns = self.docs.columns
        packed = self.docs.select("doc_id", "text", "source", F.struct(*columns).alias("row"))
        taken = take(keyed(packed, self.seed), self.plan).filter("taken > 0")
        words = F.array_repeat(F.col("size"), (F.col("taken") / F.col("size")).cast("int"))
        rest = F.col("taken") % F.col("size")
        copies = F.when(rest > 0, F.array_append(words, rest)).otherwise(words)
        copied = taken.select("row", "size", F.explode(copies).alias("words"))
        text = F.when(F.col("words") == F.col("size"), F.col("row.text")).otherwise(first_words(F.col("row.text"), F.col("words")))
        changed = {"text": text, "n_chars": F.length(text).cast("long")}
        return copied.select(*(changed.get(c, F.col("row")[c]).alias(c) for c in columns))
