"""Toxicity: a linear classifier of character n-grams, scaled by naive Bayes log-count ratios.

A text is the set of its character n-grams, hashed into cells.  Over the labelled documents of a bounded sample, each cell has
the ratio of the shares of toxic and clean documents that hold it; its logarithm scales the cell's feature, so that cells which
tell nothing weigh nothing, and logistic regression is trained on the scaled features.  Texts are then scored in one pass.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridclear.llm.common import map_batches, small_batches, texts, written

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
PIECE = 1 << 17  # characters that are cut into n-grams at once


@dataclass(frozen=True)
class Training:
    """``sample`` bounds the labelled documents that are learned from, toxic and clean each; the rest are features and descent."""

    sample: int = 4096
    lengths: tuple[int, ...] = (3, 4, 5, 6)
    bits: int = 20  # of a cell's number
    features: int = 8192  # cells kept, those with the most evidence
    least_documents: int = 5  # that hold a cell
    smoothing: float = 2.0
    penalty: float = 0.3  # shared by the documents learned from, so that few of them are not learned by heart
    steps: int = 300
    rate: float = 0.05
    tasks: int = 32  # for the sample's texts
    seed: int = 5


def held_out(doc_id: Column) -> Column:
    """Documents whose label is never learned: a quarter by the checksum of the id, and those without id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT, F.lit(True))


def normal(text: str) -> str:
    """Lower case, with one space for each run of white space and at both ends."""
    return f" {' '.join(text.lower().split())} "


def pieces(all_texts: Iterable[str], overlap: int) -> Iterator[tuple[int, str]]:
    """(place of the text, piece): long texts in pieces that share ``overlap`` characters, so no n-gram is lost or cut."""
    for i, text in enumerate(all_texts):
        text = normal(text)
        for start in range(0, max(1, len(text) - overlap), PIECE):
            yield i, text[start : start + PIECE + overlap]


def cells_of(owners: np.ndarray, group: list[str], how: Training, feature: np.ndarray | None) -> np.ndarray:
    """owner * 2^32 + cell of every n-gram of the pieces, repeated as often as it occurs; with ``feature``, of those that have one."""
    codes = np.frombuffer("".join(group).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    ends = np.cumsum([len(p) for p in group])
    found = []
    rolling = codes
    for n in range(2, max(how.lengths) + 1):
        rolling = rolling[:-1] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1 :]
        if n in how.lengths:
            cell = (rolling ^ np.uint64(n)) * np.uint64(0xD6E8FEB86659FD93)
            cell >>= np.uint64(64 - how.bits)
            cell = cell.view(np.int64)
            if feature is None:
                at = np.arange(len(cell))
            else:
                known = feature[cell]
                at = np.flatnonzero(known >= 0)
                cell = known[at].astype(np.int64)
            piece = np.searchsorted(ends, at, "right")
            inside = at + n <= ends[piece]
            found.append(owners[piece[inside]] << 32 | cell[inside])
    return np.concatenate(found)


def distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values in order, by sorting."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def presence(all_texts: list[str], how: Training, feature: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (text, cell) of all whole texts in order; with ``feature``, the features of cells that have one (not -1)."""
    found = [np.zeros(0, np.int64)]
    overlap = max(how.lengths) - 1

    def add(group: list[tuple[int, str]]) -> None:
        found.append(distinct(cells_of(np.array([i for i, _ in group]), [p for _, p in group], how, feature)))

    group, chars = [], 0
    for i, piece in pieces(all_texts, overlap):
        group.append((i, piece))
        chars += len(piece)
        if chars >= PIECE:
            add(group)
            group, chars = [], 0
    if group:
        add(group)
    both = distinct(np.concatenate(found))
    return both >> 32, both & 0xFFFFFFFF


@dataclass
class Model:
    """Weights of the cells that have one, and the log odds of a text without any of them."""

    cells: np.ndarray
    weights: np.ndarray
    bias: float
    how: Training = Training()
    _feature: np.ndarray | None = None

    def features(self) -> np.ndarray:
        """The place of each cell's weight, or -1."""
        if self._feature is None:
            kind = np.int16 if len(self.cells) < 1 << 15 else np.int32  # small, as it is looked up at random
            self._feature = np.full(1 << self.how.bits, -1, kind)
            self._feature[self.cells] = np.arange(len(self.cells), dtype=kind)
        return self._feature

    def scores(self, all_texts: list[str]) -> np.ndarray:
        """Probability that each text would be labelled toxic."""
        owner, feature = presence(all_texts, self.how, self.features())
        logits = self.bias + np.bincount(owner, self.weights[feature], len(all_texts))
        return 1 / (1 + np.exp(-np.clip(logits, -60, 60)))


def labelled_sample(docs: DataFrame, labels: DataFrame, how: Training) -> tuple[DataFrame, int, int]:
    """(text, toxic) of at most ``how.sample`` documents of each label, and the numbers of toxic and clean labels that may be learned.

    Documents are chosen by a threshold on the hash of the id, so only chosen ids leave the labels.  A document labelled more
    than once is toxic if any label says so; of rows with equal ids one text is learned.
    """
    known = (
        labels.filter(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("id"))
        .agg(F.max((F.col("toxic") != 0).cast("int")).alias("toxic"))
    )
    known = written(known, "labels")
    toxic, clean = (int(n or 0) for n in known.agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).head())
    share = F.when(F.col("toxic") == 1, how.sample / max(toxic, 1)).otherwise(how.sample / max(clean, 1))
    place = F.pmod(F.xxhash64("id", F.lit(how.seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = known.filter(place < share).limit(4 * how.sample)  # about twice the sample: the limit only proves the bound
    texts_ = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    one = texts_.join(F.broadcast(chosen), "id").groupBy("id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    return written(one.repartition(how.tasks, "id").select("text", "toxic"), "sample"), toxic, clean


def cell_counts(sample: DataFrame, how: Training) -> DataFrame:
    """(cell, toxic, clean): documents of the sample that hold each cell, counted within tasks first."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << how.bits), np.int64)
        for batch in small_batches(batches):
            owner, cell = presence(texts(batch), how)
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False)[owner]
            for label in (0, 1):
                counts[label] += np.bincount(cell[toxic == label], minlength=1 << how.bits)
        used = np.flatnonzero(counts.any(axis=0))
        for start in range(0, len(used), 1 << 16):
            part = used[start : start + (1 << 16)]
            yield pa.RecordBatch.from_pydict({"cell": part, "toxic": counts[1][part], "clean": counts[0][part]})

    counted = sample.mapInArrow(run, "cell long, toxic long, clean long")
    return counted.groupBy("cell").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def log_count_ratios(counts: DataFrame, toxic: int, clean: int, how: Training) -> DataFrame:
    """(cell, ratio) of the cells with the most evidence of toxicity: toxic documents times the ratio, where that is above 0.

    The ratio is the logarithm of the share of toxic documents that hold the cell by that of clean ones, each count with its part
    of the smoothing.
    """
    total = toxic + clean
    ratio = F.log((F.col("toxic") + how.smoothing * toxic / total) / (F.col("clean") + how.smoothing * clean / total)) - F.log(
        F.lit(toxic / clean)
    )
    held = F.col("toxic") + F.col("clean")
    kept = counts.filter(held >= how.least_documents).select("cell", ratio.alias("ratio"), (F.col("toxic") * ratio).alias("evidence"))
    return kept.filter("evidence > 0").orderBy(F.desc("evidence"), "cell").limit(how.features).select("cell", "ratio")


def descend(rows: np.ndarray, columns: np.ndarray, labels: np.ndarray, ratios: np.ndarray, how: Training) -> tuple[np.ndarray, float]:
    """Weights and bias of logistic regression on features that are ``ratios`` where (row, column) is given, by Adam."""
    weights, penalty = np.zeros(len(ratios) + 1), how.penalty / len(labels)
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, how.steps + 1):
        logits = weights[-1] + np.bincount(rows, (weights[:-1] * ratios)[columns], len(labels))
        off = (1 / (1 + np.exp(-np.clip(logits, -60, 60))) - labels) / len(labels)
        gradient = np.append(np.bincount(columns, off[rows], len(ratios)) * ratios + penalty * weights[:-1], off.sum())
        mean += 0.1 * (gradient - mean)
        square += 0.01 * (gradient * gradient - square)
        rate = how.rate * min(1.0, 2 * (1 - step / (how.steps + 1)))
        weights -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
    return weights[:-1] * ratios, float(weights[-1])


def fit(docs: DataFrame, labels: DataFrame, how: Training = Training()) -> Model:
    """Learns from labels of documents that are not held out.

    Where only one label, or none, can be learned, every text scores the share of toxic labels (0 without any).  The descent runs in one task on
    the features of the sample, whose number the parameters bound.
    """
    none = np.zeros(0, np.int64)
    sample, toxic, clean = labelled_sample(docs, labels, how)
    learned = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(learned) < 2:
        share = min(max(toxic / max(toxic + clean, 1), 1e-9), 1 - 1e-9)
        return Model(none, np.zeros(0), float(np.log(share / (1 - share))), how)
    chosen = log_count_ratios(cell_counts(sample, how), learned[1], learned[0], how).collect()
    chosen.sort()
    cells, ratios = np.array([r["cell"] for r in chosen], np.int64), np.array([r["ratio"] for r in chosen])
    feature = sample.sparkSession.sparkContext.broadcast(Model(cells, ratios, 0.0, how))

    def vectors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            owner, found = presence(texts(batch), how, feature.value.features())
            ends = np.searchsorted(owner, np.arange(batch.num_rows + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(found.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([lists, batch.column("toxic")], names=["features", "toxic"])

    def train(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column("features"), b.column("toxic").to_numpy(zero_copy_only=False)) for b in batches if b.num_rows]
        columns = np.concatenate([f.flatten().to_numpy() for f, _ in parts])
        sizes = np.concatenate([f.value_lengths().to_numpy() for f, _ in parts])
        y = np.concatenate([t for _, t in parts])
        # The order in which rows arrive must not matter: sums are taken over rows in the order of their features.
        first = np.concatenate([[0], np.cumsum(sizes)])
        order = sorted(range(len(y)), key=lambda i: (y[i], columns[first[i] : first[i + 1]].tobytes()))
        columns = np.concatenate([columns[first[i] : first[i + 1]] for i in order])
        rows = np.repeat(np.arange(len(y)), sizes[order])
        weights, bias = descend(rows, columns.astype(np.int64), y[order].astype(float), ratios, how)
        yield pa.RecordBatch.from_pydict({"weights": [weights.tolist()], "bias": [bias]})

    rows = written(sample.mapInArrow(vectors, "features array<int>, toxic int"), "vectors")
    found = rows.coalesce(1).mapInArrow(train, "weights array<double>, bias double").head()
    # The sample holds as many toxic as clean documents at best: the bias is moved to the odds of all labels.
    odds = np.log(toxic / clean) - np.log(learned[1] / learned[0])
    return Model(cells, np.array(found["weights"]), found["bias"] + float(odds), how)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs`` (doc_id, text), whatever else it has.

    The score depends on the text alone: a null text counts as empty, equal texts have equal scores.  Repeated rows are scored
    each for itself, null ids stay null (and count as held out), an empty table gives no rows.  Texts of any length are read whole, in pieces.
    """
    known = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = known.value.scores(texts(batch))
        arrays = [batch.column("doc_id"), batch.column("held_out"), pa.array(found), pa.array((found >= THRESHOLD).astype(np.int32))]
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "held_out", "score", "predicted"])

    chosen = docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string"))
    return map_batches(chosen, rows, "doc_id long, held_out boolean, score double, predicted int")


def rate(docs: DataFrame, labels: DataFrame, how: Training = Training()) -> DataFrame:
    """``score`` with a model learned from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic: not 0 if toxic, null if unknown)."""
    return score(docs, fit(docs, labels, how))
