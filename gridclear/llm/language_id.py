"""Language identification by a bidirectional gated recurrent network over bytes.

Texts are read in windows of bytes, forwards and backwards; each position gets a label distribution from both states, and
a document's distribution is the mean over all its positions.  The network is trained in numpy by
backpropagation through time, on excerpts of a bounded number of labelled documents, inside one task.
"""

from __future__ import annotations

import io
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridclear.llm.common import map_batches, release, texts

UNKNOWN = "und"
WINDOW = 64  # bytes read in one go
CHUNK = 4096  # windows computed side by side
FOLDS = 5


@dataclass(frozen=True)
class Training:
    """``sample`` bounds the labelled documents that are learned from; the rest are its excerpts, network and descent."""

    sample: int = 4096
    excerpt_chars: int = 160
    hidden: int = 12
    steps: int = 400
    batch: int = 384
    rate: float = 0.01
    seed: int = 1


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from: a fifth by the checksum of the id, and those without id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(True))


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def windows_of(data: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts as rows of WINDOW bytes, the used bytes of each row, and the first row of each text."""
    rows = np.array([-(-len(d) // WINDOW) for d in data])
    first = np.concatenate([[0], np.cumsum(rows)])
    flat = np.zeros(first[-1] * WINDOW, np.uint8)
    used = np.full(first[-1], WINDOW)
    for d, start, end in zip(data, first, first[1:]):
        if end > start:
            flat[start * WINDOW : start * WINDOW + len(d)] = np.frombuffer(d, np.uint8)
            used[end - 1] = len(d) - (end - 1 - start) * WINDOW
    return flat.reshape(-1, WINDOW), used, first[:-1]


class Direction:
    """Gated recurrent cells of one reading direction: update gate z, reset gate r, candidate n.

    ``inputs`` (256, 3 hidden) holds each byte's contribution with the biases, ``states`` (3 hidden, hidden) that of the state before.
    """

    def __init__(self, inputs: np.ndarray, states: np.ndarray):
        self.inputs, self.states = inputs, states
        self.hidden = states.shape[1]

    def read(self, codes: np.ndarray) -> np.ndarray:
        """States after each step, (steps, hidden, rows), for bytes (steps, rows)."""
        steps, rows = codes.shape
        size = self.hidden
        # The gates' logistic function is (1 + tanh(x / 2)) / 2.
        halved = np.repeat(np.array([0.5, 1.0], np.float32), [2 * size, size])
        inputs = np.ascontiguousarray((self.inputs * halved).T)
        weights = self.states * halved[:, None]
        out = np.empty((steps, size, rows), np.float32)
        before = np.zeros((size, rows), np.float32)
        given = np.empty((3 * size, rows), np.float32)
        sums = np.empty((3 * size, rows), np.float32)
        gates, z, r, n = sums[: 2 * size], sums[:size], sums[size : 2 * size], sums[2 * size :]
        for t in range(steps):
            np.take(inputs, codes[t], axis=1, out=given, mode="clip")
            np.matmul(weights, before, out=sums)
            gates += given[: 2 * size]
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5
            n *= r
            n += given[2 * size :]
            np.tanh(n, out=n)
            before = out[t] = n + z * (before - n)
        return out

    def gradients(self, codes: np.ndarray, states: np.ndarray, upstream: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backpropagation through time: gradients of inputs and states from those of every step's state."""
        steps, rows = codes.shape
        size = self.hidden
        d_inputs = np.zeros((256, 3 * size), np.float32)
        d_weights = np.zeros_like(self.states)
        d_next = np.zeros((size, rows), np.float32)
        zero = np.zeros((size, rows), np.float32)
        all_given = np.empty((3 * size, steps, rows), np.float32)
        for t in range(steps - 1, -1, -1):
            before = states[t - 1] if t else zero
            given, sums = self.inputs[codes[t]].T, self.states @ before
            z, r = (1 / (1 + np.exp(-(given[k : k + size] + sums[k : k + size]))) for k in (0, size))
            n = np.tanh(given[2 * size :] + r * sums[2 * size :])
            d_state = upstream[t] + d_next
            d_n = d_state * (1 - z) * (1 - n * n)
            d_z = d_state * (before - n) * z * (1 - z)
            d_r = d_n * sums[2 * size :] * r * (1 - r)
            all_given[:size, t], all_given[size : 2 * size, t], all_given[2 * size :, t] = d_z, d_r, d_n
            d_sums = np.concatenate([d_z, d_r, d_n * r])
            d_weights += d_sums @ before.T
            d_next = d_state * z + self.states.T @ d_sums
        flat = codes.ravel()
        for k in range(3 * size):
            d_inputs[:, k] = np.bincount(flat, all_given[k].ravel(), 256)
        return d_inputs, d_weights


class Network:
    """Both directions and the output layer; ``languages`` in code point order."""

    def __init__(self, languages: list[str], arrays: list[np.ndarray]):
        self.languages, self.arrays = languages, arrays

    @classmethod
    def random(cls, languages: list[str], hidden: int, rng: np.random.Generator) -> Network:
        def scaled(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) / np.sqrt(hidden)).astype(np.float32)

        n = len(languages)
        arrays = [scaled(256, 3 * hidden), scaled(3 * hidden, hidden), scaled(256, 3 * hidden), scaled(3 * hidden, hidden)]
        return cls(languages, [*arrays, scaled(n, 2 * hidden), np.zeros((n, 1), np.float32)])

    def directions(self) -> tuple[Direction, Direction]:
        return Direction(*self.arrays[:2]), Direction(*self.arrays[2:4])

    def position_probabilities(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Label distribution of every position, (steps, labels, rows), and the states of both directions."""
        forwards, backwards = self.directions()
        ahead, back = forwards.read(codes), backwards.read(codes[::-1])[::-1]
        size = ahead.shape[1]
        weights, bias = self.arrays[4:]
        logits = np.matmul(weights[:, :size], ahead) + np.matmul(weights[:, size:], back) + bias
        logits -= logits.max(axis=1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        return logits, ahead, back

    def probabilities(self, data: list[bytes]) -> np.ndarray:
        """Mean distribution over all positions of each text, (texts, labels); an empty text gets zeros."""
        rows, used, first = windows_of(data)
        sums = np.zeros((len(rows), len(self.languages)))
        for start in range(0, len(rows), CHUNK):
            codes = np.ascontiguousarray(rows[start : start + CHUNK].T).astype(np.intp)
            p, _, _ = self.position_probabilities(codes)
            p *= np.arange(WINDOW)[:, None, None] < used[start : start + CHUNK]
            sums[start : start + CHUNK] = p.sum(axis=0).T
        totals = np.zeros((len(data), len(self.languages)))
        filled = np.array([len(d) > 0 for d in data], bool)
        if filled.any():
            totals[filled] = np.add.reduceat(sums, first[filled], axis=0)
        return totals / np.maximum([[len(d)] for d in data], 1)

    def gradients(self, codes: np.ndarray, used: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        p, ahead, back = self.position_probabilities(codes)
        size = ahead.shape[1]
        mask = (np.arange(WINDOW)[:, None] < used) * weight
        p[:, labels, np.arange(codes.shape[1])] -= 1
        p *= (mask / mask.sum())[:, None, :]
        d_out = np.concatenate([np.einsum("tlb,thb->lh", p, s, optimize=True) for s in (ahead, back)], axis=1)
        weights = self.arrays[4]
        forwards, backwards = self.directions()
        d_ahead = forwards.gradients(codes, ahead, np.matmul(weights[:, :size].T, p))
        d_back = backwards.gradients(codes[::-1], back[::-1], np.matmul(weights[:, size:].T, p)[::-1])
        return [*d_ahead, *d_back, d_out, p.sum(axis=(0, 2))[:, None]]

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, languages=np.array(self.languages), **{f"a{k}": a for k, a in enumerate(self.arrays)})
        return out.getvalue()

    @classmethod
    def from_bytes(cls, stored: bytes) -> Network:
        with np.load(io.BytesIO(stored)) as found:
            return cls(found["languages"].tolist(), [found[f"a{k}"] for k in range(6)])


def train(examples: list[tuple[str, str]], how: Training) -> Network | None:
    """A network from (text, language) pairs, by Adam; None without examples."""
    examples = sorted((t, lang) for t, lang in examples if has_letter(t))
    if not examples:
        return None
    rng = np.random.default_rng(how.seed)
    languages = sorted({lang for _, lang in examples})
    rows, used, first = windows_of([t.lower().encode() for t, _ in examples])
    per_text = np.diff([*first, len(rows)])
    labels = np.repeat([languages.index(lang) for _, lang in examples], per_text)
    shares = np.bincount(labels, minlength=len(languages)) / len(labels)
    weight = 1 / np.sqrt(shares[labels])
    network = Network.random(languages, how.hidden, rng)
    mean = [np.zeros_like(a) for a in network.arrays]
    square = [np.zeros_like(a) for a in network.arrays]
    for step in range(1, how.steps + 1):
        at = rng.integers(0, len(rows), how.batch)
        codes = np.ascontiguousarray(rows[at].T).astype(np.intp)
        rate = how.rate * min(1.0, 2 * (1 - step / (how.steps + 1)))
        for a, g, m, s in zip(network.arrays, network.gradients(codes, used[at], labels[at], weight[at]), mean, square):
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            a -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return network


def fit(docs: DataFrame, how: Training = Training()) -> Network | None:
    """Learns from at most ``how.sample`` labelled documents that are not held out, chosen by a hash; one excerpt of each.

    The excerpts, some hundred bytes each, are all that leaves the scan; training runs in one task.
    """
    text = F.col("text").cast("string")
    hashed = F.xxhash64(F.col("doc_id").cast("string"), F.lit(how.seed))
    start = F.pmod(hashed, F.greatest(F.length(text) - how.excerpt_chars, F.lit(1))) + 1
    sample = (
        docs.filter(text.isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
        .select(
            F.substring(text, start.cast("int"), F.lit(how.excerpt_chars)).alias("text"), F.col("lang").cast("string"), hashed.alias("hash")
        )
        .orderBy("hash", "text", "lang")
        .limit(how.sample)
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = [(r["text"], r["lang"]) for b in batches for r in b.to_pylist()]
        network = train(examples, how)
        if network is not None:
            yield pa.RecordBatch.from_pydict({"stored": [network.to_bytes()]})

    found = sample.coalesce(1).mapInArrow(run, "stored binary").head()
    return Network.from_bytes(bytes(found[0])) if found else None


def predict(docs: DataFrame, network: Network | None) -> DataFrame:
    """(doc_id, text_key, held_out, lang_pred, score) for each row of ``docs`` (doc_id, text), whatever else it has.

    A null text, or one without letters, is ``und`` with score 0; so is every text if nothing could be learned.  Rows with equal
    ids are predicted each for itself, null ids stay null, an empty table gives no rows.
    """
    stored = docs.sparkSession.sparkContext.broadcast(network.to_bytes() if network else None)
    loaded: list[Network] = []

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        if stored.value is not None and not loaded:
            release()
            loaded.append(Network.from_bytes(stored.value))
        all_texts = texts(batch)
        known = [has_letter(t) for t in all_texts]
        languages, scores = [UNKNOWN] * len(known), [0.0] * len(known)
        if loaded:
            p = loaded[0].probabilities([t.lower().encode() if k else b"" for t, k in zip(all_texts, known)])
            best = p.argmax(axis=1)
            for i, k in enumerate(known):
                if k:
                    languages[i], scores[i] = loaded[0].languages[best[i]], min(1.0, float(p[i, best[i]]))
        names = ["doc_id", "text_key", "held_out", "lang_pred", "score"]
        arrays = [batch.column(c) for c in names[:3]] + [pa.array(languages, pa.string()), pa.array(scores, pa.float64())]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    chosen = docs.select(
        F.col("doc_id").cast("long"), F.xxhash64("text", F.length("text")).alias("text_key"), held_out(F.col("doc_id")).alias("held_out"),
        F.col("text").cast("string"),
    )
    return map_batches(chosen, rows, "doc_id long, text_key long, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, how: Training = Training()) -> DataFrame:
    """``predict`` with a network learned from ``docs`` (doc_id, text, lang)."""
    return predict(docs, fit(docs, how))
