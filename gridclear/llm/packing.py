"""Harmonic packing of token sequences.

Lengths are partitioned into classes by reciprocals of the capacity C: a document of class j is at most C / j tokens long, longer than
the next class admits, and a bin of class j takes exactly j whole documents.  The room that they leave is filled by the tokens of a few other
documents, which are cut: what lies beyond the whole sequences of those longer than C, and now and then a long document while room is
waiting.  Every task fills its own bins and needs nothing of other tasks.  The documents of its unfilled bins fill the last room, what
is left of them is laid end to end and cut into full sequences, and a last rest of fewer than C tokens by its powers of two, which
need no padding.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import deque
from collections.abc import Iterable, Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridclear.llm.common import resident, small_batches, texts
from gridclear.llm.tokenizer_files import PreTokens

MEMO = 1 << 19  # words of a generation whose ids a worker keeps: two of them take about 200 MB
GO = 1 << 13  # words encoded at a time
CUT_AT_ONCE = 1 << 18  # bytes of text that are words at a time: those take some twenty times as much
ID_BYTES = 4
PATIENCE = 16  # waiting bins after which the next class may be cut for them too
MOST_PATIENCE = 6  # times that many: any document may
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


class Encoder:
    """Ids of texts as little-endian 32-bit numbers, from a bounded memo of words.

    The memo has two generations: when the younger is full it becomes the older, whose words come back when they are met.
    """

    def __init__(self, file: str, memo: int = MEMO):
        self.rule, self.memo = PreTokens(file), memo
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.special = {t: np.array([i], "<u4").tobytes() for t, i in self.rule.special.items()}
        suffix = getattr(self.rule.tokenizer.model, "end_of_word_suffix", None)
        names = sorted((i, token) for token, i in self.rule.tokenizer.get_vocab().items())
        self.ends = np.array([token.endswith(suffix) for _, token in names]) if suffix else None

    def ids(self, texts: list[str]) -> list[bytes]:
        if len(self.young) >= self.memo:
            self.old, self.young = self.young, {}
        known = self.young.get
        cut, holes = [], []
        for text in texts:
            pieces = []
            for k, part in enumerate(self.rule.parts(text)):
                if k % 2:
                    pieces.append([self.special[part]])
                else:
                    words = self.rule.split(part)
                    found = list(map(known, words))
                    holes += [(found, i, words[i]) for i, f in enumerate(found) if f is None]
                    pieces.append(found)
            cut.append(pieces)
        self.learn(dict.fromkeys(word for _, _, word in holes))
        for found, i, word in holes:
            found[i] = self.young[word]
        return [b"".join(chain.from_iterable(pieces)) for pieces in cut]

    def learn(self, words: Iterable[str]) -> None:
        new = []
        for word in words:
            known = self.old.get(word)
            if known is None:
                new.append(word)
            else:
                self.young[word] = known
        for k in range(0, len(new), GO):
            some = new[k : k + GO]
            self.young.update(zip(some, self.encoded(some)))

    def encoded(self, words: list[str]) -> list[bytes]:
        """Ids of each word; where each word has a last token that no other position can have, from one text of them all."""
        if self.ends is not None:
            ids = np.array(self.rule.encode([" ".join(words)])[0], "<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(words):
                data, bounds = ids.tobytes(), [0, *(stops * ID_BYTES).tolist()]
                return [data[a:b] for a, b in zip(bounds, bounds[1:])]
        return [np.array(ids, "<u4").tobytes() for ids in self.rule.encode(words)]


def encoder_of(file: str, memo: int) -> Encoder:
    """One instance per worker process."""
    return resident(("encoder", file, memo), lambda: Encoder(file, memo))


def class_counts(capacity: int) -> list[int]:
    """Documents per bin of each class, rising: 1 to 16, then four steps to each doubling, so that few bins stay open at the end."""
    counts = set(range(1, 17)) | {16 * (4 + k) // 4 << i for i in range(capacity.bit_length()) for k in range(4)}
    return sorted(j for j in counts if j <= capacity)


class Piece(NamedTuple):
    """``ids`` of a document from ``start``; ``total`` are its tokens."""

    doc_id: int | None
    start: int
    ids: bytes
    total: int

    @property
    def length(self) -> int:
        return len(self.ids) // ID_BYTES

    def cut(self, length: int) -> tuple[Piece, Piece]:
        at = length * ID_BYTES
        return self._replace(ids=self.ids[:at]), self._replace(start=self.start + length, ids=self.ids[at:])


def tokens(pieces: Iterable[Piece]) -> int:
    return sum(piece.length for piece in pieces)


class Bin:
    """A sequence that is being filled."""

    def __init__(self, pieces: Iterable[Piece], capacity: int):
        self.pieces = list(pieces)
        self.room = capacity - tokens(self.pieces)

    def put(self, piece: Piece) -> Piece | None:
        """Takes what there is room for and returns the rest."""
        rest = None
        if piece.length > self.room:
            piece, rest = piece.cut(self.room)
        self.pieces.append(piece)
        self.room -= piece.length
        return rest


class HarmonicPacker:
    """Rows (doc_id, start, length, crc, doc_tokens, sequence_id, offset) of one worker's sequences.

    It holds an open bin per class, and waiting ones while their room is smaller than the next document: no more than a sequence has
    tokens, and a hundred as a rule.
    """

    def __init__(self, capacity: int, first_sequence: int):
        self.capacity, self.sequence = capacity, first_sequence
        self.counts = class_counts(capacity)
        self.open: dict[int, list[Piece]] = {j: [] for j in self.counts}
        self.waiting: deque[Bin] = deque()  # they have their number of documents, and room
        self.room = 0  # of all that wait
        self.loose: deque[Piece] = deque()  # pieces to fill it, less than a sequence
        self.rows: list[tuple] = []

    def class_of(self, length: int) -> int:
        """The number of documents of this length that a bin takes."""
        return self.counts[bisect_right(self.counts, self.capacity // length) - 1]

    def add(self, doc_id: int | None, ids: bytes) -> None:
        total, c = len(ids) // ID_BYTES, self.capacity
        if total > c:
            ends = total - total % c
            for start in range(0, ends, c):
                self.emit([Piece(doc_id, start, ids[start * ID_BYTES : (start + c) * ID_BYTES], total)])
            if ends < total:
                self.fill(Piece(doc_id, ends, ids[ends * ID_BYTES :], total))
            return
        doc, j = Piece(doc_id, 0, ids, total), self.class_of(total)
        if self.is_filler(total, j):
            self.fill(doc)
            return
        self.open[j].append(doc)
        if len(self.open[j]) == j:
            self.finish(Bin(self.open[j], self.capacity))
            self.open[j] = []

    def is_filler(self, length: int, j: int) -> bool:
        """Whether a document is cut for the room that waits: only the longest are while little does, so that few are cut."""
        patience = len(self.waiting) // PATIENCE
        return length <= self.room and (j <= 1 + patience or patience >= MOST_PATIENCE)

    def finish(self, full: Bin) -> None:
        if full.room:
            self.waiting.append(full)
            self.room += full.room
            self.pour()
        else:
            self.emit(full.pieces)

    def fill(self, piece: Piece) -> None:
        """Cuts a piece into waiting room; pieces that find none make sequences of their own once they suffice for one."""
        self.loose.append(piece)
        self.pour()
        if tokens(self.loose) >= self.capacity:
            own = Bin([], self.capacity)
            while own.room:
                self.feed(own)
            self.emit(own.pieces)

    def pour(self) -> None:
        """Loose pieces into waiting bins, oldest first."""
        while self.loose and self.waiting:
            first = self.waiting[0]
            self.room -= first.room
            self.feed(first)
            self.room += first.room
            if not first.room:
                self.emit(self.waiting.popleft().pieces)

    def feed(self, target: Bin) -> None:
        rest = target.put(self.loose.popleft())
        if rest:
            self.loose.appendleft(rest)

    def emit(self, pieces: Iterable[Piece]) -> None:
        offset = 0
        for piece in pieces:
            self.rows.append((piece.doc_id, piece.start, piece.length, zlib.crc32(piece.ids), piece.total, self.sequence, offset))
            offset += piece.length
        self.sequence += 1

    def close(self) -> None:
        """Fills the waiting bins with what unfilled bins hold, and cuts what is left of that into sequences without padding.

        Where it does not suffice, the bins that came last are given up, and their documents join it.
        """
        self.loose.extend(p for j in self.counts for p in self.open[j])
        self.open = {j: [] for j in self.counts}
        left = tokens(self.loose)
        while self.room > left:
            given_up = self.waiting.pop()
            self.room -= given_up.room
            left += self.capacity - given_up.room
            self.loose.extend(given_up.pieces)
        left -= self.room
        self.pour()
        while left:
            last = Bin([], self.capacity if left >= self.capacity else 1 << left.bit_length() - 1)
            left -= last.room
            while last.room:
                self.feed(last)
            self.emit(last.pieces)

    def take(self) -> pa.RecordBatch:
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        columns = list(zip(*self.rows)) if self.rows else [[] for _ in names]
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def pack(docs: DataFrame, file: str, capacity: int = 2048, end_id: int = 1, memo: int = MEMO) -> DataFrame:
    """One row per piece of each document of ``docs`` (doc_id, text): where it lies in its document and in its sequence.

    A document is its ids, without special tokens added, then ``end_id``; a null or empty text is ``end_id`` alone.
    ``sequence_id`` is unique; ``offset`` runs without gaps from 0.  Rows with equal ids are packed each for itself; a null
    id stays null; an empty table gives no rows.  Sequences are padded to ``capacity`` (a power of two) unless
    their tokens are a power of two.  ``memo`` trades a worker's memory for time.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(file, memo)
        packer = HarmonicPacker(capacity, TaskContext.get().partitionId() << 40)
        for batch in small_batches(batches):
            for part in small_batches([batch], CUT_AT_ONCE):
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), encoder.ids(texts(part))):
                    packer.add(doc_id, ids + end)
            yield packer.take()
        packer.close()
        yield packer.take()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)
