"""Quality rules by tokenizer fertility.

Base rules count words, repeated three-word windows, repeated lines and symbols.  What passes them is judged by a public
vocabulary with byte fallback: characters per token, share of byte-fallback tokens, and token entropy in bits.  Each
language, or script where the language is unknown, has its own rejection bands around the median of all its distinct passing
texts of like length: entropy grows with length, so lengths are taken by powers of two.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridclear.llm.common import WHITE, map_batches, resident, written
from gridclear.llm.tokenizer_files import BEYOND_LATIN

#: Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50

#: Letters of each script (fixed ranges of Unicode); the script of a text is that of most of its letters.
SCRIPTS = {
    "Latin": "A-Za-zªºÀ-ÖØ-öø-ɏ",
    "Greek": "Ͱ-Ͽ",
    "Cyrillic": "Ѐ-ԯ",
    "Hebrew": "א-ת",
    "Arabic": "ؠ-ي",
    "Devanagari": "ऀ-ॿ",
    "Kana": "ぁ-ヿ",
    "Han": "一-鿿",
    "Hangul": "가-힣",
}
SCRIPT_PATTERNS = {name: re.compile(f"[{ranges}]") for name, ranges in SCRIPTS.items()}
PLAIN_WORD = re.compile("[!-~¡-¬®-ɏ]+")
MEMO = 1 << 17  # words of a generation whose pieces a worker keeps: two of them take about 50 MB

MEASURES = ["chars_per_token", "byte_share", "entropy_bits"]


@dataclass(frozen=True)
class Bands:
    """How far from its group's median a measure may lie: so many interquartile ranges, each taken as ``least`` and as the typical one at least."""

    ranges: tuple[float, float, float] = (5.0, 5.0, 3.0)
    least: tuple[float, float, float] = (0.05, 0.02, 0.05)
    min_documents: int = 30  # groups of fewer distinct texts have no bands of their own


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window that occurs twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    first: dict[tuple, int] = {}
    covered = bytearray(len(words))
    for i, window in enumerate(windows):
        j = first.setdefault(window, i)
        if j != i:
            covered[i : i + 3] = b"\1\1\1"
            covered[j : j + 3] = b"\1\1\1"
    return sum(covered)


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def script_of(text: str) -> str:
    if not BEYOND_LATIN.search(text):
        return "Latin"
    counts = {name: len(p.findall(text)) for name, p in SCRIPT_PATTERNS.items()}
    best = max(counts, key=counts.get)
    return best if counts[best] else "other"


class Fertility:
    """Measures of a text's words under a vocabulary with byte fallback."""

    def __init__(self, file: str, memo: int = MEMO):
        self.memo = memo
        self.model = sentencepiece.SentencePieceProcessor(model_file=file)
        self.byte_ids = np.array([self.model.is_byte(i) for i in range(self.model.get_piece_size())])
        self.begins = np.array([self.model.id_to_piece(i).startswith("\u2581") for i in range(self.model.get_piece_size())])
        self.kind = "<u2" if len(self.byte_ids) < 1 << 16 else "<u4"
        # When the younger generation is full it becomes the older, whose words come back when they are met.
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def ids(self, words: list[bytes]) -> np.ndarray:
        if len(self.young) >= self.memo:
            self.old, self.young = self.young, {}
        found = list(map(self.young.get, words))
        holes = [i for i, f in enumerate(found) if f is None]
        if holes:
            self.learn({words[i] for i in holes})
            for i in holes:
                found[i] = self.young[words[i]]
        return np.frombuffer(b"".join(found), self.kind)

    def learn(self, words: set[bytes]) -> None:
        plain, other = [], []
        for word in words:
            known = self.old.get(word)
            if known is None:
                text = word.decode()
                (plain if PLAIN_WORD.fullmatch(text) else other).append(text)
            else:
                self.young[word] = known
        for some, ids in ((plain, self.together(plain)), (other, self.alone(other))):
            self.young.update(zip(map(str.encode, some), ids))

    def alone(self, words: list[str]) -> list[bytes]:
        return [np.array(i, self.kind).tobytes() for i in self.model.encode(words, num_threads=1)]

    def together(self, words: list[str]) -> list[bytes]:
        """Ids of words of plain characters, from one text of them all: each begins with a piece that marks a beginning.

        Normalising can cut a word in two, never join two; the pieces would then be more than the words.
        """
        ids = np.array(self.model.encode(" ".join(words)), self.kind)
        starts = np.flatnonzero(self.begins[ids]) if len(ids) else ids
        if len(starts) == len(words) and len(words):
            data, bounds = ids.tobytes(), [*(starts * ids.itemsize).tolist(), len(ids) * ids.itemsize]
            return [data[a:b] for a, b in zip(bounds, bounds[1:])]
        return self.alone(words)

    def measures(self, words: list[bytes], chars: int) -> tuple[float, float, float, int]:
        ids = self.ids(words)
        n = len(ids)
        if n < 2:
            return float(chars), 0.0, 0.0, n
        counts = np.bincount(ids)
        bytes_used = counts[self.byte_ids[: len(counts)]].sum()
        counts = counts[counts > 0].astype(float)
        entropy = math.log2(n) - (counts * np.log2(counts)).sum() / n
        return chars / n, float(bytes_used / n), float(entropy), n


def fertility_of(file: str, memo: int) -> Fertility:
    """One instance per worker process."""
    return resident(("fertility", file, memo), lambda: Fertility(file, memo))


COLUMNS = [
    ("doc_id", pa.int64()), ("text_key", pa.int64()), ("lang", pa.string()), ("script", pa.string()),
    ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
    ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("chars_per_token", pa.float64()),
    ("byte_share", pa.float64()), ("entropy_bits", pa.float64()), ("n_tokens", pa.int64()),
]


def text_key(text: Column) -> Column:
    return F.xxhash64(text, F.length(text))


def measure(docs: DataFrame, file: str, memo: int = MEMO) -> DataFrame:
    """Base counts and fertility measures of each row of ``docs`` (doc_id, text, lang)."""
    names = [n for n, _ in COLUMNS]

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = fertility_of(file, memo)
        out: list[tuple] = []
        for doc_id, key, lang, value in zip(*(batch.column(c) for c in ("doc_id", "text_key", "lang", "text"))):
            text = value.as_py() or ""
            data = text.encode()
            words = data.split()
            n_words = len(words)
            chars = len(text) - sum(map(text.count, WHITE))
            repeated = repeated_words(words)
            failed = n_words < MIN_WORDS or 100 * repeated > MAX_REPEATED_PERCENT * n_words
            symbols = len(data) - len(data.translate(None, SYMBOLS))
            out.append(
                (doc_id.as_py(), key.as_py(), lang.as_py(), script_of(text), n_words, chars, symbols, repeated_lines(data), repeated, failed)
                + model.measures(words, chars)
            )
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(zip(*out), COLUMNS)], names=names)

    types = {pa.int64(): "long", pa.string(): "string", pa.bool_(): "boolean", pa.float64(): "double"}
    chosen = docs.select(
        F.col("doc_id").cast("long"), text_key(F.col("text")).alias("text_key"), F.col("lang").cast("string"), F.col("text").cast("string")
    )
    return map_batches(chosen, rows, ", ".join(f"{n} {types[k]}" for n, k in COLUMNS))


#: Where a document's bands come from, first choice first; entropy is only compared at like length.
LEVELS = [("group", "octave"), ("group",), ("octave",), ()]


def band_table(measured: DataFrame, bands: Bands) -> DataFrame:
    """Lower and upper bound of each measure by group and length; a null ``group`` or ``octave`` stands for all.

    Quartiles are mergeable sketches over the distinct texts that pass the base rules, so copies count once.  Near copies are
    distinct and can still make up most of a cell; so no range is taken as less than the typical one (see ``typical_ranges``).
    """
    passing = measured.filter(~F.col("base_failed")).select("text_key", group_of().alias("group"), octave(), *MEASURES).distinct()
    keys = [F.struct(*((F.col(c) if c in level else F.lit(None)).alias(c) for c in ("group", "octave"))) for level in LEVELS]
    quartiles = passing.select(F.explode(F.array(*keys)).alias("key"), *MEASURES).groupBy("key.group", "key.octave").agg(
        F.count("*").alias("documents"), *(F.percentile_approx(m, [0.25, 0.5, 0.75], 10_000).alias(m) for m in MEASURES)
    )
    cells = typical_ranges(written(quartiles.filter(F.col("documents") >= bands.min_documents), "quartiles"))
    columns = []
    for m, ranges, least in zip(MEASURES, bands.ranges, bands.least):
        spread = ranges * F.greatest(F.col(m)[2] - F.col(m)[0], F.col(f"{m}_typical"), F.lit(least))
        columns += [(F.col(m)[1] - spread).alias(f"{m}_low"), (F.col(m)[1] + spread).alias(f"{m}_high")]
    return cells.select("group", "octave", *columns)


def typical_ranges(cells: DataFrame) -> DataFrame:
    """``cells`` with the median, the upper one of an even number, of each measure's interquartile ranges over all groups at like length.

    A length that fewer than two groups have takes that of all cells by group and length; it is null if there are none.
    """

    def medians(suffix: str) -> list[Column]:
        return [(-F.percentile_approx(F.col(m)[0] - F.col(m)[2], 0.5, 10_000)).alias(m + suffix) for m in MEASURES]

    groups = cells.filter("group IS NOT NULL")
    alike = groups.groupBy(F.col("octave").alias("like_octave")).agg(F.count("*").alias("groups"), *medians("_alike"))
    overall = groups.filter("octave IS NOT NULL").agg(*medians("_overall"))
    joined = cells.join(F.broadcast(alike), F.col("octave").eqNullSafe(F.col("like_octave")), "left").crossJoin(F.broadcast(overall))
    found = {f"{m}_typical": F.when(F.col("groups") > 1, F.col(f"{m}_alike")).otherwise(F.col(f"{m}_overall")) for m in MEASURES}
    return joined.withColumns(found).select(*cells.columns, *found)


def group_of() -> Column:
    return F.coalesce(F.col("lang"), F.col("script"))


def octave() -> Column:
    return F.floor(F.log2(F.greatest(F.col("n_tokens"), F.lit(1)))).alias("octave")


def judge(measured: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """``measured`` with ``kept`` and ``reason`` (null when kept)."""
    table = written(band_table(measured, bands), "bands")
    joined = measured.withColumns({"group": group_of(), "octave": octave()})
    bounds = [c for c in table.columns if c not in ("group", "octave")]
    for k, level in enumerate(LEVELS):
        same = F.lit(True)
        for c in ("group", "octave"):
            same = same & (F.col(c).isNotNull() if c in level else F.col(c).isNull())
        side = table.filter(same).select(*level, *(F.col(c).alias(f"{c}_{k}") for c in bounds))
        if level:
            joined = joined.join(side, list(level), "left")
        else:
            overall = side.head()
            joined = joined.withColumns({f"{c}_{k}": F.lit(overall[f"{c}_{k}"] if overall else None).cast("double") for c in bounds})
    reason = F.when(F.col("base_failed"), "base")
    for m in MEASURES:
        levels = [k for k, level in enumerate(LEVELS) if m != "entropy_bits" or "octave" in level]
        low, high = (F.coalesce(*(F.col(f"{m}_{side}_{k}") for k in levels)) for side in ("low", "high"))
        reason = reason.when(F.col(m) < low, f"{m} low").when(F.col(m) > high, f"{m} high")
    return joined.withColumn("reason", reason).withColumn("kept", F.col("reason").isNull()).select(*measured.columns, "kept", "reason")


def quality_rules(docs: DataFrame, file: str, bands: Bands = Bands(), memo: int = MEMO) -> DataFrame:
    """Base counts, fertility measures and verdict of each row of ``docs`` (doc_id, text, lang; other columns are ignored).

    A null or empty text has no words and fails the base rules.  A null language is judged by the text's script; groups too
    small for bands of their own by those of more documents (see ``LEVELS``), and by none if these are few too.  Rows with equal ids are judged each for itself;
    null ids stay null; an empty table gives no rows.  ``memo`` trades a worker's memory for time.
    """
    return judge(written(measure(docs, file, memo), "fertility"), bands)
