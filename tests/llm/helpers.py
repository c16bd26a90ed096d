"""Small tables for the corpus operators."""

from __future__ import annotations

import random
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names clash with what operators add.
CLASHING = "doc_id long, text string, lang string, source string, n_chars long, n_tokens string, row string, size string, component string, score string, taken string"
WORDS = "the of and in to is was for that with licence paper water stone river light night garden window bread".split()


def words_of(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sentence(rng: random.Random, n: int, vocabulary: list[str] = WORDS) -> str:
    return " ".join(rng.choice(vocabulary) + str(rng.randint(0, 400)) for _ in range(n))


def odd_texts() -> list[str | None]:
    return [None, "", "   \n\t ", "a", "a b", "é ß ñ", "中文 字 ひらがな", "x" * 5000, "    a\x1cb", "same same", "same same", "😀 emoji 😀"]


def frame(spark, texts, ids=None, langs=None, sources=None, clashing=False):
    n = len(texts)
    ids = list(range(n)) if ids is None else ids
    rows = [
        (ids[i], texts[i], (langs or [None] * n)[i], (sources or [None] * n)[i], len(texts[i] or "")) for i in range(n)
    ]
    if clashing:
        return spark.createDataFrame([(*r, "x", "x", "x", "x", "x", "x") for r in rows], CLASHING)
    return spark.createDataFrame(rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)
