"""Public tokenizers, used word by word.

A text is cut into pre-tokens by the tokenizer's own rule; each distinct pre-token is encoded by the library once per
worker or once per corpus.  For texts of the Latin blocks the rule is a regular expression of the standard library with
the character classes spelled out; any other text is cut by the library itself.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable

from gridclear.llm.common import resident

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Letters, numbers and white space among U+0000 to U+024F (fixed values of Unicode).
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
NUMBERS = "0-9²³¹¼-¾"
SPACES = "\t-\r \u0085 "
BEYOND_LATIN = re.compile("[^\u0000-ɏ]")

#: The splitting rules of the two files, in these classes (fixed by the files).
BYTE_LEVEL = re.compile(
    rf"'(?:s|t|re|ve|m|ll|d)| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{SPACES}{LETTERS}{NUMBERS}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
)
WORD_ENDS = re.compile(rf"'(?:s|t|re|ve|m|ll|d)|[{LETTERS}]+|[{NUMBERS}]|[^{SPACES}{LETTERS}{NUMBERS}]+")


def path(name: str) -> str:
    """The place of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


class PreTokens:
    """A tokenizer file as a splitter of texts and an encoder of pre-tokens."""

    def __init__(self, file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        with open(file, encoding="utf-8") as source:
            spec = json.load(source)
        added = spec["added_tokens"]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added):
            raise ValueError(f"{file}: added tokens that take their surroundings are not supported")
        self.special = {t["content"]: t["id"] for t in added}
        longest_first = sorted(map(re.escape, self.special), key=len, reverse=True)
        self.special_pattern = re.compile(f"({'|'.join(longest_first)})") if added else None
        self.lower = "Lowercase" in json.dumps(spec["normalizer"])
        if spec["pre_tokenizer"]["type"] == "ByteLevel" and spec["normalizer"] is None:
            self.latin: Callable[[str], list[str]] = BYTE_LEVEL.findall
        elif self.lower and '"invert": true' in json.dumps(spec["pre_tokenizer"]):
            self.latin = WORD_ENDS.findall
        else:
            raise ValueError(f"{file}: its splitting rule is not known here")

    def parts(self, text: str) -> list[str]:
        """Alternating plain segments and special strings, beginning with a plain one."""
        if self.special_pattern is None or "<|" not in text:
            return [text]
        return self.special_pattern.split(text)

    def split(self, segment: str) -> list[str]:
        """Pre-tokens of a plain segment; encoded one by one they give the segment's ids."""
        plain = segment.lower() if self.lower else segment
        if not BEYOND_LATIN.search(plain):
            return self.latin(plain)
        if self.tokenizer.normalizer is not None:
            segment = self.tokenizer.normalizer.normalize_str(segment)
        return [segment[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(segment)]

    def encode(self, pretokens: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(pretokens, add_special_tokens=False)]


def pretokens_of(file: str) -> PreTokens:
    """One instance per worker process."""
    return resident(("pretokens", file), lambda: PreTokens(file))
