"""Sets of hashed word shingles, computed for many texts at once."""

from __future__ import annotations

import numpy as np
import xxhash

#: Shingle hashes have this many bits: in a pair of sets of a thousand shingles each, a false match has
#: a probability below 1e-8.
HASH_BITS = 48
SLICE = 1 << 18  # bytes of text hashed in one go

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_powers: dict[int, np.ndarray] = {}

WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint64)
LOWER[65:91] += 32
LOWER += 1


def powers(base: int, n: int) -> np.ndarray:
    found = _powers.get(base)
    if found is None or len(found) < n:
        found = np.full(max(n, SLICE + 1), base, np.uint64)
        found[0] = 1
        found = _powers[base] = np.cumprod(found)
    return found


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(32)
    return h


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word, A-Z lower-cased."""
    codes = np.frombuffer(data, np.uint8)
    white = WHITE[codes]
    edges = np.flatnonzero(np.diff(white, prepend=True, append=True))
    starts, ends = edges[::2], edges[1::2]
    sums = np.cumsum(LOWER[codes] * powers(_BASE, len(codes))[: len(codes)])
    totals = sums[ends - 1] - np.where(starts > 0, sums[starts - 1], np.uint64(0))
    return mixed(totals * powers(_INVERSE, len(codes))[starts]), starts


def long_word_hashes(data: bytes) -> np.ndarray:
    """Word hashes of a text of any length, a slice at a time; slices end at white space."""
    found, start = [], 0
    while start < len(data):
        end = min(start + SLICE, len(data))
        while end < len(data) and not WHITE[data[end]]:
            end += 1
        found.append(word_hashes(data[start:end])[0])
        start = end
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def combined(words: np.ndarray, size: int) -> np.ndarray:
    """One hash per run of ``size`` words."""
    runs = len(words) - size + 1
    h = words[:runs].copy()
    for k in range(1, size):
        h *= _STEP
        h += words[k : k + runs]
    return mixed(h) >> np.uint64(64 - HASH_BITS)


def shingle_sets(texts: list[str], size: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingles of each text: runs of ``size`` words, or all its words if it has fewer."""
    out: list[np.ndarray] = []
    data = [t.encode() for t in texts]
    k = 0
    while k < len(data):
        first, total = k, 0
        while k < len(data) and (k == first or total + len(data[k]) < SLICE):
            total += len(data[k]) + 1
            k += 1
        group = data[first:k]
        if len(group) == 1:
            words = long_word_hashes(group[0])
            bounds = np.array([0, len(words)])
        else:
            words, starts = word_hashes(b"\n".join(group))
            at = np.cumsum([0] + [len(d) + 1 for d in group])
            bounds = np.searchsorted(starts, at)
        runs = combined(words, size) if len(words) >= size else words
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if b - a >= size:
                out.append(np.unique(runs[a : b - size + 1]))
            else:
                out.append(combined(words[a:b], b - a) if b > a else np.zeros(0, np.uint64))
    return out


def digest(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that tell different sets apart, as two signed numbers."""
    value = xxhash.xxh3_128_digest(shingles.tobytes())
    return int.from_bytes(value[:8], "little", signed=True), int.from_bytes(value[8:], "little", signed=True)


def packed(shingles: np.ndarray) -> bytes:
    """A set as six bytes per shingle."""
    return shingles.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    rows = np.zeros((len(data) // 6, 8), np.uint8)
    rows[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return rows.view("<u8").ravel()


def bit_row(shingles: np.ndarray) -> bytes:
    """A row of bits, two to four per shingle (a power of two, 256 at least), in which each shingle sets one."""
    n_bits = max(256, 1 << (2 * len(shingles) - 1).bit_length())
    bits = np.zeros(n_bits, bool)
    bits[(shingles & np.uint64(n_bits - 1)).astype(np.intp)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def folded(row: np.ndarray, n_bytes: int) -> np.ndarray:
    """A row of bits (as bytes) shortened to ``n_bytes``: what the same set has in a row of that length."""
    return np.bitwise_or.reduce(row.reshape(-1, n_bytes), axis=0)


def missing_bits(query: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bits of ``query`` that each row of ``others`` lacks, and the reverse.

    That many shingles of the one set at least are not in the other.
    """
    n = min(len(query), others.shape[1])
    query = folded(query, n)
    others = np.bitwise_or.reduce(others.reshape(len(others), -1, n), axis=1)
    return np.bitwise_count(query & ~others).sum(axis=1, dtype=np.int64), np.bitwise_count(others & ~query).sum(axis=1, dtype=np.int64)


def needed(n: int, percent: int) -> int:
    """The fewest shingles that a set must share with any other one of at least that likeness."""
    return -(-percent * n // 100)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)
