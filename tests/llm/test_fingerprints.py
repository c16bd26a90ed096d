import hashlib
import random
from itertools import combinations

from helpers import empty, frame, odd_texts, sentence

from gridclear.llm import fingerprints as fp


def brute_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        above = row[:]
        for j, y in enumerate(b):
            row[j + 1] = above[j] + 1 if x == y else max(above[j + 1], row[j])
    return row[-1]


def test_edit_distance_is_exact():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 70))] for _ in range(2))
        assert fp.common_length(a, b) == brute_common(a, b)


def test_boundaries_depend_on_the_last_bytes_only(monkeypatch):
    data = random.Random(2).randbytes(5000)
    for bits in (2, 4):
        whole = set(fp.boundaries(data, bits)[0].tolist())
        moved = {int(e) - 100 for e in fp.boundaries(b"x" * 100 + data, bits)[0]}
        assert {e for e in whole if e > 8} <= moved
        assert set(fp.boundaries(data, bits + 1)[0].tolist()) <= whole
        monkeypatch.setattr(fp, "SLICE", 64)
        assert set(fp.boundaries(data, bits)[0].tolist()) == whole
        monkeypatch.undo()


def test_likeness():
    rng = random.Random(3)
    texts = [sentence(rng, n) for n in (5, 40, 400, 4000)]
    for text in texts:
        print_ = fp.fingerprint(text)
        assert fp.likeness(print_, fp.fingerprint(text)) == 1.0
        near = text[: len(text) // 2] + "changed" + text[len(text) // 2 :]
        assert fp.likeness(print_, fp.fingerprint(near)) > (0.3 if len(text) < 60 else 0.8)
        assert fp.likeness(print_, "") == 0.0
    for a, b in combinations(texts, 2):
        assert fp.likeness(fp.fingerprint(a), fp.fingerprint(b)) < 0.3
    assert fp.likeness("", "") == 1.0
    for repeated in ("a" * 100_000, "ab" * 50_000, "\n" * 3):
        assert len(fp.fingerprint(repeated)) < 600


def expected(rows):
    """Brute force: the documents in descending order, ties by text, null ids last, each followed by the next, cyclically."""
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), (r[1] or "").encode()))
    out = []
    for (i, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1]):
        text, after = text or "", after or ""
        changed = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        a, b = fp.fingerprint(text), fp.fingerprint(changed)
        out.append((i, len(text), hashlib.sha256(changed.encode()).hexdigest(), a, b, fp.likeness(a, b), fp.likeness(a, fp.fingerprint(after))))
    return out


def key(row):
    return tuple((v is None, v or 0) if not isinstance(v, str) else v for v in row)


def test_neighbours_across_buckets(spark):
    rng = random.Random(4)
    texts = odd_texts() + [sentence(rng, rng.randint(1, 200)) for _ in range(60)]
    ids = [None, None, 5, 5, 5, -3, *rng.sample(range(1000), len(texts) - 6)]
    docs = frame(spark, texts, ids, clashing=True).repartition(5)
    for per_bucket in (1, 7, 1000):
        got = [tuple(r) for r in fp.fingerprint_neighbours(docs, per_bucket).collect()]
        assert sorted(got, key=key) == sorted(expected(list(zip(ids, texts))), key=key)


def test_one_and_none(spark):
    (only,) = fp.fingerprint_neighbours(frame(spark, ["alone in here"], [9])).collect()
    assert only.near_next == 1.0 and only.n_chars == 13
    assert fp.fingerprint_neighbours(empty(spark)).count() == 0


def test_half_replaced_is_told_from_another_document(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [r for r in fp.fingerprint_neighbours(docs).collect() if r.n_chars > 300]
    assert sum(r.near_edited > r.near_next for r in rows) > 0.95 * len(rows)
    assert sum(0.3 < r.near_edited < 0.9 for r in rows) > 0.95 * len(rows)
