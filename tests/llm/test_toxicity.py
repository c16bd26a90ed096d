import random
import zlib

import numpy as np
import pytest
from helpers import empty, frame, odd_texts, sentence

from gridclear.llm import toxicity as tx

HOW = tx.Training(sample=200, bits=16, features=512)
LABELS = "doc_id long, toxic int"


def brute_cells(text, how):
    """Distinct n-grams by slicing, hashed one at a time."""
    text, found, mask = tx.normal(text), set(), (1 << 64) - 1
    for n in how.lengths:
        for i in range(len(text) - n + 1):
            h = 0
            for c in text[i : i + n]:
                h = (h * 0x9E3779B97F4A7C15 + ord(c)) & mask
            h = ((h ^ n) * 0xD6E8FEB86659FD93) & mask
            found.add(h >> (64 - how.bits))
    return found


@pytest.mark.parametrize("piece", [7, 64, 1 << 17])
def test_presence_agrees_with_slices_whatever_the_pieces(piece, monkeypatch):
    monkeypatch.setattr(tx, "PIECE", piece)
    given = [t or "" for t in odd_texts()] + [sentence(random.Random(3), 60), "\ud800 lone"]
    owner, cell = tx.presence(given, HOW)
    for i, text in enumerate(given):
        assert set(cell[owner == i].tolist()) == brute_cells(text, HOW)
    assert len(set(zip(owner.tolist(), cell.tolist()))) == len(owner)


def test_gradient_descends_to_the_least_loss():
    rng = np.random.default_rng(1)
    rows, columns = np.nonzero(rng.random((60, 8)) < 0.4)
    labels, ratios = (rng.random(60) < 0.4).astype(float), rng.normal(size=8)
    how = tx.Training(steps=4000, penalty=0.6)
    scaled, bias = tx.descend(rows, columns, labels, ratios, how)
    x = np.zeros((60, 8))
    x[rows, columns] = 1

    def loss(w, b):
        z = x @ w + b
        return np.mean(np.log1p(np.exp(z)) - labels * z) + how.penalty / 60 / 2 * np.sum((w / ratios) ** 2)

    least = loss(scaled, bias)
    for _ in range(200):
        assert loss(scaled + rng.normal(size=8) * 0.05 * ratios, bias + rng.normal() * 0.05) >= least - 1e-6


def corpus(spark, n=1200):
    rng, given, labels = random.Random(8), [], []
    for i in range(n):
        words = sentence(rng, rng.randint(5, 120)).split()
        bad = rng.random() < 0.15
        if bad:
            for _ in range(rng.randint(1, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(["idiot", "scum", "moron"]))
        given.append(" ".join(words))
        labels.append((i, int(bad)))
    return frame(spark, given), spark.createDataFrame(labels, LABELS), given, dict(labels)


def test_held_out_documents_are_told_apart(spark):
    docs, labels, _, truth = corpus(spark)
    rows = tx.rate(docs, labels, HOW).collect()
    assert len(rows) == len(truth)
    apart = [r for r in rows if r.held_out]
    assert {r.doc_id for r in apart} == {i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2}
    toxic, clean = [r.predicted for r in apart if truth[r.doc_id]], [r.predicted for r in apart if not truth[r.doc_id]]
    assert sum(toxic) >= 0.95 * len(toxic) and sum(clean) <= 0.02 * len(clean)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_labels_of_held_out_documents_are_not_learned(spark):
    docs, labels, _, truth = corpus(spark, 300)
    turned = spark.createDataFrame([(i, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, t in truth.items()], LABELS)
    first = sorted((r.doc_id, r.score) for r in tx.rate(docs, labels, HOW).collect())
    assert first == sorted((r.doc_id, r.score) for r in tx.rate(docs.repartition(3), turned, HOW).collect())


def test_ratios_are_those_of_the_documents(spark):
    _, _, given, truth = corpus(spark, 200)
    sample = spark.createDataFrame([(given[i], truth[i]) for i in truth], "text string, toxic int").repartition(3)
    got = {r.cell: (r.toxic, r.clean) for r in tx.cell_counts(sample, HOW).collect()}
    want = {}
    for i, label in truth.items():
        for cell in brute_cells(given[i], HOW):
            held = want.setdefault(cell, [0, 0])
            held[1 - label] += 1
    assert got == {c: tuple(v) for c, v in want.items()}


def test_odd_rows(spark):
    docs, labels, given, _ = corpus(spark, 300)
    model = tx.fit(docs, labels, HOW)
    odd = odd_texts()
    rows = tx.score(frame(spark, odd, ids=[None, *range(1, len(odd))], clashing=True), model).collect()
    assert len(rows) == len(odd) and [r.held_out for r in rows if r.doc_id is None] == [True]
    by_text = {}
    for r in rows:
        by_text.setdefault(odd[r.doc_id or 0] or "", set()).add(r.score)
    assert all(len(s) == 1 for s in by_text.values())
    assert tx.score(empty(spark), model).count() == 0
    long_text = " ".join(given) * 40 + " scum idiot moron"
    assert tx.score(frame(spark, [long_text]), model).head().score == pytest.approx(float(model.scores([long_text])[0]))


def test_without_labels_of_both_kinds(spark):
    docs, _, _, _ = corpus(spark, 40)
    one_kind = spark.createDataFrame([(i, 0) for i in range(40)] + [(None, 1), (5, None)], LABELS)
    assert {r.predicted for r in tx.rate(docs, one_kind, HOW).collect()} == {0}
    assert {r.predicted for r in tx.rate(docs, one_kind.filter("toxic > 1"), HOW).collect()} == {0}
    assert tx.rate(empty(spark), one_kind, HOW).count() == 0
    twice = spark.createDataFrame([(i, t) for i in range(40) for t in (0, i % 2)], LABELS)
    assert tx.rate(docs.unionAll(docs), twice, HOW).count() == 80
