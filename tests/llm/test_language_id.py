import random

import numpy as np
from helpers import empty, frame, odd_texts

from gridclear.llm import language_id as li


def numeric_gradient(network, codes, used, labels, weight, k, at):
    def loss():
        p, _, _ = network.position_probabilities(codes)
        mask = (np.arange(li.WINDOW)[:, None] < used) * weight
        return -(np.log(p[:, labels, np.arange(codes.shape[1])]) * mask).sum() / mask.sum()

    step = 1e-2
    network.arrays[k][at] += step
    above = loss()
    network.arrays[k][at] -= 2 * step
    below = loss()
    network.arrays[k][at] += step
    return (above - below) / (2 * step)


def test_backpropagation_through_time():
    rng = np.random.default_rng(1)
    network = li.Network.random(["a", "b", "c"], 5, rng)
    rows, used, _ = li.windows_of([rng.integers(97, 110, n).astype(np.uint8).tobytes() for n in (64, 30, 7, 64)])
    codes = rows.T.astype(np.intp)
    labels, weight = np.array([0, 1, 2, 1]), np.array([1.0, 2.0, 0.5, 1.0])
    gradients = network.gradients(codes, used, labels, weight)
    for k, array in enumerate(network.arrays):
        assert gradients[k].shape == array.shape
        for _ in range(8):
            at = tuple(rng.integers(0, n) for n in array.shape)
            if k in (0, 2):
                at = (int(codes[3, rng.integers(0, 4)]), at[1])
            assert abs(numeric_gradient(network, codes, used, labels, weight, k, at) - gradients[k][at]) < 2e-3


def test_windows_cover_whole_texts():
    texts = [b"", b"a" * 64, b"b" * 65, b"", b"c" * 1000]
    rows, used, first = li.windows_of(texts)
    assert used.sum() == sum(map(len, texts)) and rows.any(axis=1).all()
    network = li.Network.random(["x", "y"], 4, np.random.default_rng(2))
    p = network.probabilities(texts)
    assert np.allclose(p.sum(axis=1), [0, 1, 1, 0, 1])
    for text, row in zip(texts, p):
        assert np.allclose(network.probabilities([text])[0], row, atol=1e-5)
    stored = li.Network.from_bytes(network.to_bytes())
    assert stored.languages == ["x", "y"] and np.array_equal(stored.probabilities(texts), p)


def test_position_labels_read_both_directions():
    network = li.Network.random(["x", "y"], 4, np.random.default_rng(3))
    codes = np.full((li.WINDOW, 3), 97)
    codes[8, 1] = codes[12, 2] = 98
    p, _, _ = network.position_probabilities(codes)
    assert abs(p[10, 0, 0] - p[10, 0, 1]) > 1e-4 and abs(p[10, 0, 0] - p[10, 0, 2]) > 1e-4


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    langs = {r.doc_id: (r.lang, r.n_chars) for r in docs.select("doc_id", "lang", "n_chars").collect()}
    got = li.identify(docs).collect()
    assert len(got) == len(langs) and all(0 <= r.score <= 1 for r in got)
    apart = [r for r in got if r.held_out and langs[r.doc_id][1] > 40]
    assert len(apart) > 20 and sum(r.lang_pred == langs[r.doc_id][0] for r in apart) >= 0.95 * len(apart)


def test_labels_of_held_out_rows_and_other_columns_do_not_matter(spark, sf_dir):
    how = li.Training(steps=5)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = li.fit(docs, how)
    from pyspark.sql import functions as F

    changed = docs.withColumn("lang", F.when(li.held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    after = li.fit(changed.repartition(3), how)
    assert before.languages == after.languages and all(np.array_equal(a, b) for a, b in zip(before.arrays, after.arrays))


def test_odd_rows(spark):
    rng = random.Random(4)
    texts = odd_texts() + ["1234 %%", "the " * 50, "und " * 50] + [" ".join(rng.choices(["the", "of"], k=30)) for _ in range(40)]
    langs = [None] * (len(texts) - 40) + ["en", "de"] * 20
    ids = [None, 1, 1, *range(10, 7 + len(texts))]
    got = li.identify(frame(spark, texts, ids, langs, clashing=True), li.Training(steps=3)).collect()
    assert len(got) == len(texts)
    by_id = {r.doc_id: r for r in got}
    for i, t in zip(ids[3:], texts[3:]):
        assert (by_id[i].lang_pred == "und") == (not any(c.isalpha() for c in t))
        assert 0 <= by_id[i].score <= 1
    assert by_id[None].held_out and by_id[None].lang_pred == "und" and by_id[None].score == 0
    assert {r.lang_pred for r in li.identify(frame(spark, texts)).collect()} == {"und"}
    assert li.identify(empty(spark)).count() == 0
