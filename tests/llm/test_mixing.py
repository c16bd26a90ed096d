import random
from collections import Counter, defaultdict

import pytest
from helpers import empty, frame, sentence, words_of

from gridclear.llm import mixing


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Repeatedly share what is left among the sources that are not full."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, full = share * sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in full)
        open_ = sum(weight[s] for s in order if s not in full)
        target = {s: most * sizes[s] if s in full else left * weight[s] / open_ for s in order}
        above = {s for s in order if s not in full and target[s] > most * sizes[s]}
        if not above:
            return target
        full |= above


def corpus(seed=1):
    rng = random.Random(seed)
    sources = ["b", "a", "é", "Z", "", None, "zz"]
    texts = [None, "", "\x1c\n", "one"] + [sentence(rng, rng.choice([1, 3, 20, 200])) for _ in range(120)]
    return texts, [rng.choices(sources, [9, 1, 1, 4, 2, 2, 1])[0] for _ in texts]


@pytest.mark.parametrize("share", [1.5, 0.4, 2.0])
def test_targets_and_budgets(spark, share):
    texts, sources = corpus()
    ids = [None, 3, 3, *range(10, 7 + len(texts))]
    mix = mixing.Mix(frame(spark, texts, ids, sources=sources, clashing=True).repartition(3), share=share)
    rows = mix.decisions().collect()
    sizes = defaultdict(int)
    for t, s in zip(texts, sources):
        sizes[s] += len(words_of(t))
    targets = brute_targets(sizes, share=share)
    want = Counter((i, len(words_of(t)), sizes[s], round(targets[s], 6)) for i, t, s in zip(ids, texts, sources))
    assert Counter((r.doc_id, r.size, r.source_size, round(r.target, 6)) for r in rows) == want
    taken = defaultdict(int)
    for r in rows:
        assert r.taken <= 2 * r.size
        taken[r.source_size, r.target] += r.taken
    assert all(target - 1 <= words <= target for (_, target), words in taken.items())


def test_complete_epochs_come_first_and_the_last_is_by_key(spark):
    texts = [sentence(random.Random(k), 10) for k in range(50)]
    docs = frame(spark, texts, sources=["a"] * 50)
    rows = mixing.Mix(docs).decisions().collect()
    assert {r.taken for r in rows} == {10, 20} and sum(r.taken for r in rows) == 750
    keys = {r.doc_id: r.key for r in mixing.keyed(docs, 0).collect()}
    assert {r.doc_id for r in rows if r.taken == 20} == set(sorted(keys, key=keys.get)[:25])
    again = mixing.Mix(docs.repartition(7)).decisions().collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, rows))
    other = mixing.Mix(docs, seed=1).decisions().collect()
    assert Counter(map(tuple, other)) != Counter(map(tuple, rows))


def test_weights_steer_the_selection(spark):
    texts = [sentence(random.Random(k), 10) + (" #" * 3 if k % 2 else " plain plain plain") for k in range(1000)]
    rows = mixing.Mix(frame(spark, texts, sources=["a"] * 1000), share=0.3).decisions().collect()
    taken = Counter(r.doc_id % 2 for r in rows if r.taken)
    assert taken[0] > 1.2 * taken[1] > 0


def test_documents_are_the_decisions(spark):
    texts, sources = corpus(2)
    mix = mixing.Mix(frame(spark, texts, sources=sources, clashing=True))
    got = mix.documents()
    assert got.columns == mix.docs.columns
    words = Counter()
    for r in got.collect():
        assert texts[r.doc_id].startswith(r.text) and r.n_chars == len(r.text) and r.source == sources[r.doc_id]
        words[r.doc_id] += len(words_of(r.text))
    assert words == Counter({r.doc_id: r.taken for r in mix.decisions().collect() if r.taken})


def test_nothing_to_mix(spark):
    assert mixing.Mix(empty(spark)).decisions().count() == 0
    assert mixing.Mix(empty(spark)).documents().count() == 0
    rows = mixing.Mix(frame(spark, [None, ""], sources=["a", None])).decisions().collect()
    assert [(r.size, r.target, r.taken) for r in rows] == [(0, 0.0, 0)] * 2


def test_many_sources_are_numbered_in_order(spark):
    texts = ["w " * 10] * 300
    sources = [f"s{k:04d}" for k in range(300)]
    rows = mixing.Mix(frame(spark, texts, sources=sources).repartition(8), share=0.5).decisions().collect()
    targets = brute_targets(dict.fromkeys(sources, 10), share=0.5)
    assert {r.doc_id: round(r.target, 9) for r in rows} == {k: round(targets[s], 9) for k, s in enumerate(sources)}
