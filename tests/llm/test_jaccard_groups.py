import random

import numpy as np
import pytest
from helpers import empty, frame, sentence, words_of

from gridclear.llm import jaccard_groups as jg
from gridclear.llm import shingles as sh


def brute_set(text, size=5):
    words = ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in words_of(text)]
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute_components(ids, texts, percent=80):
    sets = [brute_set(t) for t in texts]
    parent = list(range(len(ids)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(ids)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    groups = {}
    for k in range(len(ids)):
        groups.setdefault(root(k), []).append(ids[k])
    least = {g: min((i for i in members if i is not None), default=None) for g, members in groups.items()}
    return [(ids[k], len(sets[k]), least[root(k)] if sets[k] else ids[k]) for k in range(len(ids))]


def corpus(rng):
    passage = sentence(rng, 40)
    texts = [None, "", " \n", "a", "A", "a b c d", "A B C D", "a b c d e", "x " * 300, "x " * 500, "Éa éa", "éa éa"]
    for _ in range(12):
        base = sentence(rng, rng.choice([8, 30, 60, 200])).split()
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 9)):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 4])):
                copy[rng.randrange(len(copy))] = f"new{rng.random()}"
            if rng.random() < 0.3:
                copy = copy[rng.randint(0, 3) :]
            texts.append(" ".join(copy).upper() if rng.random() < 0.2 else " ".join(copy))
    for _ in range(25):  # a passage that many documents share, in documents that are otherwise different
        texts.append(sentence(rng, rng.randint(2, 60)) + "\n" + passage)
    return texts


def compare(got, want):
    order = lambda r: tuple((v is None, v or 0) for v in r)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=order) == sorted(want, key=order)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_all_pairs(spark, monkeypatch, seed):
    rng = random.Random(seed)
    texts = corpus(rng)
    ids = [None, None, None, *range(1000, 997 + len(texts))]
    rng.shuffle(ids)
    if seed == 2:  # every shingle that occurs twice comes last; parts of two; several blocks
        monkeypatch.setattr(jg, "FREQUENT", 2)
        monkeypatch.setattr(jg, "PART", 2)
        monkeypatch.setattr(jg, "BLOCK", 2000)
    if seed == 3:  # the matrix alone finds all links
        monkeypatch.setattr(jg, "ROUNDS", 0)
    docs = frame(spark, texts, ids, clashing=True).repartition(3)
    compare(jg.similar_documents(docs).collect(), brute_components(ids, texts))


def test_the_bound_is_met_exactly(spark):
    words = [f"w{k}" for k in range(104)]
    same = " ".join(words)  # 100 shingles
    texts = [same, " ".join(words[:84]), " ".join(words[:83]), " ".join(words[1:] + ["z"])]
    got = {r.doc_id: r.component_id for r in jg.similar_documents(frame(spark, texts)).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 0}  # 80 of 100 link; 79 does, through the one of 80
    got = {r.doc_id: r.component_id for r in jg.similar_documents(frame(spark, [same, texts[2]])).collect()}
    assert got == {0: 0, 1: 1}


def test_many_copies_and_nothing(spark):
    texts = ["one two three four five six"] * 300 + ["unlike any other text at all"]
    got = jg.similar_documents(frame(spark, texts, [7] * 300 + [8]).repartition(4)).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(7, 7), (8, 8)} and len(got) == 301
    assert jg.similar_documents(empty(spark)).count() == 0


def test_shingles_of_any_text():
    rng = random.Random(4)
    texts = ["".join(rng.choice("aAbB é \n\t\x0b\x1c\xa0") for _ in range(rng.randint(0, 60))) for _ in range(500)]
    texts.append(" ".join(f"w{rng.randint(0, 10**6)}" for _ in range(400_000)))  # longer than a slice
    texts.append("x" * (1 << 21) + " y")
    for size in (1, 3, 5):
        sets = sh.shingle_sets(texts, size)
        assert [len(s) for s in sets] == [len(brute_set(t, size)) for t in texts]
    for _ in range(300):
        i, j = rng.randrange(500), rng.randrange(500)
        x, y = brute_set(texts[i]), brute_set(texts[j])
        assert len(np.intersect1d(sets[i], sets[j])) == len(x & y)
        assert (sh.unpacked(sh.packed(sets[i])) == sets[i]).all()
        if x and y:
            rows = [np.frombuffer(sh.bit_row(s), np.uint8) for s in (sets[i], sets[j])]
            lacks, reverse = sh.missing_bits(rows[0], rows[1][None])
            assert lacks[0] <= len(x - y) and reverse[0] <= len(y - x)


def test_prefix_shingles_are_dealt_out_once(spark, tmp_path):
    """Counting a shingle's rows and looking them up take one shuffle of them."""
    rows = [(i, [i % 3, 100 + i], [7] if i else []) for i in range(6)] + [(6, [1000], None)]
    spark.createDataFrame(rows, "row long, rare array<long>, frequent array<long>").write.parquet(f"{tmp_path}/described")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        met = jg.meetings(spark.read.parquet(f"{tmp_path}/described"))
        plan = met._jdf.queryExecution().executedPlan().toString()
        found = sorted((r.token, r.row) for r in met.collect())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert found == sorted([(i % 3, i) for i in range(6)] + [(7, i) for i in range(1, 6)])
    dealt = [line for line in plan.splitlines() if "REPARTITION_BY_COL" in line]
    assert len([line for line in dealt if "ReusedExchange" not in line]) == 1 and len(dealt) == 2, plan
