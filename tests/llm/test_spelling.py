import collections
import random
import re
import zlib

import numpy as np
import pytest
from helpers import empty, frame, odd_texts, sentence
from hypothesis import given, settings
from hypothesis import strategies as st

from gridclear.llm import spelling as sp

WORDS = "word string, n long"


def near(a, b):
    """Exactly one inserted, deleted or replaced letter."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(words):
    out = {}
    for w, n in words.items():
        close = [v for v in words if near(w, v)]
        best = min(close, key=lambda v: (-words[v], v), default=None)
        form = best if best is not None and words[best] >= 10 * n else None
        out[w] = (form, n, len(close), words[form] if form else None)
    result = {}
    for w, (form, n, n_near, form_n) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        result[w] = (form, root, n, n_near, form_n)
    return result


def brute_words(rows):
    counts = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def family(rng, size, letters="ab", least=3, most=9):
    return {"".join(rng.choice(letters) for _ in range(rng.randint(least, most))): rng.choice([2, 3, 25, 400, 6000]) for _ in range(size)}


def got(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


@pytest.mark.parametrize("group", [4, sp.GROUP])
def test_variants_agree_with_all_pairs(spark, group):
    rng = random.Random(4)
    words = family(rng, 250) | family(rng, 60, "aé中", 1, 6) | family(rng, 20, "ab", 24, 40)
    long_word = "abcdefghijkl" * 20
    words |= {long_word: 9, long_word[:77] + "z" + long_word[77:]: 100, long_word[:-1]: 2, "x" + long_word[1:]: 5000}
    df = spark.createDataFrame(list(words.items()), WORDS)
    assert got(sp.variants(df, group=group)) == brute_variants(words)


@settings(max_examples=120, deadline=None)
@given(st.lists(st.text("abc", min_size=3, max_size=3), min_size=1, max_size=90, unique=True), st.lists(st.text("abc", min_size=4, max_size=4), max_size=90, unique=True))
def test_look_up_in_one_group(short, long):
    inner = short + long
    points = np.array(inner, "U4").view(np.uint32).reshape(len(inner), 4)
    codes = np.unique(points, return_inverse=True)[1].reshape(points.shape) + (points.min() != 0)
    longer = np.array([len(w) == 4 for w in inner])
    every = np.ones(len(inner), bool)
    a, b, more = sp.look_up(codes, np.zeros(len(inner), int), longer, every, ~longer, True)
    want = {(x, y) for x in short for y in inner if near(x, y)}
    assert sorted((inner[i], inner[j]) for i, j in zip(a, b)) == sorted(want)
    assert all(m == (len(inner[j]) == 4) for j, m in zip(b, more))


def test_pairs_come_once(spark):
    words = {"aaaaaaa": 2, "aaaaaaaa": 3, "aaaaaaaaa": 4, "aaabaaa": 2, "aabaaaa": 2}
    pairs = [(r.word, r.near) for r in sp.near_pairs(spark.createDataFrame(list(words.items()), WORDS)).collect()]
    assert sorted(pairs) == sorted((a, b) for a in words for b in words if near(a, b))


def test_chains_of_forms_reach_their_root(spark):
    words = {"wordwordw" + "x" * k: 10**k for k in range(18)}
    rows = got(sp.variants(spark.createDataFrame(list(words.items()), WORDS)))
    assert {r[1] for r in rows.values()} == {"wordwordw" + "x" * 17}


def test_words_of_texts(spark):
    rng = random.Random(5)
    vocabulary = ["Wanderung", "wanderung", "caféhaus", "ÀÉÖßÿ×÷abc", "naïvetésque", "the", "kitchen", "kitchens", "kitchem"]
    texts = [" ".join(rng.choice(vocabulary) + rng.choice([" ", "", "1", "_"]) for _ in range(40)) for _ in range(60)] + odd_texts()
    ids = [None, 3, 3, *range(3, len(texts))]
    df = frame(spark, texts, ids=ids, clashing=True)
    want = brute_words(zip(ids, texts))
    assert {r.word: r.n for r in sp.corpus_words(df).collect()} == want
    assert got(sp.spelling_variants(df)) == brute_variants(want)
    assert sp.spelling_variants(empty(spark)).count() == 0
    assert sp.spelling_variants(frame(spark, [None, "", "short words only"])).count() == 0


def test_a_group_with_most_words_is_split(spark):
    rng = random.Random(6)
    words = {f"common{a}{b}{c}tail": rng.choice([2, 40]) for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh"}
    df = spark.createDataFrame(list(words.items()), WORDS)
    cells = sp.dealt(sp.memberships(df), 64).groupBy(*sp.GROUP_KEY, "cell").count().agg({"count": "max"}).head()[0]
    assert cells < 256
    assert got(sp.variants(df, group=64)) == got(sp.variants(df))
    sample = sorted(words)[:40]
    rows = got(sp.variants(df, group=64))
    assert all(rows[w][3] == sum(near(w, v) for v in words) for w in sample)


def test_very_long_text(spark):
    text = sentence(random.Random(1), 3000, ["Gewitterwolke", "Gewitterwolken", "gewitterwolkes"]) + "q" * 200_000
    docs = frame(spark, [text, "q" * 200_000, "q" * 199_999])
    want = brute_words([(0, text), (1, "q" * 200_000), (2, "q" * 199_999)])
    assert got(sp.spelling_variants(docs)) == brute_variants(want)
