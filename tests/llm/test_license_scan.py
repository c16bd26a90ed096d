import math
import random

import pyarrow.parquet as pq
import pytest
from helpers import empty, frame, odd_texts, sentence

from gridclear.llm import license_scan as ls


@pytest.fixture(scope="module")
def model():
    rng = random.Random(1)
    return ls.fit([sentence(rng, 12) for _ in range(200)])


def family(model, text):
    words = ls.WORD.findall(text.lower())
    [(found, _)] = model.classify([words])
    return found, model.shared(words, found)


def test_templates_are_found_and_confirmed(model):
    for name, templates in ls.TEMPLATES.items():
        for text in templates:
            assert family(model, text) == (name, 1.0), text


def test_altered_notices_kept_apart(model):
    rng = random.Random(99)
    tried = right = 0
    for name, templates in ls.TEMPLATES.items():
        for text in templates:
            for _ in range(6):
                words = ls.altered(ls.WORD.findall(text.lower()), rng)
                tried += 1
                right += family(model, " ".join(words))[0] == name
    assert right > 0.85 * tried


def test_ordinary_text_is_unknown(model):
    rng = random.Random(2)
    ordinary = [*ls.ORDINARY, "The library lent her a copy of the book in March.", "A public notice on the road works was signed by the mayor."]
    ordinary += [sentence(rng, 30) for _ in range(100)]
    assert sum(family(model, t)[0] != ls.UNKNOWN for t in ordinary) <= 1


def test_calibration(model):
    assert 0.5 <= model.threshold <= 0.95 and model.temperature > 0
    [p] = model.probabilities([ls.WORD.findall("released under the mit license")])
    assert abs(p.sum() - 1) < 1e-6 and p.argmax() == model.families.index("MIT")


def test_scan(spark, model):
    long_line = sentence(random.Random(3), 100) + " Released under the MIT License. " + sentence(random.Random(4), 100)
    texts = odd_texts() + [
        "Story.\nLicensed under CC BY-NC 4.0.\nEnd\nReleased under the MIT License.", "LICENSED UNDER THE APACHE LICENSE, VERSION 2.0.", long_line,
        "They lost the licence plate.\n\n\nIt rained.", "Released under the MIT License.", "Released under the MIT License.",
    ]
    n = len(texts)
    ids = [None, 1, 1, *range(10, 7 + n)]
    got = ls.scan(frame(spark, texts, ids, clashing=True).repartition(3), model=model).collect()
    assert len(got) == n
    by_id = {r.doc_id: r for r in got}
    found = [by_id[i].families for i in ids[-6:]]
    assert found == [["CC-BY-NC", "MIT"], ["Apache"], ["MIT"], [], ["MIT"], ["MIT"]]
    assert [by_id[i].n_paragraphs for i in ids[-6:]] == [4, 1, 1, 2, 1, 1]
    assert all(not by_id[i].families for i in ids[:-6])
    assert by_id[None].n_paragraphs == 0 and by_id[None].findings == []
    finding = by_id[ids[-6]].findings[1]
    assert texts[-6][finding.start : finding.end] == "Released under the MIT License" and finding.confirmed
    assert ls.scan(empty(spark), model=model).count() == 0


def test_long_lines_are_read_whole():
    words = [f"w{k}" for k in range(500)]
    [line] = ls.paragraphs(" ".join(words))
    pieces = list(ls.pieces(line, 60))
    assert {w for *_, p in pieces for w in p} == set(words) and all(len(p) <= 60 for *_, p in pieces)
    assert ls.paragraphs("") == [] and len(ls.paragraphs("one two\n\nthree\na\nb c")) == 4


def test_places_where_small_letters_are_longer():
    text = "\u0130\u0130 Released under\nthe MIT License"
    assert [text[a:b] for line in ls.paragraphs(text) for a, b, _ in line] == ["Released", "under", "the", "MIT", "License"]


NOTICES = {"Released under the MIT License.": "MIT", "Licensed under CC BY-NC 4.0.": "CC-BY-NC", "Licensed under the Apache License, Version 2.0.": "Apache",
           "This work is licensed under the GNU General Public License, version 3.": "GPL", "All rights reserved.": "Proprietary"}


def prose(sf_dir, n):
    lines = []
    for text in pq.read_table(f"{sf_dir}/documents.parquet", columns=["text"])["text"].to_pylist():
        lines += [line for line in (text or "").split("\n") if 20 <= len(line.split()) <= 60 and not any(k in line for k in NOTICES)]
    return lines[:n]


def test_notices_inside_prose_and_over_line_ends(spark):
    lines = prose("/root/testdata/sf0.01", 240)
    learned, tried = lines[40:], lines[:40]
    model = ls.fit(learned)
    texts, want = [], []
    for notice, name in NOTICES.items():
        for line in tried:
            words, own = line.split(), notice.split()
            half = len(words) // 2
            texts.append(" ".join([*words[:half], notice, *words[half:]]))
            texts.append(" ".join([*words[:half], *own[: len(own) // 2]]) + "\n" + " ".join([*own[len(own) // 2 :], *words[half:]]))
            want += [name, name]
    got = {r.doc_id: r.families for r in ls.scan(frame(spark, texts), model=model).collect()}
    for name in NOTICES.values():
        for way in (0, 1):
            places = [i for i, w in enumerate(want) if w == name and i % 2 == way]
            assert sum(name in got[i] for i in places) >= 38, (name, way)
    assert sum(got[i] != [want[i]] for i in got) <= 4
    clean = [*tried, *ls.ORDINARY, "The album was released under the name of her brother.", "It is licensed under the law of the land.", "All rights to it were reserved."]
    assert not any(r.families for r in ls.scan(frame(spark, clean), model=model).collect())


def chains_by_hand(words, known):
    found = []
    for i in range(len(words)):
        for j in range(i + 3, len(words) + 1):
            inner = all((words[k], words[k + 1]) in known for k in range(i, j - 1))
            left = i > 0 and (words[i - 1], words[i]) in known
            right = j < len(words) and (words[j - 1], words[j]) in known
            if inner and not left and not right:
                found.append(words[i:j])
    return found


def test_chains_and_probabilities_by_hand(model):
    rng = random.Random(8)
    known = {(a, b) for a in "abc" for b in "abc" if a != b}
    for _ in range(200):
        words = [rng.choice("abcx") for _ in range(rng.randint(0, 14))]
        cut = rng.randint(0, len(words))
        lines = [[(0, 0, w) for w in part] for part in (words[:cut], words[cut:])]
        assert [[w for *_, w in c] for c in ls.chains(lines, known)] == chains_by_hand(words, known)
    paragraphs = [sentence(rng, n).lower().split() for n in (1, 5, 30)] + [[], ["the", "mit", "license"]]
    for words, got in zip(paragraphs, model.probabilities(paragraphs)):
        grams = {*words, *(f"{a} {b}" for a, b in zip(words, words[1:]))}
        logits = [model.bias[k] + sum(model.weights[model.vocabulary[g]][k] for g in grams if g in model.vocabulary) / max(len(grams), 1) ** 0.5 for k in range(len(model.families))]
        want = [math.exp(x / model.temperature) for x in logits]
        assert max(abs(a - b / sum(want)) for a, b in zip(got, want)) < 1e-4


def test_scan_of_a_table_finds_its_license_lines(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    lines = {"Released under the MIT License.": "MIT", "Licensed under CC BY-NC 4.0.": "CC-BY-NC", "Licensed under the Apache License, Version 2.0.": "Apache",
             "This work is licensed under the GNU General Public License, version 3.": "GPL", "All rights reserved.": "Proprietary"}
    got = {r.doc_id: r.families for r in ls.scan(docs).collect()}
    for doc_id, text in docs.select("doc_id", "text").collect():
        assert got[doc_id] == sorted({f for line, f in lines.items() if line in text.split("\n")})


def test_short_reservations_of_rights(spark, sf_dir, model):
    for text in ("All rights reserved.", "Copyright 2020 X. All rights reserved.", "(c) 1999 Some Company, Inc. All Rights Reserved"):
        found, shared = family(model, text)
        assert found == "Proprietary" and shared >= 0.5, text
    for text in ("She reserved all rights to the book.", "All rights to the land were reserved for the town.", "The rights reserved to the states are many."):
        found, shared = family(model, text)
        assert found == ls.UNKNOWN or shared < 0.5, text
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r.doc_id for r in ls.scan(docs).collect() if "Proprietary" in r.families}
    want = {doc_id for doc_id, text in docs.select("doc_id", "text").collect() if "All rights reserved." in text.split("\n")}
    assert len(want) == 3 and got == want
