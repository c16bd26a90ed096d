import random
from collections import Counter

from helpers import WORDS, empty, frame, odd_texts, words_of

from gridclear.llm import fertility as fe
from gridclear.llm.tokenizer_files import path

FILE = path("piece_bpe_32k.model")


def brute(text):
    words = words_of(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    repeated = {i + k for i, w in enumerate(windows) if w in often for k in range(3)}
    lines = [x for x in (text or "").split("\n") if words_of(x)]
    return (
        len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(repeated),
        len(words) < 50 or 100 * len(repeated) > 50 * len(words),
    )


def test_base_counts(spark):
    rng = random.Random(1)
    texts = odd_texts()
    texts += ["\n".join(" ".join(rng.choice("ab#|") for _ in range(rng.randint(0, 6))) for _ in range(rng.randint(0, 30))) for _ in range(80)]
    texts += [" ".join(rng.choice(WORDS) for _ in range(n)) for n in (49, 50, 300)]
    ids = [None, 1, 1, *range(10, 7 + len(texts))]
    got = fe.quality_rules(frame(spark, texts, ids, clashing=True).repartition(3), FILE).collect()
    rows = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got)
    assert rows == Counter((i, *brute(t)) for i, t in zip(ids, texts))
    assert all(r.reason == "base" and not r.kept for r in got if r.base_failed)


def language(rng, syllables):
    return [" ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(rng.randint(120, 130))) for _ in range(80)]


def test_bands_reject_junk_and_keep_clean(spark):
    rng = random.Random(2)
    clean = {"en": language(rng, ["the", "ing", "er", "st", "on"]), "de": language(rng, ["ung", "sch", "ein", "ver", "ß"])}
    junk = ["".join(rng.choice("0123456789abcdef") for _ in range(6)) + " #%$&*| " for _ in range(40)]
    junk_texts = [" ".join(rng.choice(junk) for _ in range(30)) + " " + " ".join("".join(rng.choices("qxzjk", k=9)) for _ in range(20)) for _ in range(4)]
    foreign = [" ".join("".join(rng.choices("ͷ꙰ꔀ𐎀𒀀", k=4)) for _ in range(60))]
    texts = clean["en"] + clean["de"] + junk_texts + foreign
    langs = ["en"] * 80 + ["de"] * 80 + ["en", "en", "de", "de", "en"]
    got = {r.doc_id: r for r in fe.quality_rules(frame(spark, texts, langs=langs), FILE).collect()}
    assert sum(got[i].kept for i in range(160)) >= 158
    assert not any(got[i].kept for i in range(160, 165))
    assert got[164].byte_share > 0.5


def test_copies_do_not_narrow_bands(spark):
    rng = random.Random(4)
    clean = {"en": language(rng, ["the", "ing", "er", "st", "on"]), "de": language(rng, ["ung", "sch", "ein", "ver", "ß"])}
    langs = ["en"] * 80 + ["de"] * 80 + ["en"] * 300
    near = [f"{clean['en'][0]} {''.join(rng.choices('aeiou', k=4))}" for _ in range(300)]
    for more in ([clean["en"][0]] * 300, near):
        got = {r.doc_id: r for r in fe.quality_rules(frame(spark, clean["en"] + clean["de"] + more, langs=langs), FILE).collect()}
        assert sum(got[i].kept for i in range(160)) >= 158
        junk = clean["en"] + clean["de"] + more[:-1] + [" ".join("".join(rng.choices("ͷ꙰ꔀ𐎀𒀀", k=4)) for _ in range(60))]
        assert [r.kept for r in fe.quality_rules(frame(spark, junk, langs=langs), FILE).filter("doc_id = 459").collect()] == [False]


def test_unknown_language_goes_by_script(spark):
    assert fe.script_of("Привет, мир") == "Cyrillic"
    assert fe.script_of("é") == fe.script_of("plain") == "Latin"
    assert fe.script_of("١٢٣") == "other"
    got = fe.quality_rules(frame(spark, ["word " * 10, "слово " * 10]), FILE).collect()
    assert sorted(r.script for r in got) == ["Cyrillic", "Latin"]
    assert fe.quality_rules(empty(spark), FILE).count() == 0


def test_measures_match_the_library():
    words = "some words, and été 中".encode().split()
    model = fe.Fertility(FILE)
    ids = [i for w in words for i in model.model.encode(w.decode())]
    assert model.ids(words).tolist() == ids
    chars, share, bits, n = model.measures(words, 20)
    assert n == len(ids) and chars == 20 / n and share == sum(map(model.model.is_byte, ids)) / n and bits > 0


def test_words_encoded_together_or_alone():
    rng = random.Random(3)
    alphabet = "aé中\u2581\u200b\u0301\u3000\xa0ﬁ½<s>\x00😀"
    words = [w for w in ("".join(rng.choices(alphabet, k=rng.randint(1, 6))) for _ in range(400))]
    model = fe.Fertility(FILE)
    for k in range(0, len(words), 5):
        some = [w.encode() for w in words[k : k + 5]]
        alone = [i for w in some for i in model.model.encode(w.decode())]
        assert model.ids(some).tolist() == alone, some
    plain = ["".join(rng.choices("aé½¨´ß<s>.,", k=rng.randint(1, 6))) for _ in range(400)]
    assert model.together(plain) == model.alone(plain) and model.together([]) == []
