import random

import pytest
from compare import connect, differences
from helpers import empty, frame, odd_texts, sentence, words_of
from pyspark.sql import functions as F

import corpus_pipeline as cp
from gridclear.llm import queries
from gridclear.llm.common import written
from test_jaccard_groups import brute_components
from test_tokens import WORDS, check_packing

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_in_order():
    assert [name for name, _ in cp.STAGES] == ["quality rules", "language ID", "n-gram Jaccard join", "mixing sources", "packing"]


def ids(df):
    return sorted(r[0] for r in df.select("doc_id").collect())


def test_stages_of_a_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = dict(cp.STAGES)
    good = written(stages["quality rules"](spark, docs, sf_dir), "t")
    judged = queries.fertility.quality_rules(docs, queries.path(queries.FERTILITY_VOCABULARY))
    assert good.columns == COLUMNS and ids(good) == ids(judged.filter("kept")) and 0.6 * docs.count() < good.count() < docs.count()
    known = written(stages["language ID"](spark, good, sf_dir), "t")
    predicted = queries.language_id.identify(good)
    assert known.columns == COLUMNS and ids(known) == ids(predicted.filter("lang_pred <> 'und' AND score >= 0.5"))
    once = written(stages["n-gram Jaccard join"](spark, known, sf_dir), "t")
    rows = known.select("doc_id", "text").collect()
    want = brute_components([r[0] for r in rows], [r[1] for r in rows])
    assert once.columns == COLUMNS and ids(once) == sorted({c for _, _, c in want})
    mixed = written(stages["mixing sources"](spark, once, sf_dir), "t")
    taken = {r.doc_id: r.taken for r in queries.mixing.Mix(once).decisions().collect() if r.taken}
    words = {}
    for r in mixed.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(words_of(r.text))
    assert mixed.columns == COLUMNS and words == taken
    packed = stages["packing"](spark, mixed, sf_dir).collect()
    rows = mixed.collect()
    assert check_packing(packed, [r.doc_id for r in rows], [r.text for r in rows], WORDS, 2048) > 0.98


def test_run(spark, sf_dir):
    got = cp.run(spark, sf_dir)
    assert got.count() > 0 and "sequence_id" in got.columns


@pytest.mark.parametrize("name,stage", cp.STAGES)
def test_odd_rows_and_empty_tables(spark, sf_dir, name, stage):
    rng = random.Random(1)
    texts = odd_texts() + [sentence(rng, rng.randint(60, 200)) for _ in range(20)]
    texts += texts[-4:] + texts[-1:]
    keys = [None, 1, 1, *range(10, 7 + len(texts))]
    keys[-1] = keys[-2]  # a repeated row
    docs = frame(spark, texts, keys, ["en"] * len(texts), clashing=True)
    out = stage(spark, docs, sf_dir)
    assert out.count() > 0 and (name == "packing" or out.columns == docs.columns)
    nothing = stage(spark, empty(spark), sf_dir)
    assert nothing.count() == 0


def test_one_row_of_each_group_stays(spark, sf_dir):
    rng = random.Random(2)
    a, b = sentence(rng, 80), sentence(rng, 80)
    texts = [a, a, a, b + " x", b, None, "", None, "alone here"]
    docs = frame(spark, texts, [5, 5, 9, None, None, 1, 2, 1, 3])
    got = cp.keep_one_of_each_group(spark, docs, sf_dir).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in got if r.text != b and r.text != b + " x") == [(1, ""), (1, ""), (2, ""), (3, "alone here"), (5, a)]
    assert len(got) == 6


def test_quality_verdicts_go_by_language(spark, sf_dir):
    rng = random.Random(3)
    plain = [sentence(rng, 100) for _ in range(60)]
    other = [" ".join("".join(rng.choices("абвгд", k=5)) for _ in range(100)) for _ in range(60)]
    docs = frame(spark, plain + other + [plain[0]] * 2, [*range(120), None, None], ["en"] * 60 + ["ru"] * 60 + ["en", "ru"])
    judged = {r.lang: r.kept for r in queries.fertility.quality_rules(docs, queries.path(queries.FERTILITY_VOCABULARY)).filter("doc_id IS NULL").collect()}
    assert judged == {"en": True, "ru": False}
    got = cp.apply_quality_rules(spark, docs, sf_dir)
    assert [r.lang for r in got.filter("doc_id IS NULL").collect()] == ["en"] and got.columns == COLUMNS


def test_language_stage_without_labels(spark, sf_dir):
    texts = [*odd_texts(), "1 2 3", "plain text"]
    docs = frame(spark, texts)
    got = cp.identify_language(spark, docs, sf_dir)
    assert ids(got) == [i for i, t in enumerate(texts) if any(map(str.isalpha, t or ""))] and got.columns == COLUMNS


def test_queries_are_registered():
    import __spark_entry__ as entry

    found = entry.queries()
    assert [sum(n.startswith(f"op{k}_") for n in found) for k in range(1, 11)] == [1] * 10 and "pipeline" in found


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_agree_with_their_sql(spark, sf_dir, name):
    assert differences(spark, connect(sf_dir), name, queries.QUERIES[name], queries.ORACLE[name], sf_dir) is None


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE)))
def test_other_queries_give_a_row_per_document(spark, sf_dir, name):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = queries.QUERIES[name](spark, sf_dir)
    assert got.select(F.countDistinct("doc_id")).head()[0] == docs.count()
    assert name == "op9_packing" or got.count() == docs.count()
