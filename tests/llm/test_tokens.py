"""Token counts and packing against the library's own encoding."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from helpers import empty, frame, odd_texts, sentence
from tokenizers import Tokenizer

from gridclear.llm import packing, token_counts
from gridclear.llm.tokenizer_files import PreTokens, path

BYTES, WORDS = path("byte_bpe_50k.json"), path("word_bpe_49k.json")


def library_ids(file, texts):
    return [e.ids for e in Tokenizer.from_file(file).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def corpus():
    rng = random.Random(5)
    alphabet = "aB'sé ßtl\n\t 1²½!#<\x85\xa0\x1c中İΣσ́​Ɓ "
    texts = odd_texts() + [sentence(rng, rng.randint(1, 300)) for _ in range(30)]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(60)]
    return texts + ["a<|endoftext|>b", "<|endoftext|><|startoftext|>", "I'll don't <|endoftext", "word " * 30000]


@pytest.mark.parametrize("file", [BYTES, WORDS])
def test_pretokens_give_the_ids_of_the_whole(file):
    rule = PreTokens(file)
    texts = [f"a{chr(c)}b{chr(c)} 1{chr(c)}2 {chr(c)}'s{chr(c)}\n" for c in range(0x300)] + corpus()[:-1]
    for text, want in zip(texts, library_ids(file, texts)):
        got = []
        for k, part in enumerate(rule.parts(text or "")):
            got += [rule.special[part]] if k % 2 else [i for ids in rule.encode(rule.split(part)) for i in ids]
        assert got == want, repr(text)


@pytest.mark.parametrize("head", [0, 20, 1 << 18])
def test_counts(spark, head):
    texts = corpus()
    ids = [None, 7, 7, *range(100, 100 + len(texts) - 3)]
    docs = frame(spark, texts, ids, clashing=True).repartition(3)
    got = token_counts.count_tokens(docs, BYTES, head=head)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = Counter()
    for i, t, n in zip(ids, texts, library_ids(BYTES, texts)):
        want[i, len((t or "").encode()), len(n), len(n) > 1024] += 1
    assert Counter(map(tuple, got.collect())) == want


def test_counts_of_nothing(spark):
    assert token_counts.count_tokens(empty(spark), BYTES).count() == 0


def check_packing(rows, ids, texts, file, capacity):
    full = defaultdict(list)
    for i, tokens in zip(ids, library_ids(file, texts)):
        full[i].append([*tokens, 1])
    pieces = defaultdict(list)
    sequences = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    used = padded = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
        used += at
        padded += at if at & (at - 1) == 0 else capacity
    assert used == sum(len(t) for ts in full.values() for t in ts)
    assert set(pieces) == set(full)
    for i, tokens in full.items():
        if len(tokens) == 1:
            at = 0
            for r in sorted(pieces[i], key=lambda r: r.start):
                assert r.start == at and r.doc_tokens == len(tokens[0])
                assert r.ids_crc32 == zlib.crc32(np.array(tokens[0][at : at + r.length], "<u4").tobytes())
                at += r.length
            assert at == len(tokens[0])
    return used / padded


def test_packing(spark):
    texts = corpus()
    ids = [None, 7, 7, *range(100, 100 + len(texts) - 3)]
    got = packing.pack(frame(spark, texts, ids, clashing=True).repartition(4), WORDS).collect()
    assert check_packing(got, ids, texts, WORDS, 2048) > 0.98


def test_packing_of_a_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = packing.pack(docs, WORDS).collect()
    assert check_packing(got, [r[0] for r in rows], [r[1] for r in rows], WORDS, 2048) > 0.98


def test_small_capacities_and_nothing(spark):
    texts = ["one two three four five six seven"] * 9
    for capacity in (1, 2, 8):
        got = packing.pack(frame(spark, texts).coalesce(1), WORDS, capacity).collect()
        check_packing(got, list(range(9)), texts, WORDS, capacity)
    assert packing.pack(empty(spark), WORDS).count() == 0
    with pytest.raises(ValueError):
        packing.pack(empty(spark), WORDS, 100)


def test_memo_generations():
    encoder = packing.Encoder(WORDS, 40)
    texts = [t or "" for t in corpus()[:-1]]
    got = [ids for k in range(0, len(texts), 5) for ids in encoder.ids(texts[k : k + 5])]
    assert [np.frombuffer(b, "<u4").tolist() for b in got] == library_ids(WORDS, texts)


def by_sequence(packer):
    found = defaultdict(list)
    for r in packer.rows:
        found[r[5]].append(r)
    return found


def lengths_packed(lengths, capacity=2048):
    packer = packing.HarmonicPacker(capacity, 0)
    for i, n in enumerate(lengths):
        packer.add(i, b"\1\0\0\0" * n)
    done = by_sequence(packer)
    packer.close()
    assert sum(r[2] for r in packer.rows) == sum(lengths)
    sizes = [sum(r[2] for r in rows) for rows in by_sequence(packer).values()]
    assert all(n == capacity or n & (n - 1) == 0 for n in sizes)
    return packer, done


def test_class_bins_hold_a_fixed_number_of_whole_documents(sf_dir):
    rng = random.Random(3)
    texts = [r["text"] for r in pq.read_table(f"{sf_dir}/documents.parquet", columns=["text"]).to_pylist()]
    real = [len(ids) + 1 for ids in library_ids(WORDS, texts)]
    for lengths in (real * 4, [max(1, int(rng.lognormvariate(6, 1))) for _ in range(10000)]):
        packer, done = lengths_packed(lengths)
        for rows in done.values():
            whole = [r for r in rows if r[2] == r[4]]
            if rows[0][2] == rows[0][4]:  # a class bin begins with its documents
                j = packer.class_of(rows[0][2])
                assert len(whole) >= j and {packer.class_of(r[2]) for r in whole[:j]} == {j}
                assert rows[:j] == whole[:j]
            else:  # what is left of long documents
                assert all(r[2] < r[4] for r in rows[:1])
        pieces = Counter(r[0] for r in packer.rows)
        fitting = [i for i, n in enumerate(lengths) if n <= 2048]
        assert sum(pieces[i] > 1 for i in fitting) < 0.1 * len(fitting)


@pytest.mark.parametrize("lengths", [[], [1] * 5000, [2048] * 9, [2047] * 300, [1023] * 501, [900] * 5, [5000] * 40, [2049] * 7, [1, 2048, 3]])
def test_packing_pads_nothing(lengths):
    lengths_packed(lengths)
    for capacity in (1, 2, 4, 64):
        lengths_packed(lengths, capacity)


def test_waiting_bins_are_bounded():
    packer = packing.HarmonicPacker(2048, 0)
    for i in range(20000):
        packer.add(i, b"\1\0\0\0" * (2048 // (1 + i % 7) - 1))
        assert len(packer.waiting) <= packing.PATIENCE * packing.MOST_PATIENCE + 2048


def test_packing_cuts_few_texts_at_a_time(spark, monkeypatch):
    from gridclear.llm import common, packing

    trimmed = []
    monkeypatch.setattr(common, "trim", lambda: trimmed.append(len(common._model)))
    common.resident(("trimmed",), object)
    assert trimmed[-1] == 1  # after it was built
    monkeypatch.undo()
    common.release()
    sizes = []

    class Noted:
        def ids(self, texts):
            sizes.append(sum(map(len, texts)))
            return [b"\x05\x00\x00\x00"] * len(texts)

    monkeypatch.setattr(packing, "encoder_of", lambda file, memo: Noted())
    monkeypatch.setattr(packing.TaskContext, "get", lambda: type("Task", (), {"partitionId": lambda self: 0})())

    class Rows:
        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):
            import pyarrow as pa

            batch = pa.RecordBatch.from_pydict({"doc_id": list(range(2000)), "text": ["x" * 1000] * 2000})
            return pa.Table.from_batches(run([batch]))

    assert packing.pack(Rows(), "").num_rows >= 2000
    assert max(sizes) < 1 << 19 and sum(sizes) == 2_000_000
