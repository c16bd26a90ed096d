import hashlib
import random

from gridclear.llm import chat_format as cf

TURNS = "conv_id long, turn long, role string, text string, formatted string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], TURNS)


def random_turns(rng):
    alphabet = ["### ", "Assistant: ", "</turn>", "\\", "\n", "#", "<", ":", "\\h", "é", "😀", "a", " ", "\\\\l", ""]
    return [
        (rng.choice(["user", "assistant", "system", "a: b", "#\\c", ""]), "".join(rng.choices(alphabet, k=rng.randint(0, 12))))
        for _ in range(rng.randint(1, 12))
    ]


def test_round_trip_of_any_text():
    rng = random.Random(1)
    for _ in range(500):
        turns = random_turns(rng)
        text = cf.marked_turns(turns)
        assert cf.parse_marked(text) == turns
        assert text.count("</turn>") == len(turns) and text.count("### ") == len(turns)


def test_spans_of_any_text():
    rng = random.Random(2)
    for _ in range(200):
        turns = random_turns(rng)
        spans = cf.locate(turns, cf.marked_turns)
        assert not spans.rewrites_history and spans.formatted == cf.marked_turns(turns)
        for (_, text), a, b, c, d in zip(turns, spans.turn_start, spans.text_start, spans.text_end, spans.turn_end):
            assert a <= b <= c <= d and cf.unescape(spans.formatted[b:c]) == text
        assert spans.turn_start == [0, *spans.turn_end[:-1]] and spans.turn_end[-1] == len(spans.formatted)


def test_templates_that_rewrite_history_are_found(spark):
    def drops_earlier_turns(turns):
        return "".join(f"[{r}] {t}\n" for r, t in turns[-3:])

    def only_last_marked(turns):
        return "".join(f"{r}: {t}{' <end>' if k == len(turns) - 1 else ''}\n" for k, (r, t) in enumerate(turns))

    def counts_turns(turns):
        return "".join(f"{k}/{r}: {t}\n" for k, (r, t) in enumerate(turns))

    rows = [(1, k, "user" if k % 2 else "assistant", f"text {k}") for k in range(6)] + [(2, 0, "user", "one")]
    for template, wrong in ((drops_earlier_turns, {1}), (only_last_marked, {1}), (counts_turns, set())):
        got = {r.conv_id: r for r in cf.format_conversations(frame(spark, rows), template).collect()}
        assert {c for c, r in got.items() if r.rewrites_history} == wrong
        assert all(r.turn_start == [] for r in got.values() if r.rewrites_history)
        assert got[1].formatted == template([(r, t) for _, _, r, t in rows[:6]])
        spans = got[2]
        assert spans.formatted[spans.text_start[0] : spans.text_end[0]] == "one"
    digests = cf.read_back(cf.format_conversations(frame(spark, rows[:6]), only_last_marked)).collect()
    assert {(r.conv_id, r.n_turns) for r in digests if r.rewrites_history} == {(1, None)}


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv))
        said = "".join(t for _, _, r, t in turns if r == "assistant")
        out[conv] = (
            len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for _, _, r, t in turns).encode()).hexdigest(), len(said),
            hashlib.sha256(said.encode()).hexdigest(), len(cf.marked_turns([(r, t) for _, _, r, t in turns])),
        )
    return out


def test_digests(spark):
    rng = random.Random(3)
    rows = [(c, k, r, t) for c in range(40) for k, (r, t) in enumerate(random_turns(rng))]
    rows += [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]
    rows += [(None, 0, None, None), (None, None, "assistant", "é"), (99, 1, "assistant", None), (98, 0, "user", "b"), (98, 0, "user", "a"), (98, 0, "user", "a")]
    rows += [(97, k, "assistant", "long " * 500) for k in range(300)]
    rng.shuffle(rows)
    got = cf.read_back(cf.format_conversations(frame(spark, rows).repartition(5), cf.marked_turns)).collect()
    found = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars) for r in got}
    assert found == brute(rows) and len(got) == len(found)
    assert cf.format_conversations(spark.createDataFrame([], TURNS), cf.marked_turns).count() == 0
