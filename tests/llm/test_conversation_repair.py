import collections
import hashlib
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridclear.llm import conversation_repair as cr

COLUMNS = "conv_id long, turn long, role string, text string"


def brute_repair(turns, start=cr.START, ends=cr.COMPLETE):
    """Least (cost, audit) by trying all edit sequences in the order of cost, without the lattice's searches."""
    least = {(0, start): (0, "")}
    for _ in range(4 * len(turns) + 12):  # relax all edges until nothing changes
        changed = False
        for node in list(least):
            cost, audit = least[node]
            for other, more, initial in cr.edits_of(turns, node):
                label = (cost + more, audit + initial)
                if other not in least or label < least[other]:
                    least[other] = label
                    changed = True
        if not changed:
            break
    return min(least[len(turns), end] for end in ends if (len(turns), end) in least)


def written_roles(turns, audit):
    """Role initials that an audit writes, and its cost, followed edit by edit."""
    out, cost, at = "", 0, 0
    for edit in audit:
        if edit != "I":
            turn = turns[at]
            at += 1
            cost += turn.fault == cr.TRUNCATED and edit != "D"
        cost += {"K": 0, "R": 2, "D": 3, "I": 2}[edit]
        if edit == "K":
            assert not turn.must_go
            out += turn.initial
        elif edit in "RI":
            assert edit == "I" or not turn.must_go
            out += "a" if out.endswith("u") else "u"
    assert at == len(turns)
    return out, cost


turn = st.builds(cr.Turn, st.sampled_from(["s", "u", "a", "u", "a", "t", ""]), st.sampled_from([None, None, None, cr.BLANK, cr.DUPLICATE, cr.TRUNCATED]))


@settings(max_examples=400, deadline=None)
@given(st.lists(turn, max_size=9))
def test_the_least_audit_of_the_cheapest_repair(turns):
    found = min(filter(None, (cr.cheapest(turns, cr.START, end) for end in cr.COMPLETE)))
    assert found == brute_repair(turns)
    roles, cost = written_roles(turns, found[1])
    assert re.fullmatch("(s?(ua)+)?", roles) and cost == found[0]


@settings(max_examples=150, deadline=None)
@given(st.lists(turn, max_size=12), st.integers(0, 3), st.integers(0, 3))
def test_any_two_states(turns, start, end):
    found = cr.cheapest(turns, start, end)
    try:
        want = brute_repair(turns, start, [end])
    except ValueError:
        want = None
    assert found == want


@settings(max_examples=100, deadline=None)
@given(st.lists(turn, max_size=14), st.integers(1, 5))
def test_blocks_give_the_same_repair(turns, block):
    rows = [(t.initial + "x" if t.initial else "", f"text {i}", t.fault) for i, t in enumerate(turns)]
    whole, parts = cr.Conversation(100), cr.Conversation(block)
    for row in rows:
        whole.add(*row)
        parts.add(*row)
    one, other = whole.finish(), parts.finish()
    assert (one.cost, one.audit, one.digest.hexdigest()) == (other.cost, other.audit, other.digest.hexdigest())
    assert (whole.illegal, whole.faults) == (parts.illegal, parts.faults)


def brute_query(rows):
    """The contract's columns per conversation, straight from its words."""
    by_id = collections.defaultdict(list)
    for conv_id, number, role, text in rows:
        by_id[conv_id].append((number, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv_id, members in by_id.items():
        after = []
        for number, role, text in sorted(members, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])):
            key = f"{' ' if conv_id is None else conv_id}:{' ' if number is None else number}"
            way = zlib.crc32(key.encode()) % 20
            if way == 0:
                continue
            if way == 1:
                text = ""
            if way == 2:
                text = re.sub("[.!?]", "", text)
            if way == 4:
                role = "user"
            after += [(number, role, text)] * (2 if way == 3 else 1)
        after.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, turns = set(), []
        for _, role, text in after:
            visible = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = cr.BLANK if not visible else cr.DUPLICATE if (role, text) in seen else cr.TRUNCATED if visible[-1] not in ".!?" else None
            seen.add((role, text))
            turns.append(cr.Turn(role[:1], fault))
        cost, audit = brute_repair(turns)
        lines, roles, at = [], "", 0
        for edit in audit:
            forced = "assistant" if roles.endswith("u") else "user"
            _, role, text = after[at] if edit != "I" else (None, None, "")
            at += edit != "I"
            if edit != "D":
                role = role if edit == "K" else forced
                lines.append(f"{role}:{text}")
                roles += role[0]
        numbers = [r[0] for r in after if r[0] is not None]
        initials = [t.initial for t in turns]
        out[conv_id] = (
            max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
            *(sum(t.fault == f for t in turns) for f in (cr.BLANK, cr.DUPLICATE, cr.TRUNCATED)),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def got(df):
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in rows}


@pytest.mark.parametrize("block", [3, cr.BLOCK])
def test_random_conversations(spark, block):
    rng = random.Random(7)
    said = ["Yes.", "No!", "Why?", "and then", "Well. ", "ok\t\x0b", "", "  ", None, "ä。", " "]
    rows = []
    for conv_id in [None, *range(150)]:
        for k in range(rng.randint(1, 9)):
            number = rng.choice([k, k, k, None, rng.randint(-3, 12)])
            rows.append((conv_id, number, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "User"]), rng.choice(said)))
    df = spark.createDataFrame(rows, COLUMNS)
    assert got(cr.repair_damaged(df, block)) == brute_query(rows)
    clashing = df.selectExpr("*", "1 AS copy", "2 AS way", "'x' AS fault", "'y' AS id", "0 AS earlier", "3 AS gaps")
    assert got(cr.repair_damaged(clashing.repartition(3))) == brute_query(rows)


def test_a_long_conversation(spark):
    rng = random.Random(9)
    rows = [(1, k, rng.choice(["user", "assistant"]), f"turn {k}{rng.choice('.?! x')}") for k in range(1500)] + [(2, 0, "user", "word " * 200_000 + "end.")]
    assert got(cr.repair_damaged(spark.createDataFrame(rows, COLUMNS), 64)) == brute_query(rows)


def test_conversations_without_rows(spark):
    assert cr.repair_damaged(spark.createDataFrame([], COLUMNS)).count() == 0
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = got(cr.repair_damaged(spark.createDataFrame([(dropped, 0, "user", "Hello.")], COLUMNS)))
    assert rows == {dropped: (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}


def test_given_conversations(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    rows = [tuple(r) for r in table.collect()]
    assert got(cr.repair_damaged(table)) == brute_query(rows)
