"""Repair of conversations: the cheapest edits that make a conversation well formed, by bidirectional Dijkstra over the edit lattice.

A node of the lattice is (rows read, what the last written turn was).  Keeping, reroling or deleting a row reads it, inserting an
empty turn does not.  Searches from both ends settle nodes in the order of cost until none that is left can be on a cheapest path;
of all nodes where cheapest halves meet, the one with the least concatenated audit (the edits' initials in order) wins.

Roles must read ``(s?(ua)+)?``.  Which role a reroled or inserted turn gets follows from the turn before, so an audit tells the
whole repair, and two audits of equal cost to the same node are never prefixes of each other.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridclear.llm.common import WORD_PATTERN

#: What was written last: nothing, a system, user or assistant turn; the role initials that may follow and what they lead to.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
FOLLOWS = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
COMPLETE = (START, ASSISTANT)
ROLE_OF = {"u": "user", "a": "assistant"}
FORCED = tuple("a" if state == USER else "u" for state in range(STATES))  # what may be written by R or I

KEEP, REROLE, DELETE, INSERT = "KRDI"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1
BLOCK = 256  # rows of a conversation that are searched at once

BLANK, DUPLICATE, TRUNCATED = "blank", "duplicate", "truncated"


@dataclass(frozen=True)
class Turn:
    initial: str  # of the role
    fault: str | None = None

    @property
    def must_go(self) -> bool:
        return self.fault in (BLANK, DUPLICATE)


Node = tuple[int, int]
Label = tuple[int, str]


def edits_of(turns: list[Turn], node: Node) -> Iterator[tuple[Node, int, str]]:
    """(next node, cost, initial) of all edits at a node."""
    read, state = node
    written = FOLLOWS[state][FORCED[state]]
    yield (read, written), INSERT_COST, INSERT
    if read < len(turns):
        turn = turns[read]
        yield (read + 1, state), DELETE_COST, DELETE
        if not turn.must_go:
            extra = TRUNCATED_COST if turn.fault == TRUNCATED else 0
            yield (read + 1, written), REROLE_COST + extra, REROLE
            if turn.initial in FOLLOWS[state]:
                yield (read + 1, FOLLOWS[state][turn.initial]), extra, KEEP


def edits_into(turns: list[Turn], node: Node) -> Iterator[tuple[Node, int, str]]:
    """(node before, cost, initial) of all edits that lead to a node."""
    read, state = node
    for before in range(STATES):
        for source in {(read, before), (read - 1, before)}:
            if source[0] >= 0:
                yield from ((source, cost, initial) for target, cost, initial in edits_of(turns, source) if target == node)


class Search:
    """Dijkstra from one end; labels are (cost, least audit of that cost), and nodes are settled by cost, then along the rows.

    Only keeping is free, and it moves along the rows, so a settled label cannot improve any more.
    """

    def __init__(self, turns: list[Turn], start: Node, backwards: bool):
        self.turns, self.backwards = turns, backwards
        self.labels: dict[Node, Label] = {start: (0, "")}
        self.settled: set[Node] = set()
        self.heap = [self.entry(start, 0)]

    def entry(self, node: Node, cost: int) -> tuple:
        return cost, -node[0] if self.backwards else node[0], node

    def least(self) -> int | None:
        """The cost of the next node to be settled."""
        while self.heap and (self.heap[0][2] in self.settled or self.labels[self.heap[0][2]][0] < self.heap[0][0]):
            heapq.heappop(self.heap)
        return self.heap[0][0] if self.heap else None

    def settle(self) -> Iterator[Node]:
        """Settles one node and yields those whose label it improves."""
        node = heapq.heappop(self.heap)[2]
        self.settled.add(node)
        cost, audit = self.labels[node]
        for other, more, initial in (edits_into if self.backwards else edits_of)(self.turns, node):
            label = (cost + more, initial + audit if self.backwards else audit + initial)
            old = self.labels.get(other)
            if old is None or label < old:
                self.labels[other] = label
                if old is None or label[0] < old[0]:
                    heapq.heappush(self.heap, self.entry(other, label[0]))
                yield other


def cheapest(turns: list[Turn], start: int, end: int) -> Label | None:
    """Least cost, and of that cost the least audit, from state ``start`` before the rows to state ``end`` after them; None if there is no way."""
    ahead, back = Search(turns, (0, start), False), Search(turns, (len(turns), end), True)
    best: int | None = 0 if not turns and start == end else None
    while True:
        one, other = ahead.least(), back.least()
        if one is None or other is None or (best is not None and one + other > best):
            break
        mine, theirs = (ahead, back) if one <= other else (back, ahead)
        for node in mine.settle():
            met = theirs.labels.get(node)
            if met is not None and (best is None or mine.labels[node][0] + met[0] < best):
                best = mine.labels[node][0] + met[0]
    if best is None:
        return None
    meeting = (n for n in ahead.labels.keys() & back.labels.keys() if ahead.labels[n][0] + back.labels[n][0] == best)
    return best, min(ahead.labels[n][1] + back.labels[n][1] for n in meeting)


@dataclass
class Repair:
    """A repair of the rows so far that ends in one state."""

    cost: int = 0
    audit: str = ""
    lines: int = 0
    digest: hashlib._Hash = field(default_factory=hashlib.sha256)

    def extended(self, label: Label, state: int, rows: list[tuple[Turn, str, str]]) -> Repair:
        """This repair, then the edits of ``label`` on ``rows`` (turn, role, text) from ``state`` on."""
        out = Repair(self.cost + label[0], self.audit + label[1], self.lines, self.digest.copy())
        at = 0
        for edit in label[1]:
            role, text = ROLE_OF[FORCED[state]], ""
            if edit != INSERT:
                turn, own_role, own_text = rows[at]
                at += 1
                if edit == DELETE:
                    continue
                text = own_text
                if edit == KEEP:
                    role = own_role
            out.digest.update(f"{chr(10) if out.lines else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
            out.lines += 1
            state = FOLLOWS[state][turn.initial if edit == KEEP else FORCED[state]]
        return out


class Conversation:
    """Reads a conversation's rows in order; memory holds a block of them and a repair for each state."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        self.repairs: dict[int, Repair] = {START: Repair()}
        self.rows: list[tuple[Turn, str, str]] = []
        self.faults = {BLANK: 0, DUPLICATE: 0, TRUNCATED: 0}
        self.illegal, self.before = 0, None

    def add(self, role: str, text: str, fault: str | None) -> None:
        if len(self.rows) == self.block:
            self.advance(range(STATES))
        initial = role[:1]
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        if fault:
            self.faults[fault] += 1
        self.rows.append((Turn(initial, fault), role, text))

    def advance(self, ends: Iterable[int]) -> None:
        """Goes on to the best repair of the block for each of the states ``ends``."""
        turns, after = [turn for turn, _, _ in self.rows], {}
        for end in ends:
            ways = []
            for state, repair in self.repairs.items():
                label = cheapest(turns, state, end)
                if label is not None:
                    ways.append((repair.cost + label[0], repair.audit + label[1], state, label))
            if ways:
                *_, state, label = min(ways)
                after[end] = self.repairs[state].extended(label, state, self.rows)
        self.repairs, self.rows = after, []

    def finish(self) -> Repair:
        self.advance(COMPLETE)
        return min(self.repairs.values(), key=lambda r: (r.cost, r.audit))


#: Order of the rows of a conversation: by turn, ties by what the rows say.
ORDER = ["turn", "role", "text", "copy"]


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copy): rows of ``conversations`` damaged by the checksum of ``conv_id:turn``.

    Of its remainder by 20, 0 drops a row, 1 empties its text, 2 takes out ``.``, ``!`` and ``?``, 3 repeats it, 4 makes it the
    user's.  Null roles and texts, and null ids and turns in the checksum, are one space; ids and turns themselves stay null.
    """
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), part("role").alias("role"), part("text").alias("text"))
    way = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    copies = F.when(F.col("way") == 3, F.sequence(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    hit = rows.withColumn("way", way).filter("way <> 0").withColumn("copy", F.explode(copies))
    text = F.when(F.col("way") == 1, "").when(F.col("way") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return hit.select("conv_id", "turn", F.when(F.col("way") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), "copy")


def with_faults(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text, copy) with ``fault``: the first of blank, duplicate and truncated, or null.

    What was said earlier is found per conversation, role and hash of the text: rows with equal ones are numbered in order.
    """
    said = Window.partitionBy("conv_id", "role", F.sha2("text", 256), F.length("text")).orderBy(F.col("turn").asc_nulls_first(), "copy")
    visible = F.rtrim(F.translate("text", "\t\n\x0b\x0c\r", "     "))
    fault = (
        F.when(~F.col("text").rlike(WORD_PATTERN), BLANK)
        .when(F.col("earlier") > 1, DUPLICATE)
        .when(~F.substring(visible, -1, 1).isin(".", "!", "?"), TRUNCATED)
    )
    return rows.withColumn("earlier", F.row_number().over(said)).withColumn("fault", fault).drop("earlier")


SCHEMA = "conv_id long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string, gaps long"
OUT = pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in SCHEMA.split(", ")])


def repair(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text, fault, copy): its faults, the cheapest repair and its digest.

    Conversations are spread by id and read in order.  A digest of a whole conversation needs its rows one after another, but a
    task holds a block of them only, and the audit.
    """
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", *ORDER)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: Conversation | None = None
        conv_id, turns, first, last = None, 0, None, None
        done: list[dict] = []

        def finish() -> None:
            if current is not None:
                best = current.finish()
                gaps = last - first + 1 - turns if turns else 0
                done.append(
                    {"conv_id": conv_id, **current.faults, "illegal": current.illegal, "cost": best.cost, "audit": best.audit, "repaired_sha256": best.digest.hexdigest(), "gaps": gaps}
                )

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "fault"))):
                if current is None or row[0] != conv_id:
                    finish()
                    current, conv_id, turns, first, last = Conversation(block), row[0], 0, None, None
                if row[1] is not None:
                    first = row[1] if first is None else first
                    turns += row[1] != last
                    last = row[1]
                current.add(*row[2:])
            yield pa.RecordBatch.from_pylist(done, schema=OUT)
            done = []
        finish()
        yield pa.RecordBatch.from_pylist(done, schema=OUT)

    return ordered.mapInArrow(run, SCHEMA)


def repair_damaged(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """Every conv_id of ``conversations`` (conv_id, turn, role, text), whatever else it has, with its repair after ``damaged``.

    ``gaps`` are turn numbers missing between the least and the largest (0 where all are null); ``illegal`` neighbouring rows whose role
    initials are not su, ua or au.  Rows without id form one conversation, repeated rows are rows of their own (so duplicates),
    rows with equal turns are ordered by role and text.  A conversation without rows after the damage has zeros, an empty audit and
    the digest of nothing; an empty table gives no rows.
    """
    found = repair(with_faults(damaged(conversations)), block)
    ids = conversations.select(F.col("conv_id").cast("long").alias("id")).distinct()
    joined = ids.join(found, F.col("id").eqNullSafe(F.col("conv_id")), "left")
    empty = {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    names = [f.name for f in OUT][1:]
    return joined.select(F.col("id").alias("conv_id"), *(F.coalesce(F.col(c), F.lit(empty.get(c, 0))).alias(c) for c in names))
