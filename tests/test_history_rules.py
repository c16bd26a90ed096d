"""Tables with validity against a step-by-step evaluation, and rules that are rows."""

import datetime as dt
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from gridclear.operators import rules as ru
from gridclear.operators.cleaning import bid_rules
from gridclear.sources.history_table import HistoryTable

SCHEMA = T.StructType().add("day", T.DateType()).add("place", T.StringType()).add("volume", T.DecimalType(18, 3)).add("note", T.StringType())


def day(n):
    return dt.date(2024, 9, 1) + dt.timedelta(days=n)


def at(n):
    return dt.datetime(2024, 10, 1) + dt.timedelta(hours=n)


def new_table(spark, root):
    return HistoryTable(spark, f"{root}/history", SCHEMA, ["day"], ["day", "place"])


def facts(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("complete", [False, True])
def test_random_loads(spark, tmp_path, complete):
    table, rng = new_table(spark, tmp_path), random.Random(complete)
    open_rows, expected, states = {}, [], []
    for n in range(4):
        load = {(day(rng.randrange(3)), rng.choice(["a", "b", None])): (rng.choice([1, 2, None]), rng.choice(["x", None])) for _ in range(5)}
        rows = [(*key, *value) for key, value in load.items()]
        frame = spark.createDataFrame([(d, p, v, t, "more") for d, p, v, t in rows], "day date, place string, volume int, note string, effective_to string")
        table.load(frame, at(n), complete)
        gone = [k for k in open_rows if complete and k not in load and k[0] in {d for d, _ in load}]
        for key in gone + [k for k in load if k in open_rows and open_rows[k][0] != load[k]]:
            value, since = open_rows.pop(key)
            expected.append((*key, *value, at(since), at(n)))
        for key in load:
            open_rows.setdefault(key, (load[key], n))
        states.append([(*k, *v) for k, (v, _) in open_rows.items()])
    expected += [(*k, *v, at(since), None) for k, (v, since) in open_rows.items()]
    plain = table.read().selectExpr("day", "place", "int(volume) volume", "note", "effective_from", "effective_to")
    assert facts(plain) == sorted(expected, key=repr)
    for n, state in enumerate(states):
        seen = table.as_of(at(n) + dt.timedelta(minutes=5)).selectExpr("day", "place", "int(volume)", "note")
        assert facts(seen) == sorted(state, key=repr)
    assert facts(table.current()) == facts(table.as_of("2030-01-01 00:00:00"))
    assert table.as_of(at(-1)).count() == 0


def test_repeats_empty_loads_and_late_ones(spark, tmp_path):
    table = new_table(spark, tmp_path)
    one = spark.createDataFrame([(day(0), "a", None, "x"), (day(0), "a", None, "y"), (day(1), None, None, None)], "day date, place string, volume decimal(18,3), note string")
    table.load(one, at(5))
    table.load(one, at(6))
    table.load(one.limit(0), at(7), complete=True)
    before = facts(table.read())
    assert [(r[1], r[3], r[5], r[6]) for r in before] == [("a", "y", at(5), None), (None, None, at(5), None)]
    with pytest.raises(PySparkException):
        table.load(one.filter("place = 'a'").selectExpr("day", "place", "volume", "'z' note"), at(4))
    assert facts(table.read()) == before
    zoned = at(9).replace(tzinfo=dt.timezone(dt.timedelta(hours=2)))
    table.load(one.filter("place = 'a'").selectExpr("day", "place", "volume", "'z' note"), zoned)
    assert facts(table.read().filter("effective_to IS NOT NULL").select("note", "effective_to")) == [("y", at(7))]
    assert table.table.history().count() == 4  # the failed load is none


def test_rules_as_rows(spark):
    name = "RESULT_LIST_ANONYM_ENERGY_MARKET_aFRR_DE_2024-09-01_2024-09-03.xlsx"
    rows = spark.createDataFrame(
        [(day(0), 1.0, "a1", name), (day(5), None, "b", name), (None, 9.0, None, "other"), (day(9), float("nan"), "a2", "other"), (day(1), 3.0, "a", None)],
        "`a.day` date, price double, code string, file string",
    )
    rules = [
        ru.Rule("it's in its period", "named_period", ("a.day", "file")),
        ru.Rule("cheap", "range", ("price",), "0", "5"),
        ru.Rule("any price", "range", ("price",)),
        ru.Rule("code", "pattern", ("code",), pattern=r"^a\d"),
        ru.Rule("filled", "not_null", ("a.day", "price", "code", "file")),
    ]
    stored = spark.createDataFrame(rules, ru.RULES)
    broken = [sorted(r.broken_rules) for r in ru.broken_rules(rows, stored).collect()]
    period = "it's in its period"
    assert broken == [[], ["any price", "cheap", "code", "filled", period], ["cheap", "code", "filled", period], ["cheap"], ["code", "filled", period]]
    counts = {r.rule: (r.failed_rows, r.checked_rows) for r in ru.check_rules(rows, stored).collect()}
    assert counts == {rule: (sum(rule in b for b in broken), 5) for rule in counts} and len(counts) == 5
    assert {r.failed_rows for r in ru.check_rules(rows.limit(0), rules).collect()} == {0}
    assert ru.check_rules(rows, stored.limit(0)).count() == 0
    assert [r.broken_rules for r in ru.broken_rules(rows.limit(1), []).collect()] == [[]]


def test_rules_that_cannot_be_checked(spark):
    rows = spark.createDataFrame([(1,)], "n int")
    for bad in ([ru.Rule("r", "range", ("m",))], [ru.Rule("r", "other", ("n",))], [ru.Rule("r", "pattern", ("n",))], [ru.Rule("r", "not_null", ())],
                [ru.Rule("r", "not_null", ("n",))] * 2, [ru.Rule(None, "not_null", ("n",))]):
        with pytest.raises(ru.InvalidRules):
            ru.check_rules(rows, bad)
    many = spark.range(ru.MOST_RULES + 1).selectExpr("string(id) rule", "'not_null' kind", "array('n') columns", "string(null) low", "string(null) high", "string(null) pattern")
    with pytest.raises(ru.InvalidRules):
        ru.check_rules(rows, many)
    assert len(bid_rules("2024-01-01", "2024-12-31")) == 5
