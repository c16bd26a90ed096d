"""Profiles merged from states per day, against the rows."""


import pytest
from pyspark.sql import functions as F

from gridclear.operators import profile_state as ps

COLUMNS = ["n", "x.y", "text", "nothing"]


def rows_of(spark, rows):
    return spark.createDataFrame(rows, "day int, n decimal(18,3), `x.y` double, text string, nothing int")


def test_merged_states(spark, tmp_path):
    data = (
        spark.range(60_000)
        .selectExpr("int(id % 7) day", "cast((id * 7919) % 30011 as decimal(18,3)) n", "if(id % 10 = 0, null, (id * 31) % 5003 / 7) `x.y`", "concat('t', id % 4001) text", "int(null) nothing")
    )
    ps.profile_states(data, "day", COLUMNS).write.parquet(f"{tmp_path}/states")
    states = spark.read.parquet(f"{tmp_path}/states")
    weeks = ps.merged_states(states, (F.col("day") > 3).alias("late"))
    direct = ps.profile_states(data.withColumn("all", F.lit(1)), "all", COLUMNS)
    for merged in (states, weeks, direct):
        got = {r.column_name: r for r in ps.profile_of(merged).collect()}
        assert list(got) == COLUMNS
        assert {(r.total_count, r.null_count) for r in got.values()} == {(60_000, 0), (60_000, 6_000), (60_000, 60_000)}
        assert (got["n"].min_value, got["n"].max_value, got["text"].min_value, got["text"].max_value) == ("0.000", "30010.000", "t0", "t999")
        for name, unique in (("n", 30_011), ("x.y", 5_003), ("text", 4_001), ("nothing", 0)):
            assert got[name].unique_estimate == pytest.approx(unique, rel=0.032)
        for p, value in zip((0.25, 0.5, 0.75), got["n"].quantiles):
            below = data.filter(F.col("n") < value).count() / 60_000
            assert below == pytest.approx(p, abs=0.005)
        assert got["text"].quantiles is None and got["nothing"].quantiles is None


def test_odd_rows(spark):
    nan = float("nan")
    states = ps.profile_states(rows_of(spark, [(None, None, nan, "", None), (1, None, -0.0, "", None), (1, None, 0.0, None, None)]), "day", COLUMNS)
    assert states.count() == 2
    got = {r.column_name: r for r in ps.profile_of(states).collect()}
    assert (got["x.y"].unique_estimate, got["x.y"].max_value, got["x.y"].quantiles) == (2, "NaN", [0.0, 0.0, 0.0])
    assert (got["text"].unique_estimate, got["text"].null_count, got["n"].min_value) == (1, 1, None)
    for empty in (states.limit(0), ps.profile_states(rows_of(spark, []), "day", COLUMNS)):
        assert {(r.total_count, r.filled_count, r.unique_estimate, r.quantiles) for r in ps.profile_of(empty).collect()} == {(0, 0, 0, None)}
    with pytest.raises(ValueError):
        ps.profile_states(rows_of(spark, []), "day", [])
