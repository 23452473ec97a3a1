"""Profile states of days, united."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from tablewright.operators import sketches

DAYS = [date(2024, 1, d) for d in (1, 2, 3)]


@pytest.fixture(scope="module")
def rows(spark):
    draw = random.Random(5)
    data = [(k, draw.gauss(0, 10) if k % 10 else None, draw.choice("aaabbc") if k % 7 else None, str(k % 3000), k % 3) for k in range(20_000)]
    return spark.createDataFrame(data, "k long, x double, s string, t string, day int")


def test_three_united_days_are_within_bounds(spark, rows, database):
    name = f"{database}.states"
    for n, day in enumerate(DAYS):
        sketches.keep(sketches.state(rows.where(F.col("day") == n), ["k", "x", "s", "t"]), name, day)
    sketches.keep(sketches.state(rows.where("day = 1"), ["k", "x", "s", "t"]), name, DAYS[1])  # a day again replaces itself
    got = {r.ColumnName: r for r in sketches.profile_of(spark, name, DAYS[0], DAYS[2]).collect()}
    held = rows.collect()
    for c in "kxst":
        values = [r[c] for r in held if r[c] is not None]
        assert (got[c].TotalRecords, got[c].TotalValues, got[c].Nulls) == (20_000, len(values), 20_000 - len(values))
        assert abs(got[c].DistinctCount - len(set(values))) <= 0.03 * len(set(values))
    for c in "kx":
        values = sorted(r[c] for r in held if r[c] is not None)
        assert (got[c].Min, got[c].Max) == (values[0], values[-1]) and got[c].Mean == pytest.approx(sum(values) / len(values))
        for q, share in sketches.QUARTILES.items():
            assert abs(sum(v <= got[c][q] for v in values) / len(values) - share) <= 0.01
    counted = {v: sum(r.s == v for r in held) for v in "abc"}
    assert {r["item"]: r["count"] for r in got["s"].Frequent} == counted | {None: sum(r.s is None for r in held)} or \
        {r["item"]: r["count"] for r in got["s"].Frequent} == counted
    some = {r.ColumnName: r for r in sketches.profile_of(spark, name, DAYS[1], DAYS[1]).collect()}
    assert some["k"].TotalRecords == sum(r.day == 1 for r in held)


def test_states_unite_again_and_the_scan_is_one(spark, rows):
    days = [sketches.state(rows.where(F.col("day") == n), ["k", "s"]) for n in range(3)]
    assert days[0]._jdf.queryExecution().executedPlan().toString().count("Scan") == 1
    twice = sketches.united(sketches.united(days[0].unionByName(days[1])).unionByName(days[2]))
    once = sketches.united(days[0].unionByName(days[1]).unionByName(days[2]))
    a, b = ({r.ColumnName: (r.TotalRecords, r.TotalValues) for r in sketches.figures(s).collect()} for s in (twice, once))
    assert a == b == {"k": (20_000, 20_000), "s": (20_000, a["s"][1])}


def test_columns_without_values(spark):
    empty = spark.createDataFrame([(None, None), (None, None)], "x double, s string")
    got = {r.ColumnName: r for r in sketches.figures(sketches.united(sketches.state(empty))).collect()}
    assert (got["x"].DistinctCount, got["x"].Mean, got["x"]["50%"], got["x"].Nulls) == (0, None, None, 2)
    assert got["s"].DistinctCount == 0
    none = {r.ColumnName: r.TotalRecords for r in sketches.figures(sketches.united(sketches.state(empty.where("false")))).collect()}
    assert none == {"x": 0, "s": 0}
    with pytest.raises(ValueError):
        sketches.state(spark.createDataFrame([(True,)], "b boolean"))
