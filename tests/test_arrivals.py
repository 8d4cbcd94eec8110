"""The current row of every key."""

from pyspark.sql import functions as F

from tillroll.sources.arrivals import ARRIVAL, ARRIVAL_TYPE, current


def test_last_arrival_holds_and_its_place_travels_once(spark):
    place = F.struct("at", "file", "block", "line").cast(ARRIVAL_TYPE)
    rows = spark.createDataFrame(
        [(1, None, "2024-01-02", "f", 0, 1, "z"), (1, None, "2024-01-03", "a", 0, 0, "b"), (1, None, "2024-01-03", "a", 0, 2, "a"),
         (1, 5, "2024-01-01", "f", 0, 0, None), (None, 5, "2024-01-01", "f", 0, 3, "n")],
        "k long, m long, at string, file string, block long, line long, v string").select("k", "m", place.alias(ARRIVAL), "v")
    last = current(rows, ["k", "m"])
    assert last.columns == rows.columns
    assert {(r.k, r.m): r.v for r in last.collect()} == {(1, None): "a", (1, 5): None, (None, 5): "n"} and last.count() == 3
    assert "max_by" not in last._jdf.queryExecution().executedPlan().toString()       # it would carry the place twice
