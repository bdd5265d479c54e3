"""Places and running values by ranges, against windows over whole groups."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quirefold.operators.ordered import in_order, numbered, running


@pytest.fixture(scope="module")
def table(spark):
    """One long group, many short ones, one without a name; nulls in the values."""
    rng = random.Random(3)
    rows = [("long", k, rng.choice([0, 1]), rng.choice([None, k])) for k in range(3000)] + [(f"g{k % 40}", k, k % 3, None) for k in range(400)] + [(None, k, 1, k) for k in range(50)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "g string, k int, x int, y int").repartition(5).persist()


@pytest.mark.parametrize("parts", [1, 8, 40])
def test_running_is_the_window(table, parts):
    w = Window.partitionBy("g").orderBy("k")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    want = table.select("*", F.sum("x").over(upto).alias("s"), F.sum("y").over(upto).alias("sy"), F.last("y", ignorenulls=True).over(upto).alias("l"), F.lag("y").over(w).alias("p"), F.lag("x").over(w).alias("q"))
    got = running(table, ["g"], ["k"], sums={"s": F.col("x"), "sy": F.col("y")}, lasts={"l": F.col("y")}, previous={"p": F.col("y"), "q": F.col("x")}, parts=parts)
    assert got.columns == want.columns and sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_a_long_group_lies_in_many_ranges(table):
    per = in_order(table, "g", "k", parts=8).where("g = 'long'").groupBy("__part").count()
    assert per.count() >= 6 and per.agg(F.max("count")).first()[0] < 1500


def test_numbered(table):
    got = numbered(table.where("g is not null"), F.desc("k"), "g", name="n", parts=7).orderBy("n").collect()
    assert [r.n for r in got] == list(range(len(got)))
    assert [(r.k, r.g) for r in got] == sorted(((r.k, r.g) for r in got), key=lambda x: (-x[0], x[1]))
    assert numbered(table.where("false"), "k", name="n").count() == 0


def test_empty(table):
    assert running(table.where("false"), ["g"], ["k"], sums={"s": F.col("x")}).collect() == []
