"""Places and running values in one order over any number of rows, without a window over one partition.

Rows are dealt out by ranges of the order and written once with their place within
their range.  What the ranges add up to, one row for each range, comes to the driver;
each row then gets what the ranges before its own hold.  So a document, or a table,
of any length is worked on by as many tasks as it has ranges.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import stored

#: Bits that a row's place within its range takes, as Spark's row ids have them.
PLACE_BITS = 33


def in_order(df: DataFrame, *order: Column | str, parts: int | None = None) -> DataFrame:
    """df in ``parts`` ranges of ``order``, written, with ``__part`` (the range) and ``__place`` (the row's place in it, from 0)."""
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    kept = stored(spread, "in-order")
    return kept.withColumn("__part", F.shiftright("__at", PLACE_BITS)).withColumn("__place", F.col("__at").bitwiseAND((1 << PLACE_BITS) - 1)).drop("__at")


def numbered(df: DataFrame, *order: Column | str, name: str = "place", parts: int | None = None) -> DataFrame:
    """df with ``name``: each row's place in ``order`` over all rows, from 0."""
    kept = in_order(df, *order, parts=parts)
    sizes = sorted((r[0], r[1]) for r in kept.groupBy("__part").agg(F.max("__place") + 1).collect())
    before = list(accumulate((n for _, n in sizes), initial=0))[:-1]
    offsets = df.sparkSession.createDataFrame([(p, b) for (p, _), b in zip(sizes, before, strict=True)], "__part long, __before long")
    return kept.join(F.broadcast(offsets), "__part").withColumn(name, F.col("__before") + F.col("__place")).drop("__part", "__place", "__before")


def running(
    df: DataFrame, by: list[str], order: list[str], *, sums: dict[str, Column] | None = None, lasts: dict[str, Column] | None = None, previous: dict[str, Column] | None = None, parts: int | None = None
) -> DataFrame:
    """df with running values within ``by`` in ``order``, as windows give them, but with no group in one task.

    ``sums``: the sum up to and with a row.  ``lasts``: the last value up to and with a
    row that isn't null.  ``previous``: the value of the row before, null for the first.
    Rows of one ``by`` and ``order`` may come in any order among themselves.
    """
    sums, lasts, previous = sums or {}, lasts or {}, previous or {}
    held = {f"__{k}_{name}": c for k, group in (("s", sums), ("l", lasts), ("p", previous)) for name, c in group.items()}
    kept = in_order(df.withColumns(held), *by, *order, parts=parts)
    here = Window.partitionBy("__part", *by).orderBy("__place")
    upto = here.rowsBetween(Window.unboundedPreceding, 0)
    own = {f"__s_{n}": F.sum(f"__s_{n}").over(upto) for n in sums} | {f"__l_{n}": F.last(f"__l_{n}", ignorenulls=True).over(upto) for n in lasts} | {f"__q_{n}": F.lag(f"__p_{n}").over(here) for n in previous}
    # what each range holds of each group, and what the ranges before it hold: a row for each range that a group reaches into
    ends = kept.groupBy("__part", *by).agg(
        F.min("__place").alias("__first"), *[F.sum(f"__s_{n}").alias(f"__a_{n}") for n in sums],
        *[F.max_by(F.col(f"__l_{n}"), F.when(F.col(f"__l_{n}").isNotNull(), F.col("__place"))).alias(f"__b_{n}") for n in lasts],
        *[F.max_by(F.struct(f"__p_{n}"), "__place").alias(f"__c_{n}") for n in previous],
    )
    earlier = Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select(
        "__part", *by, "__first", *[F.sum(f"__a_{n}").over(earlier).alias(f"__a_{n}") for n in sums], *[F.last(f"__b_{n}", ignorenulls=True).over(earlier).alias(f"__b_{n}") for n in lasts],
        *[F.last(f"__c_{n}").over(earlier)[f"__p_{n}"].alias(f"__c_{n}") for n in previous],
    )
    keys = ["__part", *by]
    same = [F.col(f"k.{c}").eqNullSafe(F.col(f"v.{c}")) for c in keys]
    both = kept.withColumns(own).alias("k").join(carry.alias("v"), same, "left")
    plus = lambda a, b: F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)
    out = {n: plus(F.col(f"v.__a_{n}"), F.col(f"k.__s_{n}")) for n in sums} | {n: F.coalesce(f"k.__l_{n}", f"v.__b_{n}") for n in lasts}
    out |= {n: F.when(F.col("k.__place") == F.col("v.__first"), F.col(f"v.__c_{n}")).otherwise(F.col(f"k.__q_{n}")) for n in previous}
    return both.select(*[F.col(f"k.`{c}`") for c in df.columns], *[c.alias(n) for n, c in out.items()])
