"""Verses as they arrive, against a stored edition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators.diff import KEY


def arriving_findings(stream: DataFrame, stored: DataFrame, deviations: DataFrame) -> DataFrame:
    """(paper, section, verse, status) of streamed verses that differ from the stored ones or have none.

    A stream-static left join: nothing is kept between batches, so no watermark is
    needed.  What only the stored edition has can't be told before the stream ends.
    """
    side = stored.select(*KEY, F.struct("text", "italics").alias("r"))
    flags = deviations.select(*KEY, "skip", "ignore_italics")
    j = stream.select(*KEY, F.struct("text", "italics").alias("l")).join(side, KEY, "left").join(flags, KEY, "left")
    clean = lambda c: tx.normalize_spans(F.col(f"{c}.text"), F.col(f"{c}.italics"))
    n = j.withColumn("nl", clean("l")).withColumn("nr", clean("r"))
    loose = F.coalesce("ignore_italics", F.lit(False))
    status = F.when(F.col("r").isNull(), "only_left").when(~F.col("nl.text").eqNullSafe(F.col("nr.text")), "text").when(~loose & ~F.col("nl.italics").eqNullSafe(F.col("nr.italics")), "italic")
    return n.where(~F.coalesce("skip", F.lit(False))).select(*KEY, status.alias("status")).where("status is not null")
