"""Gates of a run: what has to hold before its findings count, and a strict mode that stops where it doesn't."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.files import file_problems, numbered_files
from .checks import recount
from .diff import Comparison


class GateError(RuntimeError):
    """A run's gates found something; ``problems`` has the first of it as rows."""

    def __init__(self, total: int, problems: list) -> None:
        super().__init__(f"{total} problems: " + "; ".join(f"{r.gate} {r.side} paper {r.paper}: {r.detail}" for r in problems))
        self.total, self.problems = total, problems


def file_gate(left: DataFrame, right: DataFrame) -> DataFrame:
    """Papers that either side has, without exactly one file on each: (gate, paper, side, detail)."""
    papers = numbered_files(left).select("paper").union(numbered_files(right).select("paper")).where("paper is not null").distinct()
    side = lambda files, name: file_problems(files, papers).select(F.lit("files").alias("gate"), "paper", F.lit(name).alias("side"), F.concat(F.col("n").cast("string"), F.lit(" files")).alias("detail"))
    return side(left, "left").unionAll(side(right, "right"))


def parse_gate(c: Comparison) -> DataFrame:
    """Papers that couldn't be parsed."""
    return c.errors().select(F.lit("parse").alias("gate"), "paper", "side", F.col("error").alias("detail"))


def recount_gate(left: DataFrame, right: DataFrame, c: Comparison) -> DataFrame:
    """Papers of which verses were lost, by counts that don't go through the parsers."""
    off = recount(left, right, c.left_verses, c.right_verses).where("not ok")
    short = F.col("tex_verses") < F.col("markers")
    told = F.when(short, F.concat_ws(" ", "tex_verses", F.lit("verses of"), "markers", F.lit("marks"))).otherwise(F.concat_ws(" ", "html_verses", F.lit("verses of"), "ids", F.lit("ids")))
    return off.select(F.lit("recount").alias("gate"), "paper", F.when(short, "left").otherwise("right").alias("side"), told.alias("detail"))


def problems(left: DataFrame, right: DataFrame, c: Comparison) -> DataFrame:
    """All that the gates find in a run over the files (path, src) of both sides: (gate, paper, side, detail)."""
    return file_gate(left, right).unionByName(parse_gate(c)).unionByName(recount_gate(left, right, c))


def enforce(found: DataFrame, shown: int = 20) -> None:
    """Raises GateError if there is any problem; only the first few and their number come to the driver."""
    first = found.orderBy("gate", "paper", "side").limit(shown).collect()
    if first:
        raise GateError(found.count(), first)
