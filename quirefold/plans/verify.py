"""The main pipeline: two folders of papers in, all comparison tables out."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..operators import gates
from ..operators.diff import Comparison
from ..operators.html import html_papers
from ..operators.tex import tex_papers
from ..sources.files import chosen, html_files, read_deviations, tex_files


def verify(spark: SparkSession, tex_dir: str, html_dir: str, deviations: str | None = None, papers: list[int] | None = None, *, strict: bool = False) -> Comparison:
    """Both folders extracted and compared; the tables made of it are computed as they are used.

    Chosen ``papers`` are picked by file name, so no other file is parsed.  ``strict``
    raises ``gates.GateError`` if a paper hasn't exactly one file on each side, can't be
    parsed, or lost verses on the way.
    """
    left, right = chosen(tex_files(spark, tex_dir), papers), chosen(html_files(spark, html_dir), papers)
    if strict:
        gates.enforce(gates.file_gate(left, right))
    found = Comparison(tex_papers(left), html_papers(right), read_deviations(spark, deviations))
    if strict:
        gates.enforce(gates.parse_gate(found).unionByName(gates.recount_gate(left, right, found)))
    return found
