"""Registered queries over the driver's tables, with the SQL that gives the same rows.

The engine's own inputs (papers, boxes) aren't among those tables, so each operator
runs over the closest table, whole; where a query needs marks that the data lack
(odd glyphs, typed dashes, markup), it puts them in by a fixed rule.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import checks, diff, layout, summary, tex
from ..operators.html import drop_floaters, html_papers
from . import editions, pages

NO_SPANS = "cast(array() as array<struct<s:int,e:int>>)"


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "documents")


def _glyphed(c: str = "text"):
    marked = F.replace(F.col(c), F.lit("a "), F.lit("a\u00a0"))
    return F.replace(F.replace(marked, F.lit("e. "), F.lit("e.\u202f ")), F.lit("th"), F.lit("t\u02bch"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", "source", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def _editions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Lines as verses, and the same with all lines of every 7th document gone and the first line of every 5th changed."""
    v = _lines(spark, sf_dir).select(F.col("doc_id").alias("paper"), F.lit(0).alias("section"), F.col("line_no").alias("verse"), F.col("line").alias("text"), F.expr(NO_SPANS).alias("italics"), "source")
    right = v.where("paper % 7 <> 0").withColumn("text", F.when((F.col("paper") % 5 == 0) & (F.col("verse") == 0), F.concat(F.lit("X"), "text")).otherwise(F.col("text")))
    return v, right


def _deviations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines 0 to 1 of the documents with id 3 modulo 10, and line 0 of those with 5 modulo 20, are accepted."""
    ids = _docs(spark, sf_dir).select(F.col("doc_id").alias("paper"))
    a = ids.where("paper % 10 = 0").select("paper", F.lit(0).alias("section"), F.explode(F.sequence(F.lit(0), F.lit(1))).alias("verse"))
    b = ids.where("paper % 21 = 7").select("paper", F.lit(0).alias("section"), F.lit(0).alias("verse"))
    return a.unionByName(b).distinct().select("*", F.lit(True).alias("skip"), F.lit(False).alias("ignore_italics"))


def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", tx.normalize(_glyphed()).alias("clean"))


def suspicious_glyphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", F.explode(tx.suspicious(_glyphed())).alias("glyph", "n"))


def dash_tie_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = F.replace(F.replace(F.replace(F.col("text"), F.lit(", "), F.lit("---")), F.lit(". "), F.lit(" ~$ ")), F.lit("the "), F.lit("the--"))
    return _docs(spark, sf_dir).select("doc_id", tx.typeset(typed).alias("clean"))


def line_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).select("doc_id", "line_no", "line")


def keyed_full_outer_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = _editions(spark, sf_dir)
    none = _deviations(spark, sf_dir).limit(0)
    c = diff.compare_verses(left, right, none)
    return c.select("paper", "verse", "status")


def allowlist_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = _editions(spark, sf_dir)
    c = diff.compare_verses(left, right, _deviations(spark, sf_dir))
    return c.where("not skip and status <> 'same'").select("paper", "verse", "status")


def mismatch_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = _editions(spark, sf_dir)
    c = diff.compare_verses(left, right, _deviations(spark, sf_dir)).where("not skip and status <> 'same'")
    found = summary.by_kind(c.select(F.col("status").alias("kind"), "paper", "section", "verse"))
    return found.select("kind", "n", F.array_join("examples", " ").alias("examples"))


def summary_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = _editions(spark, sf_dir)
    c = diff.compare_verses(left, right, _deviations(spark, sf_dir))
    per = c.groupBy("paper").agg(F.count_if(F.col("status") == "same").alias("same"), F.count_if(~F.col("skip") & (F.col("status") != "same")).alias("bad"))
    s = per.join(_docs(spark, sf_dir).select(F.col("doc_id").alias("paper"), "source"), "paper")
    return s.groupBy("source").agg(F.count("*").alias("papers"), F.count_if(F.col("bad") == 0).alias("clean"), F.count_if(F.col("bad") > 0).alias("failed"), F.sum("same").alias("same_lines"), F.sum("bad").alias("bad_lines"))


def duplicate_keys_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _t(spark, sf_dir, "conversations").select("conv_id", "turn", "text", F.lit(0).alias("ord"))
    both = c.unionByName(c.where("turn % 2 = 0").select("conv_id", "turn", F.concat("text", F.lit("!")).alias("text"), F.lit(1).alias("ord")))
    both = both.withColumn("place", F.struct("ord", "text"))
    return diff.last_wins(both, "place", ["conv_id", "turn"]).select("conv_id", "turn", F.length("text").alias("n_chars"), F.col("ord").alias("version"), "repeats")


def floater_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _t(spark, sf_dir, "conversations").withColumn("floater", (F.col("turn") % 3 == 2) | (F.col("conv_id") % 4 == 0)).withColumn("k", F.floor(F.col("turn") / 2))
    return drop_floaters(c, ["conv_id", "k"]).select("conv_id", "turn", "floater")


def combined_key_remap(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _t(spark, sf_dir, "orders").select((F.col("o_custkey") % 100).alias("paper"), (F.col("o_orderkey") % 7).alias("section"))
    s = spark.range(100).where("id % 2 = 0").select(F.col("id").alias("paper"), F.explode(F.array(F.struct(F.lit(2).alias("n"), F.lit(3).alias("w")), F.struct(F.lit(3).alias("n"), F.lit(2).alias("w")))).alias("x")).select("paper", F.col("x.n").cast("long").alias("n"), F.lit(True).alias("combined"), F.col("x.w").cast("long").alias("combined_with"))
    return diff.remap_combined(v, s).groupBy("paper", "section").agg(F.count("*").alias("n"))


def section_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("doc").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    e = _t(spark, sf_dir, "events").withColumn("doc", F.col("user_id") % 97).withColumn("title", F.col("event_type") == "signup").withColumn("section", F.sum(F.col("title").cast("int")).over(w))
    return e.where("not title").groupBy("doc", "section").agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"))


def block_islands_per_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    e = _t(spark, sf_dir, "events").withColumn("span", F.col("event_type") == "purchase").withColumn("block", F.sum(F.col("span").cast("int")).over(w))
    return e.where("not span").groupBy("user_id", "block").agg(F.count("*").alias("n"))


def prev_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    before = F.lag(tx.half_even(F.col("value"))).over(w)
    return _t(spark, sf_dir, "events").select("event_id", F.when(before.isNotNull(), 623 - before).otherwise(0).alias("gap"))


def parity_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _t(spark, sf_dir, "events").select((F.col("user_id") % 2).alias("parity"), tx.half_even(F.col("value")).alias("x"), "event_id").where("x is not null")
    counts = e.groupBy("parity", "x").agg(F.count("*").alias("n"), F.min("event_id").alias("seen"))
    return counts.groupBy("parity").agg(F.max_by(F.struct("x", "n"), F.struct("n", -F.col("seen"))).alias("b")).select("parity", F.col("b.x").alias("x"), F.col("b.n").alias("n"))


def argmax_first_tie(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = F.max(F.struct("l_quantity", (-F.col("l_linenumber")).alias("k"), "l_partkey"))
    return _t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(best.alias("b")).select("l_orderkey", F.col("b.l_quantity").alias("quantity"), (-F.col("b.k")).alias("line"))


def first_second_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = _t(spark, sf_dir, "events").withColumn("k", F.row_number().over(w)).withColumn("next_id", F.lead("event_id").over(w))
    return e.where("k = 1 and next_id is not null").select("user_id", (F.col("next_id") - F.col("event_id")).alias("gap"))


def adjacent_gap_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    li = _t(spark, sf_dir, "lineitem").withColumn("next_q", F.lead("l_quantity").over(w))
    return li.groupBy("l_orderkey").agg(F.bool_or(F.coalesce(F.col("next_q") - F.col("l_quantity") > 12, F.lit(False))).alias("any_gap"))


def line_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _t(spark, sf_dir, "events").where("value is not null").select((F.col("user_id") % 50).alias("page"), tx.half_even(F.col("value")).alias("y"), F.col("event_id").alias("x"), F.col("event_type").alias("t"))
    words = F.array_sort(F.collect_list(F.struct("x", "t")))
    return e.groupBy("page", "y").agg(F.array_join(F.transform(words, lambda w: w["t"]), " ").alias("line"), F.min("x").alias("x_min"), F.max("x").alias("x_max"))


def suffix_theta_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir).select("doc_id", "line_no", F.col("line").alias("text"))
    b = _t(spark, sf_dir, "benchmark").select(F.right("text", 8 + F.col("item_id") % 5).alias("target"))
    short = _docs(spark, sf_dir).select(F.right("text", F.lit(5)).alias("target")).distinct()
    return layout.ends_with(lines, b.unionByName(short)).groupBy("target").agg(F.count("*").alias("n"))


def range_dimension_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _t(spark, sf_dir, "part").select((F.col("p_size") * 4 - 4).alias("paper"))
    return layout.part_of(p).groupBy(F.coalesce("part", F.lit(0)).alias("part")).agg(F.count("*").alias("n"))


def anti_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = lambda df: df.select(F.explode(F.split("text", "[ \n]+")).alias("word"))
    used = words(_docs(spark, sf_dir)).groupBy("word").agg(F.count("*").alias("n"))
    return used.join(words(_t(spark, sf_dir, "benchmark")).distinct(), "word", "left_anti")


def digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.sha2(F.concat_ws("|", "o_orderkey", "o_custkey", "o_orderstatus"), 256)
    return _t(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.sum(F.conv(F.substring(d, 1, 12), 16, 10).cast("decimal(38,0)")).cast("string").alias("digest"), F.count("*").alias("n"))


def _tex_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(paper, k, body): non-blank lines without characters that are markup on either side."""
    body = F.trim(F.translate("line", "\\{}[]%$~&<>-", " " * 12))
    return _lines(spark, sf_dir).select(F.col("doc_id").cast("int").alias("paper"), (F.col("line_no") + 1).alias("k"), F.regexp_replace(body, " +", " ").alias("body")).where("body <> ''")


def verify_editions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a paper in both markups, extracted, compared and summed up; the second edition has known damage."""
    lines = _tex_source(spark, sf_dir)
    p = F.col("paper")
    verse = F.concat(F.lit("\\vs p"), F.format_string("%03d", p), F.lit(" 1:"), F.col("k"), F.lit(" \\pc "), F.col("body"))
    texts = lines.groupBy("paper").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", verse.alias("v")))), lambda x: x["v"]), "\n").alias("vs"))
    tex_src = texts.select(F.format_string("p%03d.tex", p).alias("path"), F.concat(F.lit("\\upaper{"), p, F.lit("}{Title}\n\\usection{Heading}\n"), "vs").alias("src"))
    changed = F.when((p % 5 == 0) & (F.col("k") == 1), F.concat(F.lit("X"), "body")).otherwise(F.col("body"))
    para = F.concat(F.lit('<p id="U'), p, F.lit("_1_"), F.col("k"), F.lit('"><small>1:1</small>'), changed, F.lit("</p>"))
    kept = lines.where((p % 7 != 0) | (F.col("k") != 1)).groupBy("paper").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", para.alias("v")))), lambda x: x["v"]), "\n").alias("ps"))
    html_src = texts.select("paper").join(kept, "paper", "left").select(F.format_string("Paper%03d.html", p).alias("path"), F.concat(F.lit('<h1 id="U'), p, F.lit('_0_0">Paper 1. Title</h1><h2 id="U'), p, F.lit('_1_0">1. Heading</h2>'), F.coalesce("ps", F.lit(""))).alias("src"))
    none = spark.createDataFrame([], "paper int, section int, verse int, skip boolean, ignore_italics boolean")
    c = diff.Comparison(tex.tex_papers(tex_src), html_papers(html_src), none)
    return summary.paper_summary(c).select("paper", "left_verses", "right_verses", "common", "only_left", "only_right", "text_diffs", "mismatches", "status")


def _page_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as pages, items as body words of the left or the right column."""
    left = F.col("l_quantity") < 25
    li = _t(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") % 211).cast("string").alias("doc"), (F.col("l_orderkey") + 1).cast("int").alias("page"), F.lit(0).alias("flow"), F.lit(0).alias("block"), F.col("l_linenumber").alias("line"), F.lit(0).alias("word"),
        F.concat(F.lit("p"), "l_partkey").alias("text"), F.when(left, 60.0).otherwise(250.0).alias("xMin"), F.when(left, 200.0).otherwise(400.0).alias("xMax"), (F.col("l_linenumber") * 11 + 90.0).alias("yMin"), (F.col("l_linenumber") * 11 + 100.0).alias("yMax"),
    )
    return li


def unbalanced_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.unbalanced(_page_words(spark, sf_dir))[0].select("doc", "page", "left_y", "right_y", "diff")


def page_maximum_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = layout.page_summary(_page_words(spark, sf_dir)).where("n_lines > 0")
    return s.select("doc", "page", "max_body", "n_lines", F.col("first.y").alias("first_y"))


class _Headings(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.level, self.text, self.found = "", "", []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ("h1", "h2", "h3") and not self.level:
            self.level, self.text = tag, ""

    def handle_endtag(self, tag: str) -> None:
        if tag == self.level:
            self.found.append((tag, self.text))
            self.level = ""

    def handle_data(self, data: str) -> None:
        if self.level:
            self.text += data


def html_extract_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    def run(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            out = []
            for i, html in zip(pdf["page_id"], pdf["html"], strict=True):
                h = _Headings()
                h.feed(html or "")
                out += [(i, k, *x) for k, x in enumerate(h.found)]
            yield pd.DataFrame(out, columns=["page_id", "k", "level", "heading"])

    return _t(spark, sf_dir, "pages").select("page_id", "html").mapInPandas(run, "page_id long, k int, level string, heading string")


def opcode_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = _editions(spark, sf_dir)
    c = diff.compare_verses(left, right, _deviations(spark, sf_dir).limit(0))
    return diff.text_changes(c).select("paper", "verse", "tag", "i1", "i2", "j1", "j2", "before", "left", "right", "after")


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir).select("doc_id", F.concat(F.replace(F.col("text"), F.lit("the "), F.lit("\\hyp{}the ")), F.lit("\n")).alias("src"))
    t = tex.token_table(docs, id_col="doc_id")
    return t.groupBy("doc_id", "kind").agg(F.count("*").alias("n"))


def macro_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words as macros: how often each of four is used and whether the table knows it."""
    marked = F.replace(F.col("text"), F.lit("%"), F.lit(" "))
    for word, macro in (("the ", "\\par "), ("and ", "\\mystery "), ("de ", "\\ldots ")):
        marked = F.replace(marked, F.lit(word), F.lit(macro))
    docs = _docs(spark, sf_dir).select(F.col("doc_id").alias("path"), marked.alias("src"))
    return summary.macro_coverage(tex.token_table(docs)).select("rank", "value", "n", "known")


def seeded_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _lines(spark, sf_dir).select(F.col("doc_id").alias("paper"), F.lit(0).alias("section"), F.col("line_no").alias("verse"))
    return checks.sample_keys(v, 20)


FUNCTIONS = [
    normalize_text, suspicious_glyphs, dash_tie_cleanup, line_explode, keyed_full_outer_diff, allowlist_diff, mismatch_buckets, summary_totals, duplicate_keys_last_wins, floater_resolution, combined_key_remap,
    section_islands, block_islands_per_page, prev_gap, parity_mode, argmax_first_tie, first_second_gap, adjacent_gap_any, line_rebuild, suffix_theta_join, range_dimension_join, anti_unknown, digest,
    verify_editions, unbalanced_columns, page_maximum_body, html_extract_headings, opcode_diff, token_counts, macro_coverage, seeded_sample,
]


def queries() -> dict:
    return {f.__name__: f for f in [*FUNCTIONS, *pages.FUNCTIONS, *editions.FUNCTIONS]}


_SPACES = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
_GLYPHED = "replace(replace(replace(text, 'a ', 'a' || chr(160)), 'e. ', 'e.' || chr(8239) || ' '), 'th', 't' || chr(700) || 'h')"
_LINES = "lines AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS INTEGER) AS line_no FROM documents)"


def _clean(x: str) -> str:
    return f"trim(regexp_replace({x}, '{_SPACES}', ' ', 'g'))"


_BOTH = f"""{_LINES},
r AS (SELECT doc_id, line_no, CASE WHEN doc_id % 5 = 0 AND line_no = 0 THEN 'X' || line ELSE line END AS line FROM lines WHERE doc_id % 7 <> 0),
c AS (SELECT l.doc_id AS paper, l.line_no AS verse, l.source,
  CASE WHEN r.doc_id IS NULL THEN 'only_left' WHEN {_clean('l.line')} <> {_clean('r.line')} THEN 'text' ELSE 'same' END AS status,
  ((l.doc_id % 10 = 0 AND l.line_no <= 1) OR (l.doc_id % 21 = 7 AND l.line_no = 0)) AS skip
  FROM lines l LEFT JOIN r ON l.doc_id = r.doc_id AND l.line_no = r.line_no)"""
_BODY = "trim(regexp_replace(trim(translate(line, '\\{}[]%$~&<>-', '            ')), ' +', ' ', 'g'))"

ORACLE = {
    "normalize_text": f"SELECT doc_id, {_clean(f'''translate(nfc_normalize({_GLYPHED}), chr(700) || chr(160) || chr(8239) || chr(8201), chr(8217) || '   ')''')} AS clean FROM documents",
    "suspicious_glyphs": f"""WITH t AS (SELECT doc_id, {_GLYPHED} AS x FROM documents),
g AS (SELECT * FROM (VALUES ('NBSP', chr(160)), ('NARROW_NBSP', chr(8239)), ('THIN_SPACE', chr(8201)), ('MODIFIER_APOSTROPHE', chr(700))) v(glyph, ch))
SELECT doc_id, glyph, CAST(length(x) - length(replace(x, ch, '')) AS INTEGER) AS n FROM t, g WHERE length(x) > length(replace(x, ch, ''))""",
    "dash_tie_cleanup": f"SELECT doc_id, {_clean('''replace(replace(replace(replace(replace(replace(replace(text, ', ', '---'), '. ', ' ~$ '), 'the ', 'the--'), '---', chr(8212)), '--', chr(8211)), '~', ' '), '$', '')''')} AS clean FROM documents",
    "line_explode": f"WITH {_LINES} SELECT doc_id, line_no, line FROM lines",
    "keyed_full_outer_diff": f"WITH {_BOTH} SELECT paper, verse, status FROM c",
    "allowlist_diff": f"WITH {_BOTH} SELECT paper, verse, status FROM c WHERE NOT skip AND status <> 'same'",
    "mismatch_buckets": f"""WITH {_BOTH}, k AS (SELECT status AS kind, paper || ':0:' || verse AS key, row_number() OVER (PARTITION BY status ORDER BY paper, verse) AS n FROM c WHERE NOT skip AND status <> 'same')
SELECT kind, count(*) AS n, string_agg(key, ' ' ORDER BY k.n) FILTER (WHERE k.n <= 8) AS examples FROM k GROUP BY kind""",
    "summary_totals": f"""WITH {_BOTH}, p AS (SELECT paper, any_value(source) AS source, count(*) FILTER (WHERE status = 'same') AS same, count(*) FILTER (WHERE NOT skip AND status <> 'same') AS bad FROM c GROUP BY paper)
SELECT source, count(*) AS papers, count(*) FILTER (WHERE bad = 0) AS clean, count(*) FILTER (WHERE bad > 0) AS failed, CAST(sum(same) AS BIGINT) AS same_lines, CAST(sum(bad) AS BIGINT) AS bad_lines FROM p GROUP BY source""",
    "duplicate_keys_last_wins": """WITH b AS (SELECT conv_id, turn, text, 0 AS ord FROM conversations UNION ALL SELECT conv_id, turn, text || '!', 1 FROM conversations WHERE turn % 2 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY ord DESC, text DESC) AS k, count(*) OVER (PARTITION BY conv_id, turn) AS m FROM b)
SELECT conv_id, turn, CAST(length(text) AS INTEGER) AS n_chars, ord AS version, m - 1 AS repeats FROM r WHERE k = 1""",
    "floater_resolution": """WITH c AS (SELECT conv_id, turn, (turn % 3 = 2 OR conv_id % 4 = 0) AS floater, turn // 2 AS k FROM conversations),
p AS (SELECT *, bool_or(NOT floater) OVER (PARTITION BY conv_id, k) AS has_plain FROM c)
SELECT conv_id, turn, floater FROM p WHERE NOT (floater AND has_plain)""",
    "combined_key_remap": """SELECT o_custkey % 100 AS paper, CASE WHEN (o_custkey % 100) % 2 = 0 AND o_orderkey % 7 IN (2, 3) THEN 3 ELSE o_orderkey % 7 END AS section, count(*) AS n FROM orders GROUP BY 1, 2""",
    "section_islands": """WITH e AS (SELECT user_id % 97 AS doc, event_id, event_type = 'signup' AS title, CAST(sum(CAST(event_type = 'signup' AS INTEGER)) OVER (PARTITION BY user_id % 97 ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS section FROM events)
SELECT doc, section, count(*) AS n, min(event_id) AS first_id FROM e WHERE NOT title GROUP BY doc, section""",
    "block_islands_per_page": """WITH e AS (SELECT user_id, event_type = 'purchase' AS span, CAST(sum(CAST(event_type = 'purchase' AS INTEGER)) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS block FROM events)
SELECT user_id, block, count(*) AS n FROM e WHERE NOT span GROUP BY user_id, block""",
    "prev_gap": "SELECT event_id, CAST(coalesce(623 - lag(CAST(round_even(value, 0) AS INTEGER)) OVER (PARTITION BY user_id ORDER BY ts, event_id), 0) AS INTEGER) AS gap FROM events",
    "parity_mode": """WITH c AS (SELECT user_id % 2 AS parity, CAST(round_even(value, 0) AS INTEGER) AS x, count(*) AS n, min(event_id) AS seen FROM events WHERE value IS NOT NULL GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY parity ORDER BY n DESC, seen) AS k FROM c) SELECT parity, x, n FROM r WHERE k = 1""",
    "argmax_first_tie": """WITH r AS (SELECT l_orderkey, l_quantity, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_linenumber) AS k FROM lineitem)
SELECT l_orderkey, l_quantity AS quantity, l_linenumber AS line FROM r WHERE k = 1""",
    "first_second_gap": """WITH r AS (SELECT user_id, event_id, row_number() OVER w AS k, lead(event_id) OVER w AS next_id FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, next_id - event_id AS gap FROM r WHERE k = 1 AND next_id IS NOT NULL""",
    "adjacent_gap_any": """WITH r AS (SELECT l_orderkey, l_quantity, lead(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS q FROM lineitem)
SELECT l_orderkey, bool_or(coalesce(q - l_quantity > 12, false)) AS any_gap FROM r GROUP BY l_orderkey""",
    "line_rebuild": """SELECT user_id % 50 AS page, CAST(round_even(value, 0) AS INTEGER) AS y, string_agg(event_type, ' ' ORDER BY event_id) AS line, min(event_id) AS x_min, max(event_id) AS x_max FROM events WHERE value IS NOT NULL GROUP BY 1, 2""",
    "suffix_theta_join": f"""WITH {_LINES}, t AS (SELECT DISTINCT target FROM (SELECT right(text, 8 + item_id % 5) AS target FROM benchmark UNION ALL SELECT right(text, 5) FROM documents) WHERE length(target) > 0),
n AS (SELECT DISTINCT length(target) AS n FROM t),
m AS (SELECT right(line, n) AS target FROM lines, n WHERE length(line) >= n) SELECT target, count(*) AS n FROM m JOIN t USING (target) GROUP BY target""",
    "range_dimension_join": """SELECT CASE WHEN p BETWEEN 1 AND 31 THEN 1 WHEN p BETWEEN 32 AND 56 THEN 2 WHEN p BETWEEN 57 AND 119 THEN 3 WHEN p BETWEEN 120 AND 196 THEN 4 ELSE 0 END AS part, count(*) AS n FROM (SELECT p_size * 4 - 4 AS p FROM part) GROUP BY 1""",
    "anti_unknown": """WITH u AS (SELECT unnest(regexp_split_to_array(text, '[ \\n]+')) AS word FROM documents), b AS (SELECT DISTINCT unnest(regexp_split_to_array(text, '[ \\n]+')) AS word FROM benchmark)
SELECT word, count(*) AS n FROM u ANTI JOIN b USING (word) GROUP BY word""",
    "digest": """SELECT o_orderpriority, CAST(sum(CAST(('0x' || substr(sha256(o_orderkey || '|' || o_custkey || '|' || o_orderstatus), 1, 12)) AS BIGINT)) AS VARCHAR) AS digest, count(*) AS n FROM orders GROUP BY 1""",
    "verify_editions": f"""WITH {_LINES}, v AS (SELECT CAST(doc_id AS INTEGER) AS paper, line_no + 1 AS k FROM lines WHERE {_BODY} <> ''),
p AS (SELECT paper, count(*) AS n, count(*) FILTER (WHERE k = 1) AS f FROM v GROUP BY paper),
q AS (SELECT paper, n, CASE WHEN paper % 7 = 0 THEN f ELSE 0 END AS lost, CASE WHEN paper % 7 <> 0 AND paper % 5 = 0 THEN f ELSE 0 END AS changed FROM p)
SELECT paper, n AS left_verses, n - lost AS right_verses, n - lost AS common, lost AS only_left, CAST(0 AS BIGINT) AS only_right, changed AS text_diffs, lost + changed AS mismatches, CASE WHEN lost + changed = 0 THEN 'CLEAN' ELSE 'FAIL' END AS status FROM q""",
    "unbalanced_columns": """WITH w AS (SELECT CAST(l_orderkey % 211 AS VARCHAR) AS doc, CAST(l_orderkey + 1 AS INTEGER) AS page, 100 + 11 * l_linenumber AS y, l_quantity < 25 AS is_left FROM lineitem),
e AS (SELECT doc, page, max(y) FILTER (WHERE is_left) AS left_y, max(y) FILTER (WHERE NOT is_left) AS right_y FROM w GROUP BY doc, page)
SELECT doc, page, left_y, right_y, abs(left_y - right_y) AS diff FROM e WHERE abs(left_y - right_y) > 5""",
    "page_maximum_body": """SELECT CAST(l_orderkey % 211 AS VARCHAR) AS doc, CAST(l_orderkey + 1 AS INTEGER) AS page, max(100 + 11 * l_linenumber) AS max_body, count(DISTINCT l_linenumber) AS n_lines, min(100 + 11 * l_linenumber) AS first_y FROM lineitem GROUP BY 1, 2""",
    # a reference may lack its semicolon, as the parser and browsers read it
    "html_extract_headings": """WITH h AS (SELECT page_id, regexp_extract_all(regexp_replace(html, '(?s)<script.*?</script>|<!--.*?-->|<style.*?</style>', '', 'g'), '(?s)<h[1-3]\\b[^>]*>.*?</h[1-3]>') AS found FROM pages),
x AS (SELECT page_id, unnest(found) AS e, generate_subscripts(found, 1) - 1 AS k FROM h)
SELECT page_id, CAST(k AS INTEGER) AS k, substr(e, 2, 2) AS level, regexp_replace(regexp_replace(replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(e, '<[^>]*>', '', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&quot;?', '"', 'g'), '&#39;', chr(39)), '&#39([^0-9]|$)', chr(39) || '\\1', 'g'), '&amp;?', '&', 'g') AS heading FROM x""",
    # in texts of 200 characters on, those that make up over a hundredth are no anchors: without any anchor all is replaced
    "opcode_diff": f"""WITH {_BOTH}, e AS (SELECT doc_id, {_clean('line')} AS t FROM lines WHERE doc_id % 5 = 0 AND doc_id % 7 <> 0 AND line_no = 0),
w AS (SELECT doc_id, unnest(string_split(t, '')) AS ch FROM e), n AS (SELECT doc_id, ch, count(*) + CAST(ch = 'X' AS INTEGER) AS n FROM w GROUP BY 1, 2), z AS (SELECT doc_id, min(n) AS rarest FROM n GROUP BY 1),
f AS (SELECT e.*, length(t) + 1 >= 200 AND rarest > (length(t) + 1) // 100 + 1 AS whole FROM e LEFT JOIN z USING (doc_id))
SELECT doc_id AS paper, CAST(0 AS INTEGER) AS verse, CASE WHEN whole THEN 'replace' ELSE 'insert' END AS tag, CAST(0 AS INTEGER) AS i1, CAST(CASE WHEN whole THEN length(t) ELSE 0 END AS INTEGER) AS i2, CAST(0 AS INTEGER) AS j1, CAST(CASE WHEN whole THEN length(t) + 1 ELSE 1 END AS INTEGER) AS j2,
'' AS before, CASE WHEN whole THEN t ELSE '' END AS "left", CASE WHEN whole THEN 'X' || t ELSE 'X' END AS "right", CASE WHEN whole THEN '' ELSE substr(t, 1, 20) END AS after FROM f""",
    "token_counts": r"""WITH t AS (SELECT doc_id, replace(text, 'the ', '\hyp{}the ') || chr(10) AS x FROM documents),
u AS (SELECT doc_id, unnest(regexp_extract_all(x, '\\hyp|[{}\[\]]|%[^\n]*|\n|[^\\{}\[\]%\n]+')) AS tok FROM t)
SELECT doc_id, CASE substr(tok, 1, 1) WHEN '\' THEN 'MACRO' WHEN '{' THEN 'OPEN_BRACE' WHEN '}' THEN 'CLOSE_BRACE' WHEN '[' THEN 'OPEN_BRACKET' WHEN ']' THEN 'CLOSE_BRACKET' WHEN '%' THEN 'COMMENT' WHEN chr(10) THEN 'NEWLINE' ELSE 'TEXT' END AS kind, count(*) AS n FROM u GROUP BY 1, 2""",
    "seeded_sample": f"""WITH {_LINES} SELECT doc_id AS paper, CAST(0 AS INTEGER) AS section, line_no AS verse FROM lines ORDER BY md5('42:' || doc_id || ':0:' || line_no), paper, verse LIMIT 20""",
    "macro_coverage": """WITH t AS (SELECT doc_id, replace(replace(replace(replace(text, '%', ' '), 'the ', '\\par '), 'and ', '\\mystery '), 'de ', '\\ldots ') AS x FROM documents),
m AS (SELECT doc_id, unnest(list_transform(string_split(x, '\\')[2:], lambda s: regexp_extract(s, '^[\\pL]+'))) AS value, generate_subscripts(string_split(x, '\\')[2:], 1) AS i FROM t),
c AS (SELECT value, count(*) AS n, min((doc_id, i)) AS first FROM m GROUP BY value)
SELECT row_number() OVER (ORDER BY n DESC, first) AS rank, value, n, value IN ('par', 'ldots') AS known FROM c""",
}


def oracle_sql() -> dict[str, str]:
    return ORACLE | pages.ORACLE | editions.ORACLE
