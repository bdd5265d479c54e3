"""Queries of the extractors, comparisons, reports and checks over papers made from ``documents``, with the SQL that gives the same rows.

Every document is a paper in both markups.  The second edition has planted damage, each
by a rule on the paper's number, so the SQL can tell what must be found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import checks, diff, gates, summary, tex
from ..operators.html import html_papers
from ..operators.ordered import numbered
from ..schemas import SPANS
from ..sources import files as fs
from ..sources.scratch import scratch, stored, write_files, write_lines


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _verses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(paper, k, body): non-blank lines without characters that are markup on either side."""
    lines = _t(spark, sf_dir, "documents").select(F.col("doc_id").cast("int").alias("paper"), F.posexplode(F.split("text", "\n")).alias("n", "line"))
    body = F.trim(F.regexp_replace("line", r"[\\{}\[\]%$~&<> -]+", " "))
    return lines.select("paper", (F.col("n") + 1).alias("k"), body.alias("body")).where("body <> ''")


def _joined(rows: DataFrame, keys: list[str], order: str, text: Column, name: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order, text.alias("x")))), lambda v: v["x"]), "\n").alias(name))


#: Fixed value: characters that are markup on either side, and spaces.
_MARKUP = r"\\{}\[\]%$~&<> -"


def _sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(paper, vs): each paper's verses (k, first: the first word, rest) in order.

    They are made where a document's row is, so that no text is moved or written; only
    documents that share a paper's number are gathered.
    """
    docs = _t(spark, sf_dir, "documents").select(F.col("doc_id").cast("int").alias("paper"), "text").where(F.col("text").rlike(f"[^\n{_MARKUP}]"))
    body = lambda x: F.trim(F.regexp_replace(x, f"[{_MARKUP}]+", " "))
    first = lambda b: F.substring_index(b, " ", 1)
    verse = lambda k, b: F.struct(k.alias("k"), first(b).alias("first"), F.substring(b, F.length(first(b)) + 1, F.length(b)).alias("rest"))

    def own(rows: DataFrame) -> DataFrame:
        lines = F.filter(F.transform(F.split("text", "\n"), lambda x, i: F.struct((i + 1).alias("k"), body(x).alias("body"))), lambda v: v["body"] != "")
        return rows.select("paper", F.transform(lines, lambda v: verse(v["k"], v["body"])).alias("vs"))

    again = stored(docs.groupBy("paper").agg(F.count("*").alias("n")).where("n > 1").select(F.col("paper").alias("__again")), "repeated")
    if again.isEmpty():
        return own(docs)
    shared = F.col("paper").eqNullSafe(F.col("__again"))
    gathered = own(docs.join(again, shared, "left_semi")).groupBy("paper").agg(F.sort_array(F.flatten(F.collect_list("vs"))).alias("vs"))
    return own(docs.join(again, shared, "left_anti")).unionByName(gathered)


def editions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(TeX files, HTML files, allow-list)."""
    papers, p = _sources(spark, sf_dir), F.col("paper")
    number = F.format_string("%03d", p)
    marked = lambda v: (p + v["k"]) % 3 == 0

    def tex_line(v: Column) -> Column:
        told = F.when(marked(v), F.concat(F.lit("\\bibemph{"), v["first"], F.lit("}"), v["rest"])).otherwise(F.concat(v["first"], v["rest"]))
        return F.concat(F.lit("\\vs p"), number, F.lit(" 1:"), v["k"], F.lit(" \\pc "), told, F.when(p % 4 == 1, "\u2019s").otherwise(""))

    head = F.concat(F.lit("\\upaper{"), p, F.lit("}{Title}\n\\author{Some One}\n\\usection{Heading}\n"))
    pair = F.concat(F.lit("\n\\usectiontwo{2 and 3}{Pair}\n\\vs p"), number, F.lit(" 2:1 pair text"))
    tex_src = papers.select(F.concat(F.lit("p"), number, F.lit(".tex")).alias("path"), F.concat(head, F.array_join(F.transform("vs", tex_line), "\n"), pair).alias("src"))

    ident = lambda s, k: F.concat(F.lit('id="U'), p, F.lit(f"_{s}_"), k, F.lit('"'))

    def html_line(v: Column) -> Column:
        k = v["k"]
        em = marked(v) & ~((p % 11 == 3) & (k == 1)) & ~((p % 5 == 0) & (k == 1))
        told = F.when(em, F.concat(F.lit("<em>"), v["first"], F.lit("</em>"), v["rest"])).when((p % 5 == 0) & (k == 1), F.concat(F.lit("X"), v["first"], v["rest"])).otherwise(F.concat(v["first"], v["rest"]))
        floating = F.when((p % 6 == 2) & (k == 2), F.concat(F.lit("\n<p "), ident(1, F.lit("2A")), F.lit(">floating</p>"))).otherwise("")
        return F.concat(F.lit("<p "), ident(1, k), F.lit("><small>1:1</small>"), told, F.when(p % 4 == 1, "\u02bcs").otherwise(""), F.lit("</p>"), floating)

    kept = F.array_join(F.transform(F.filter("vs", lambda v: (p % 7 != 0) | (v["k"] != 1)), html_line), "\n")
    title = F.when(F.expr("paper % 13 = 5"), "Other title").otherwise("Title")
    heading = F.when(F.expr("paper % 19 = 4"), "Changed").otherwise("Heading")
    extra = F.when(F.expr("paper % 17 = 1"), F.concat(F.lit("<p "), ident(1, F.lit("999999")), F.lit(">extra</p>"))).otherwise("")
    html = F.concat(
        F.lit("<h1 "), ident(0, F.lit("0")), F.lit(">Paper "), p, F.lit(". "), title, F.lit("</h1><h2 "), ident(1, F.lit("0")), F.lit(">1. "), heading, F.lit("</h2>"), kept, extra,
        F.lit("<h2 "), ident(3, F.lit("0")), F.lit(">2. and 3. Pair</h2><p "), ident(3, F.lit("1")), F.lit(">pair text</p>"),
    )
    html_src = papers.select(F.concat(F.lit("Paper"), number, F.lit(".html")).alias("path"), html.alias("src"))
    allow = papers.where("paper % 10 = 0 or paper % 22 = 3").select("paper", F.lit(1).alias("section"), F.lit(1).alias("verse"), F.expr("paper % 10 = 0").alias("skip"), F.expr("paper % 22 = 3").alias("ignore_italics"))
    return tex_src, html_src, allow


def _compared(spark: SparkSession, sf_dir: str) -> diff.Comparison:
    left, right, allow = editions(spark, sf_dir)
    return diff.Comparison(tex.tex_papers(left), html_papers(right), allow)


def edition_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings of every paper by kind: titles, sections, missing keys, texts, italics."""
    return _compared(spark, sf_dir).mismatches.groupBy("paper", "kind").agg(F.count("*").alias("n"))


def edition_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.paper_summary(_compared(spark, sf_dir)).select("paper", *summary.COUNTS, "status")


def book_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.totals(summary.paper_summary(_compared(spark, sf_dir)))


def failure_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings of the book by kind, with the first eight places of each."""
    return summary.by_kind(_compared(spark, sf_dir).mismatches).select("kind", "n", F.array_join("examples", " ").alias("examples"))


def report_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reports written for all papers, and their counts read back from the text."""
    return summary.read_reports(summary.paper_reports(_compared(spark, sf_dir)))


def glyph_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odd glyphs in common verses, before they were normalized."""
    return diff.glyph_log(_compared(spark, sf_dir).compared).select("paper", "section", "verse", "side", "glyph", "n")


def edition_recount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verses extracted against counts of marks and ids in the sources."""
    left, right, allow = editions(spark, sf_dir)
    c = diff.Comparison(tex.tex_papers(left), html_papers(right), allow)
    return checks.recount(left, right, c.left_verses, c.right_verses)


def mutants_caught(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damage done to papers whose editions agree, and how often the comparison saw it."""
    papers, p, number = _sources(spark, sf_dir), F.col("paper"), F.format_string("%03d", F.col("paper"))
    joined = lambda line: F.array_join(F.transform("vs", line), "\n")
    tex_lines = joined(lambda v: F.concat(F.lit("\\vs p"), number, F.lit(" 1:"), v["k"], F.lit(" word \\bibemph{"), v["first"], F.lit("}"), v["rest"]))
    html_lines = joined(lambda v: F.concat(F.lit('<p id="U'), p, F.lit("_1_"), v["k"], F.lit('">word <em>'), v["first"], F.lit("</em>"), v["rest"], F.lit("</p>")))
    left = papers.select(F.concat(F.lit("p"), number, F.lit(".tex")).alias("path"), F.concat(F.lit("\\upaper{"), p, F.lit("}{T}\n"), tex_lines).alias("src"))
    right = papers.select(F.concat(F.lit("Paper"), number, F.lit(".html")).alias("path"), html_lines.alias("src"))
    return checks.mutation_check(left, right).groupBy("mutant").agg(F.count("*").alias("papers"), F.count_if("caught").alias("caught"))


def spot_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both editions' texts of sampled verses; of the other edition, files are picked by their papers before they are parsed."""
    left, right, _ = editions(spark, sf_dir)
    verses = fs.verses_of(stored(tex.tex_papers(left), "left"))
    sample = stored(checks.sample_keys(verses, 25), "sample")
    number = F.regexp_extract("path", r"(\d+)\.html$", 1).cast("int")
    wanted = right.join(F.broadcast(sample.select("paper").distinct()), number == F.col("paper"), "left_semi")
    return checks.spot_check(verses, fs.verses_of(html_papers(wanted)).where("not floater"), sample=sample)


def extract_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two extractions of all papers give the same digest, and other verses another."""
    left, _, _ = editions(spark, sf_dir)
    verses = lambda: fs.verses_of(tex.tex_papers(left))
    once = stored(verses(), "verses")
    first = checks.digest(once)
    same, other = checks.digest(verses()) == first, checks.digest(once.withColumn("text", F.concat("text", F.lit(".")))) != first
    return checks.verse_totals(once).select("verses", "spans", F.lit(same).alias("same"), F.lit(other).alias("told_apart"))


def changed_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Character edits of verses with one planted insertion, loss or replacement of a sign that occurs nowhere else."""
    v = _verses(spark, sf_dir).select("paper", F.lit(1).alias("section"), F.col("k").alias("verse"), "body")
    # at an end, where no repeated part of the text can match better
    head, tail = F.when(F.expr("verse % 2 = 1"), F.col("body")).otherwise(""), F.when(F.expr("verse % 2 = 1"), "").otherwise(F.col("body"))
    none = F.expr(f"cast(array() as {SPANS})").alias("italics")
    with_sign = lambda s: F.concat(head, F.lit(s), tail)
    a = F.when(F.expr("paper % 3 = 0"), F.col("body")).otherwise(with_sign("\u2603"))
    b = F.when(F.expr("paper % 3 = 0"), with_sign("\u2602")).when(F.expr("paper % 3 = 1"), F.col("body")).otherwise(with_sign("\u2604"))
    key = ["paper", "section", "verse"]
    c = diff.compare_verses(v.select(*key, a.alias("text"), none), v.select(*key, b.alias("text"), none), v.select(*key, F.lit(False).alias("skip"), F.lit(False).alias("ignore_italics")).limit(0))
    return diff.text_changes(c).select("paper", "verse", "tag", "i1", "i2", "j1", "j2", F.length("before").alias("n_before"), "left", "right", F.length("after").alias("n_after"))


def clean_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text with odd space and glyphs, normalized with its spans: the second word, cut in two, and the first."""
    longer = F.concat("body", F.lit(" and so on"))
    v = _verses(spark, sf_dir).select("paper", "k", F.split(longer, " ").alias("w"))
    a, b, c = F.col("w")[0], F.col("w")[1], F.array_join(F.expr("slice(w, 3, size(w))"), " ")
    text = F.concat(F.lit(" \t"), a, F.lit(" \u00a0 "), b, F.lit("\u2009"), c, F.lit("\u02bc  "))
    la, lb = F.length(a), F.length(b)
    at = la + 5
    cut = F.expr("char_length(w[1]) div 2")
    span = lambda s, e: F.struct(s.cast("int").alias("s"), e.cast("int").alias("e"))
    spans = F.array(span(at, at + cut), span(at + cut, at + lb), span(F.lit(0), la + 2), span(at + lb + 1, at + lb + 1))
    n = v.select("paper", "k", tx.normalize_spans(text, spans).alias("n"), tx.merge_spans(spans).alias("m"), tx.shift_spans(spans, F.lit(10)).alias("s"))
    show = lambda x: F.array_join(F.transform(x, lambda y: F.concat_ws("-", y["s"].cast("string"), y["e"].cast("string"))), " ")
    return n.select("paper", "k", F.col("n.text").alias("text"), show(F.col("n.italics")).alias("spans"), show("m").alias("merged"), show("s").alias("shifted"))


def _nth(k: Column, rules: list[tuple]) -> Column:
    """The source pieces of rule k, around the verse w; only that rule's text is put together."""
    out = F.when(F.lit(False), "")
    for i, (parts, *_) in enumerate(rules):
        out = out.when(k % len(rules) == i, F.concat(*[F.col("w") if x is None else F.lit(x) for x in parts]))
    return out


def tex_constructs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verses through every sort of macro: text and spans as extracted."""
    v = _verses(spark, sf_dir).select("paper", "k", F.col("body").alias("w"))
    number = F.format_string("%03d", F.col("paper"))
    text = _nth(F.col("k"), _CONSTRUCTS)
    src = _joined(v, ["paper"], "k", F.concat(F.lit("\\vs p"), number, F.lit(" 1:"), F.col("k"), F.lit(" "), text), "vs").select(F.concat(F.lit("p"), number, F.lit(".tex")).alias("path"), "vs")
    papers = tex.tex_papers(src.select("path", F.concat(F.lit("\\usection{S}\n"), "vs").alias("src")))
    got = fs.verses_of(papers).select("paper", F.col("verse").alias("k"), "text", "italics", F.array_join("macros_seen", " ").alias("macros"))
    return got.select("paper", "k", "text", F.array_join(F.transform("italics", lambda y: F.concat_ws("-", y["s"].cast("string"), y["e"].cast("string"))), " ").alias("spans"), "macros")


#: Source pieces (None: a verse), the text that comes out ({}: the verse), its span: prefix and suffix around the verse, or none, and the macros seen in order.
_CONSTRUCTS: list[tuple[list[str | None], str, str, str]] = [
    ([None], "{}", "", ""),
    (["a \\bibemph{", None, "} b"], "a {} b", "2 w", "bibemph"),
    (["a {\\itshape ", None, "} b"], "a {} b", "2 w", "itshape"),
    (["a\\fnc{note \\bibemph{x}} ", None], "a {}", "", "fnc"),
    (["a \\kern-1pt", None], "a {}", "", "kern"),
    (["\\vspace*{1ex}a \\hspace{2pt}", None], "a {}", "", "vspace hspace"),
    (["\\makeatletter \\odd@name junk\\makeatother ", None], "{}", "", ""),
    (["\\begin{quoting}", None, "\\end{quoting}"], "{}", "", "begin end"),
    (["\\begin{multicols}{2}", None, "\\end{multicols}"], "{}", "", "begin end"),
    (["a~--~", None, " --- b $x$"], "a \u2013 {} \u2014 b x", "", ""),
    (["a % \\unknownmacro in a comment\n", None], "a {}", "", ""),
    (["a\\hyp{}", None], "a-{}", "", "hyp"),
    (["\\ublistelem{1.}\\bibnobreakspace ", None, "\\ldots"], "1. {}...", "", "ublistelem bibnobreakspace ldots"),
    (["\\textcolor{red}{", None, "} \\tunemarkup{x}{y}z"], "{} z", "", "textcolor tunemarkup"),
    (["a \\textsc{", None, "}\\\\[1ex]b"], "a {}b", "", "textsc \\"),
    (["\\makebox[1cm][l]{", None, "} 2\\times 3"], "{} 2 x 3", "", "makebox times"),
    (["a\\linebreak[3]", None, "\\footnote{gone}"], "a {}", "", "linebreak footnote"),
    (["[a] \\ts{", None, "}\\, b"], "[a] {} b", "", "ts ,"),
    (["a {b {\\bibemph{", None, "}}} c"], "a b {} c", "4 w", "bibemph"),
    (["\\setlength{\\parindent}{0pt}", None], "{}", "", "setlength"),
    (["a ", None, "} b"], "a {} b", "", ""),
]


def html_constructs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verses through every rule of the other markup: citations, leaders, small caps, emphasis, raised numbers."""
    v = _verses(spark, sf_dir).select("paper", "k", F.trim(F.regexp_replace(F.regexp_replace("body", "[^a-zA-Z ]", ""), " +", " ")).alias("w")).where("w <> ''")
    inner = _nth(F.col("k"), _RULES)
    para = F.concat(F.lit('<p id="U'), F.col("paper"), F.lit("_1_"), F.col("k"), F.lit('">'), inner, F.lit("</p>"))
    src = _joined(v, ["paper"], "k", para, "ps").select(F.format_string("Paper%03d.html", "paper").alias("path"), F.concat(F.lit('<nav><p id="x">no</p></nav><p id="U'), F.col("paper"), F.lit('_0_1">THE GREAT DAY was Here</p>'), "ps").alias("src"))
    got = fs.verses_of(html_papers(src)).select("paper", "section", F.col("verse").alias("k"), "text", F.array_join(F.transform("italics", lambda y: F.concat_ws("-", y["s"].cast("string"), y["e"].cast("string"))), " ").alias("spans"))
    return got


_RULES: list[tuple[list[str | None], str, str]] = [
    ([None], "{}", ""),
    (["<small>1:1 (2.3)</small> ", None, "<small>small</small>"], "{}small", ""),
    (["a<span class='dot'>. . .<span>x</span></span> ", None], "a {}", ""),
    (["<span class='scaps big'>", None, "</span> b"], "{U} b", ""),
    (["a <em>", None, "</em> b"], "a {} b", "2 w"),
    ([None, "<sup>12</sup> b"], "{}^12 b", ""),
    ([None, "<sup>th</sup> b<em></em>"], "{}th b", ""),
    (["a &amp; <b>", None, "</b>\n  c"], "a & {} c", ""),
    (["e\u0301t\u00e9  ", None], "\u00e9t\u00e9 {}", ""),
    (["<em>", None, "</em><em>b</em> c"], "{}b c", "0 w+1"),
]


def title_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Section titles as both extractors read them: numbered in both ways, combined, plain."""
    ids = _verses(spark, sf_dir).groupBy("paper").agg(F.min_by("body", "k").alias("body")).select("paper", F.trim(F.regexp_replace("body", "[^a-zA-Z0-9 ]+ *", "")).alias("w"))
    p, number, w = F.col("paper"), F.format_string("%03d", F.col("paper")), F.col("w")
    left = ids.select(F.concat(F.lit("p"), number, F.lit(".tex")).alias("path"), F.concat(F.lit("\\upaper{"), p, F.lit("}{The \\bibemph{Name "), w, F.lit("} --- "), p, F.lit("}\n\\upapertitle{Sub "), w, F.lit("}\n\\author{A\\hyp{}B}\n\\usection{One}\n\\usectiontwo{2 and 3}{Two~Three}\n\\usection{Four~"), w, F.lit("}")).alias("src"))
    h2 = lambda s, t: F.concat(F.lit('<h2 id="U'), p, F.lit(f'_{s}_0">{t}</h2>'))
    right = ids.select(F.format_string("Paper%03d.html", p).alias("path"), F.concat(F.lit('<h1 id="U'), p, F.lit('_0_0">Paper '), p, F.lit(". The Name "), w, F.lit("</h1>"), h2(1, "1. One"), h2(3, "2. and 3. Two Three"), h2(4, "IV. Four"), h2(5, "Plain"), F.lit('<h2 id="U'), p, F.lit('_6_0">6. Six '), w, F.lit("</h2>")).alias("src"))
    out = []
    for side, papers in (("left", tex.tex_papers(left)), ("right", html_papers(right))):
        s = F.array_join(F.transform("sections", lambda x: F.concat_ws(" ", x["n"].cast("string"), x["title"], F.coalesce(x["combined_with"].cast("string"), F.lit("-")))), ";")
        out.append(papers.select("paper", F.lit(side).alias("side"), "title", F.coalesce("subtitle", F.lit("-")).alias("subtitle"), F.coalesce("author", F.lit("-")).alias("author"), s.alias("sections")))
    return out[0].unionByName(out[1])


def poetic_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbered verse lines: each ends at a paragraph mark, blank ones don't count, a mark relabels."""
    v = _verses(spark, sf_dir)
    number = F.format_string("%03d", F.col("paper"))
    src = _joined(v, ["paper"], "k", F.concat(F.col("body"), F.lit("\\par\n\\par")), "vs").select(F.concat(F.lit("p"), number, F.lit(".tex")).alias("path"), F.concat(F.lit("\\usection{S}\n\\printvssuper{5}"), "vs", F.lit("\n\\vs p"), number, F.lit(" 1:900000 plain\\par still\n\\vs p"), number, F.lit(" 1:900001 old \\vsmark{2}{7}new\\par then\\par")).alias("src"))
    return fs.verses_of(tex.tex_papers(src)).select("paper", "section", "verse", "text")


def broken_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers whose source breaks off behind their verses, in four ways, are told apart and don't stop the others."""
    p, number = F.col("paper"), F.format_string("%03d", F.col("paper"))
    verses = _joined(_verses(spark, sf_dir), ["paper"], "k", F.concat(F.lit("\\vs p"), number, F.lit(" 1:"), F.col("k"), F.lit(" "), F.col("body")), "vs")
    end = F.element_at(F.array(F.lit("\\par"), F.lit("\\nosuchmacro x"), F.lit("\\begin{nosuch}x\\end{nosuch}"), F.concat(F.lit("\\upaper{"), p + 1, F.lit("}{T}")), F.lit("\\vs q 1:1 x")), (p % 5 + 1).cast("int"))
    got = tex.tex_papers(verses.select(F.concat(F.lit("p"), number, F.lit(".tex")).alias("path"), F.concat("vs", F.lit("\n"), end).alias("src")))
    return got.select("paper", F.col("error").isNotNull().alias("broken"), F.size("verses").alias("verses"))


def paper_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as chapters of 100 papers: written as files beside others, found by name, extracted, written as lines of JSON and read again."""
    v = _verses(spark, sf_dir).select((F.col("paper") % 100).alias("book"), F.expr("paper div 100 + 1").cast("int").alias("chapter"), "k", "body")
    number = F.format_string("%03d", F.col("book"))
    line = F.concat(F.lit("\\vs p"), number, F.lit(" "), F.col("chapter"), F.lit(":"), F.col("k"), F.lit(" "), F.col("body"))
    own = v.select(F.concat(F.lit("p"), number, F.lit(".tex")).alias("path"), "chapter", line.alias("line"), "k")
    other = v.select("book").distinct().select(F.concat(F.lit("p"), F.col("book"), F.lit("-sections.tex")).alias("path"), F.lit(0).alias("chapter"), F.lit("\\nothing").alias("line"), F.lit(0).alias("k"))
    folder = scratch(spark, "papers")
    write_lines(own.unionByName(other), ["chapter", "k", "line"], folder)
    papers, pieces = tex.tex_pieces(fs.chosen(fs.tex_lines(spark, folder), [k for k in range(100) if k % 10 != 9]))
    fs.write_jsonl(papers, (lines := scratch(spark, "jsonl")), pieces, "gzip")
    heads, verses = fs.read_jsonl(spark, lines)
    found = diff.last_wins(verses.unionByName(verses.where("verse = 1").withColumn("text", F.concat("text", F.lit("!"))).withColumn("ord", F.struct(F.lit("~").alias("file"), F.lit(0).cast("long").alias("split"), F.lit(0).cast("long").alias("n")))))
    return found.join(heads.select("paper"), "paper", "left_semi").select("paper", "section", "verse", "text", "repeats")


def deviation_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An allow-list written as a file, with single keys, ranges, quoted notes and comments, and read as rows."""
    d = _t(spark, sf_dir, "documents").select("doc_id", F.col("n_chars"))
    block = F.concat(F.lit("# accepted\n"), F.expr("doc_id % 500"), F.lit(":"), F.expr("doc_id div 500"), F.lit(":3"), F.when(F.expr("doc_id % 3 = 0"), F.lit("-5")).otherwise(""), F.lit(":\n  skip: "), F.when(F.expr("doc_id % 2 = 0"), "True").otherwise("no"), F.lit("\n  reason: \"chars "), F.col("n_chars"), F.lit("\"\n  other: x\n"), F.when(F.expr("doc_id % 4 = 1"), F.lit("  ignore_italics: 1\n")).otherwise(""))
    src = d.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", block.alias("x")))), lambda x: x["x"]), "\n").alias("src"))
    folder = scratch(spark, "allow")
    write_files(src.select(F.lit("allow.yaml").alias("path"), "src"), folder)
    return fs.read_deviations(spark, f"{folder}/allow.yaml").select("paper", "section", "verse", "skip", "ignore_italics", "reason")


def list_openers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that open a list get the paragraph mark; the changed documents are written as files and read again."""
    d = _t(spark, sf_dir, "documents").select("doc_id", F.regexp_replace("text", "[\\\\{}]", " ").alias("text"))
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.when(i % 3 == 0, F.concat(F.lit("\\vs p001 1:"), i.cast("string"), F.lit(" \\ublistelem{1.} "), x)).when(i % 3 == 1, F.concat(F.lit("\\pc \\vs p001 1:1 \\ublistelem{1.} "), x)).otherwise(x))
    files = d.select(F.concat(F.col("doc_id").cast("string"), F.lit(".tex")).alias("path"), F.array_join(lines, "\n").alias("src"))
    folder = scratch(spark, "fixed")
    fixes = fs.write_fixed(files, folder)
    again = fs.whole_files(spark, folder, "*.tex").select("path", F.md5("src").alias("md5"))
    return fixes.join(again, "path").select("path", "fixes", "md5")


def unknown_macro_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Macro names that the table lacks, in documents whose commonest words are macros."""
    marked = F.replace(F.replace(F.replace(F.col("text"), F.lit("%"), F.lit(" ")), F.lit("and "), F.lit("\\mystery ")), F.lit("de "), F.lit("\\ldots "))
    return summary.unknown_macros(tex.token_table(_t(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), marked.alias("src"))))


def macro_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first three places of each macro, by document and place in it: one before every verse, one behind every second."""
    line = F.concat(F.lit("\\mystery "), F.col("body"), F.when(F.expr("k % 2 = 1"), F.lit(" \\ldots")).otherwise(""))
    docs = _joined(_verses(spark, sf_dir), ["paper"], "k", line, "src").select(F.col("paper").alias("path"), "src")
    return summary.macro_coverage(tex.token_table(docs)).select("rank", "value", "n", "known", F.array_join("places", " ").alias("places"))


def _with_problems(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Both sides' files, some missing on a side, some twice, some broken, some with a verse that the extractor can't see."""
    left, right, _ = editions(spark, sf_dir)
    paper = F.regexp_extract("path", r"(\d+)\.\w+$", 1).cast("int")
    left = left.withColumn("p", paper).where("p % 37 <> 5").select("path", F.when(F.expr("p % 41 = 6"), F.lit("\\nosuchmacro")).otherwise(F.col("src")).alias("src"))
    lost = F.when(F.expr("p % 31 = 3"), F.concat(F.lit('<!--<p id="U'), F.col("p").cast("string"), F.lit('_1_888888">hidden</p>-->'))).otherwise("")
    right = right.withColumn("p", paper).where("p % 23 <> 1").select("p", "path", F.concat("src", lost).alias("src"))
    again = right.where("p % 29 = 2").withColumn("path", F.concat(F.lit("Again"), "path"))
    return left, right.unionByName(again).select("path", "src")


def gate_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stops a strict run: missing and doubled files, papers that don't parse, verses lost on the way."""
    left, right = _with_problems(spark, sf_dir)
    c = diff.Comparison(tex.tex_papers(left), html_papers(right), fs.read_deviations(spark, None))
    return gates.problems(left, right, c).select("gate", "paper", "side")


def paper_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A digest of each paper's verses, and how it fares in a second run with changed, lost and new papers."""
    left, _, _ = editions(spark, sf_dir)
    verses = stored(fs.verses_of(tex.tex_papers(left)), "verses")
    text = F.when(F.expr("paper % 9 = 4 and section = 2"), F.concat("text", F.lit("."))).otherwise(F.col("text"))
    before, after = (stored(checks.paper_digests(v), "digests") for v in (verses, verses.where("paper % 15 <> 7").withColumn("text", text)))
    return before.join(checks.changed_papers(before, after), "paper", "left").select("paper", "verses", "digest", F.coalesce("change", F.lit("same")).alias("change"))


def book_report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The book's report, written in order by the executors and read back: its line for each paper, with the line's place among them."""
    folder = scratch(spark, "report")
    summary.write_book_report(_compared(spark, sf_dir), folder, 7)
    lines = summary.read_in_order(spark, folder).where(F.col("line").rlike(r"^\| \d"))
    return numbered(lines, "file", "n", name="place").select("place", "line")


def tokens_in_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each line of each document, and where the last begins, in SQL by the table function over parts of a table."""
    tex.register(spark)
    docs = _t(spark, sf_dir, "documents").select("doc_id", F.concat(F.replace(F.col("text"), F.lit("the "), F.lit("\\hyp{}the ")), F.lit("\n")).alias("src"))
    docs.createOrReplaceTempView("token_sources")
    return spark.sql("SELECT doc_id, line, count(*) AS tokens, max(col) AS last FROM token_table(TABLE(token_sources) PARTITION BY doc_id) GROUP BY doc_id, line")


FUNCTIONS = [
    edition_mismatches, edition_summary, book_totals, failure_kinds, report_counts, glyph_audit, edition_recount, mutants_caught, spot_check, extract_digest, changed_letters, clean_spans, tex_constructs, html_constructs, title_forms,
    poetic_lines, broken_papers, paper_files, deviation_file, list_openers, unknown_macro_names, macro_places, gate_findings, paper_digests, book_report_lines, tokens_in_sql,
]

_V = r"""ln AS (SELECT CAST(doc_id AS INTEGER) AS paper, unnest(string_split(text, chr(10))) AS line, CAST(generate_subscripts(string_split(text, chr(10)), 1) AS INTEGER) AS k FROM documents),
v AS (SELECT paper, k, trim(regexp_replace(trim(translate(line, '\{}[]%$~&<>-', '            ')), ' +', ' ', 'g')) AS body FROM ln WHERE trim(translate(line, '\{}[]%$~&<>-', '            ')) <> '')"""
_P = f"""{_V}, pf AS (SELECT paper, count(*) AS n, count(*) FILTER (WHERE k = 1) AS f FROM v GROUP BY paper),
d AS (SELECT *, CASE WHEN paper % 7 = 0 THEN f ELSE 0 END AS lost, CAST(paper % 17 = 1 AS INTEGER) AS extra, paper % 10 = 0 AS skip, CASE WHEN paper % 7 <> 0 AND paper % 5 = 0 THEN f ELSE 0 END AS changed,
 CASE WHEN paper % 7 <> 0 AND paper % 5 <> 0 AND paper % 11 = 3 AND (paper + 1) % 3 = 0 AND paper % 22 <> 3 THEN f ELSE 0 END AS italic FROM pf),
m AS (SELECT paper, 'PAPER_TITLE' AS kind, 1 AS n FROM d WHERE paper % 13 = 5 UNION ALL SELECT paper, 'SECTION_TITLE', 1 FROM d WHERE paper % 19 = 4 UNION ALL SELECT paper, 'TEXT', changed FROM d WHERE NOT skip AND changed > 0
 UNION ALL SELECT paper, 'ITALIC', italic FROM d WHERE NOT skip AND italic > 0 UNION ALL SELECT paper, 'STRUCT', (CASE WHEN skip THEN 0 ELSE lost END) + extra FROM d WHERE (NOT skip AND lost > 0) OR extra > 0),
s AS (SELECT d.paper, CAST(3 AS BIGINT) AS left_sections, CAST(3 AS BIGINT) AS right_sections, n + 1 AS left_verses, n + 1 - lost + extra AS right_verses, n + 1 - lost AS common, lost AS only_left, CAST(extra AS BIGINT) AS only_right,
 CASE WHEN skip THEN 0 ELSE changed END AS text_diffs, CASE WHEN skip THEN 0 ELSE italic END AS italic_diffs, CAST(coalesce((SELECT sum(m.n) FROM m WHERE m.paper = d.paper), 0) AS BIGINT) AS mismatches FROM d),
t AS (SELECT *, CASE WHEN mismatches = 0 THEN 'CLEAN' ELSE 'FAIL' END AS status FROM s)"""


def _choice(rules: list[tuple], upper: str = "upper(w)") -> tuple[str, str]:
    """SQL for the text and the spans that each rule gives."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    texts, spans = [], []
    for i, (_, text, span, *_) in enumerate(rules):
        texts.append(f"WHEN {i} THEN replace(replace({quote(text)}, '{{U}}', {upper}), '{{}}', w)")
        if span:
            start, _, size = span.partition(" ")
            spans.append(f"WHEN {i} THEN '{start}-' || CAST({start} + length(w){size.removeprefix('w')} AS VARCHAR)")
    return f"CASE k % {len(rules)} {' '.join(texts)} END", f"CASE k % {len(rules)} {' '.join(spans)} ELSE '' END"


def _macros() -> str:
    """SQL for the macros that each construct holds."""
    return f"CASE k % {len(_CONSTRUCTS)} " + " ".join(f"WHEN {i} THEN '{seen}'" for i, (*_, seen) in enumerate(_CONSTRUCTS)) + " END"


_TEX_TEXT, _TEX_SPANS = _choice(_CONSTRUCTS)
_HTML_TEXT, _HTML_SPANS = _choice(_RULES)

ORACLE = {
    "edition_mismatches": f"WITH {_P} SELECT paper, kind, CAST(n AS BIGINT) AS n FROM m",
    "edition_summary": f"WITH {_P} SELECT * FROM t",
    "book_totals": f"WITH {_P} SELECT count(*) AS papers, count(*) FILTER (WHERE status = 'CLEAN') AS clean, count(*) FILTER (WHERE status = 'FAIL') AS failed, {', '.join(f'CAST(sum({c}) AS BIGINT) AS {c}' for c in ('left_verses', 'right_verses', 'common', 'only_left', 'only_right', 'text_diffs', 'italic_diffs', 'mismatches'))} FROM t",
    "failure_kinds": f"""WITH {_P}, e AS (SELECT 'PAPER_TITLE' AS kind, paper, CAST(paper AS VARCHAR) AS key, -1 AS a, -1 AS b FROM d WHERE paper % 13 = 5 UNION ALL SELECT 'SECTION_TITLE', paper, paper || ':1', 1, -1 FROM d WHERE paper % 19 = 4
 UNION ALL SELECT 'TEXT', paper, paper || ':1:1', 1, 1 FROM d WHERE NOT skip AND changed > 0 UNION ALL SELECT 'ITALIC', paper, paper || ':1:1', 1, 1 FROM d WHERE NOT skip AND italic > 0
 UNION ALL SELECT 'STRUCT', paper, paper || ':1:1', 1, 1 FROM d WHERE NOT skip AND lost > 0 UNION ALL SELECT 'STRUCT', paper, paper || ':1:999999', 1, 999999 FROM d WHERE extra > 0),
r AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY paper, a, b) AS i FROM e) SELECT kind, count(*) AS n, string_agg(key, ' ' ORDER BY i) FILTER (WHERE i <= 8) AS examples FROM r GROUP BY kind""",
    "report_counts": f"WITH {_P} SELECT paper, left_verses, right_verses, common, only_left, only_right, text_diffs, italic_diffs, status, mismatches FROM t",
    "glyph_audit": f"""WITH {_P} SELECT v.paper, CAST(1 AS INTEGER) AS section, k AS verse, 'right' AS side, 'MODIFIER_APOSTROPHE' AS glyph, CAST(1 AS INTEGER) AS n FROM v WHERE paper % 4 = 1 AND NOT (k = 1 AND (paper % 7 = 0 OR paper % 10 = 0))""",
    "edition_recount": f"WITH {_P} SELECT paper, CAST(n + 1 AS INTEGER) AS markers, n + 1 AS tex_verses, n + 1 - lost + extra AS ids, n + 1 - lost + extra AS html_verses, true AS ok FROM d",
    "mutants_caught": f"""WITH {_V}, x AS (SELECT paper, 'word \\bibemph{{' || regexp_extract(body, '^[^ ]+') || '}}' || substr(body, length(regexp_extract(body, '^[^ ]+')) + 1) AS t FROM v),
c AS (SELECT count(DISTINCT paper) AS papers, count(DISTINCT paper) FILTER (WHERE contains(t, ',')) AS commas, count(DISTINCT paper) FILTER (WHERE regexp_matches(t, '^[^.]*\\. [^.]+\\.')) AS sentences FROM x),
m AS (SELECT unnest(['double_word', 'lose_verse', 'shift_number', 'mark_word', 'cut_letter', 'unmark_word']) AS mutant, papers FROM c UNION ALL SELECT 'comma_to_dot', commas FROM c UNION ALL SELECT 'lose_sentence', sentences FROM c)
SELECT mutant, papers, papers AS caught FROM m WHERE papers > 0""",
    "spot_check": f"""WITH {_V}, a AS (SELECT paper, 1 AS section, k AS verse, body FROM v UNION ALL SELECT DISTINCT paper, 2, 1, 'pair text' FROM v), x AS (SELECT * FROM a ORDER BY md5('42:' || paper || ':' || section || ':' || verse), paper, section, verse LIMIT 25)
SELECT paper, CAST(section AS INTEGER) AS section, CAST(verse AS INTEGER) AS verse, substr(body || CASE WHEN paper % 4 = 1 AND section = 1 THEN chr(8217) || 's' ELSE '' END, 1, 300) AS left_text, CASE WHEN section = 2 OR (paper % 7 = 0 AND verse = 1) THEN '(missing)' ELSE substr(CASE WHEN paper % 5 = 0 AND verse = 1 THEN 'X' ELSE '' END || body || CASE WHEN paper % 4 = 1 THEN chr(700) || 's' ELSE '' END, 1, 300) END AS right_text FROM x""",
    "extract_digest": f"WITH {_V} SELECT count(*) + count(DISTINCT paper) AS verses, count(*) FILTER (WHERE (paper + k) % 3 = 0) AS spans, true AS same, true AS told_apart FROM v",
    "changed_letters": f"""WITH {_V}, ch AS (SELECT paper, k, unnest(string_split(nfc_normalize(body), '')) AS c FROM v), n AS (SELECT paper, k, c, count(*) AS n FROM ch GROUP BY ALL), z AS (SELECT paper, k, min(n) AS rarest FROM n GROUP BY ALL),
b AS (SELECT paper, k, nfc_normalize(body) AS body, length(nfc_normalize(body)) AS l, CASE WHEN k % 2 = 1 THEN length(nfc_normalize(body)) ELSE 0 END AS c, CAST(paper % 3 <> 0 AS INTEGER) AS da, CAST(paper % 3 <> 1 AS INTEGER) AS db, rarest FROM v JOIN z USING (paper, k)),
e AS (SELECT *, k % 2 = 0 AND l + db >= 200 AND rarest > (l + db) // 100 + 1 AS whole FROM b)
SELECT paper, k AS verse, CASE WHEN whole THEN 'replace' ELSE CASE paper % 3 WHEN 0 THEN 'insert' WHEN 1 THEN 'delete' ELSE 'replace' END END AS tag, CAST(c AS INTEGER) AS i1, CAST(c + da + CASE WHEN whole THEN l ELSE 0 END AS INTEGER) AS i2, CAST(c AS INTEGER) AS j1, CAST(c + db + CASE WHEN whole THEN l ELSE 0 END AS INTEGER) AS j2,
CAST(least(c, 20) AS INTEGER) AS n_before, CASE WHEN paper % 3 = 0 THEN '' ELSE chr(9731) END || CASE WHEN whole THEN body ELSE '' END AS "left", CASE paper % 3 WHEN 0 THEN chr(9730) WHEN 1 THEN '' ELSE chr(9732) END || CASE WHEN whole THEN body ELSE '' END AS "right", CAST(CASE WHEN whole THEN 0 ELSE least(l - c, 20) END AS INTEGER) AS n_after FROM e""",
    "clean_spans": f"""WITH {_V}, x AS (SELECT paper, k, string_split(body || ' and so on', ' ') AS w FROM v), y AS (SELECT paper, k, w[1] AS a, w[2] AS b, array_to_string(w[3:], ' ') AS c, length(w[1]) AS la, length(w[2]) AS lb, length(w[1]) + 5 AS st FROM x)
SELECT paper, k, nfc_normalize(a || ' ' || b || ' ' || c) || chr(8217) AS text, '0-' || la || ' ' || (la + 1) || '-' || (la + 1 + lb) AS spans,
'0-' || (la + 2) || ' ' || st || '-' || (st + lb) || ' ' || (st + lb + 1) || '-' || (st + lb + 1) AS merged, (st + 10) || '-' || (st + 10 + lb // 2) || ' ' || (st + 10 + lb // 2) || '-' || (st + 10 + lb) || ' 10-' || (la + 12) || ' ' || (st + lb + 11) || '-' || (st + lb + 11) AS shifted FROM y""",
    "tex_constructs": f"WITH {_V}, x AS (SELECT paper, k, body AS w FROM v) SELECT paper, k, {_TEX_TEXT} AS text, {_TEX_SPANS} AS spans, {_macros()} AS macros FROM x",
    "html_constructs": f"WITH {_V}, x AS (SELECT paper, k, trim(regexp_replace(regexp_replace(body, '[^a-zA-Z ]', '', 'g'), ' +', ' ', 'g')) AS w FROM v), z AS (SELECT * FROM x WHERE w <> '') SELECT paper, CAST(1 AS INTEGER) AS section, k, {_HTML_TEXT} AS text, {_HTML_SPANS} AS spans FROM z UNION ALL SELECT DISTINCT paper, 0, 1, 'The great day was Here', '' FROM z",
    "title_forms": f"""WITH {_V}, f AS (SELECT paper, arg_min(body, k) AS body FROM v GROUP BY paper), i AS (SELECT paper, trim(regexp_replace(body, '[^a-zA-Z0-9 ]+ *', '', 'g')) AS w FROM f),
j AS (SELECT paper, regexp_replace(w, ' +', ' ', 'g') AS w FROM i)
SELECT paper, 'left' AS side, trim('The Name ' || w) || ' ' || chr(8212) || ' ' || paper AS title, trim('Sub ' || w) AS subtitle, 'A-B' AS author, '1 One -;2 Two Three 3;3 Two Three 2;4 ' || trim('Four ' || w) || ' -' AS sections FROM j
UNION ALL SELECT paper, 'right', trim('The Name ' || w), '-', '-', '1 One -;2 Two Three 3;3 Two Three 2;4 Four -;5 Plain -;6 ' || trim('Six ' || w) || ' -' FROM j""",
    "poetic_lines": f"""WITH {_V}, r AS (SELECT paper, 1 AS section, 4 + row_number() OVER (PARTITION BY paper ORDER BY k) AS verse, body AS text FROM v)
SELECT paper, CAST(section AS INTEGER) AS section, CAST(verse AS INTEGER) AS verse, text FROM r UNION ALL SELECT DISTINCT paper, 1, 900000, 'plainstill' FROM v UNION ALL SELECT DISTINCT paper, 2, 7, 'old new' FROM v UNION ALL SELECT DISTINCT paper, 2, 8, 'then' FROM v""",
    "broken_papers": f"WITH {_V} SELECT paper, paper % 5 <> 0 AS broken, CAST(CASE WHEN paper % 5 = 0 THEN count(*) ELSE 0 END AS INTEGER) AS verses FROM v GROUP BY paper",
    "paper_files": f"WITH {_V} SELECT CAST(paper % 100 AS INTEGER) AS paper, CAST(paper // 100 + 1 AS INTEGER) AS section, k AS verse, body || CASE WHEN k = 1 THEN '!' ELSE '' END AS text, CAST(k = 1 AS BIGINT) AS repeats FROM v WHERE paper % 10 <> 9",
    "deviation_file": """SELECT CAST(doc_id % 500 AS INTEGER) AS paper, CAST(doc_id // 500 AS INTEGER) AS section, CAST(unnest(generate_series(3, CASE WHEN doc_id % 3 = 0 THEN 5 ELSE 3 END)) AS INTEGER) AS verse, doc_id % 2 = 0 AS skip, doc_id % 4 = 1 AS ignore_italics, 'chars ' || n_chars AS reason FROM documents""",
    "list_openers": r"""WITH s AS (SELECT doc_id, string_split(regexp_replace(text, '[\\{}]', ' ', 'g'), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS x, generate_subscripts(ls, 1) - 1 AS i FROM s)
SELECT doc_id || '.tex' AS path, CAST(count(*) FILTER (WHERE i % 3 = 0) AS INTEGER) AS fixes, md5(string_agg(CASE i % 3 WHEN 0 THEN '\pc \vs p001 1:' || i || ' \ublistelem{1.} ' || x WHEN 1 THEN '\pc \vs p001 1:1 \ublistelem{1.} ' || x ELSE x END, chr(10) ORDER BY i)) AS md5 FROM l GROUP BY doc_id""",
    "unknown_macro_names": "SELECT DISTINCT 'mystery' AS name FROM documents WHERE text LIKE '%and %'",
    "macro_places": f"""WITH {_V}, x AS (SELECT paper, body, k, row_number() OVER (PARTITION BY paper ORDER BY k) AS l FROM v), y AS (SELECT *, row_number() OVER (ORDER BY paper, k) AS i, row_number() OVER (PARTITION BY k % 2 ORDER BY paper, k) AS j FROM x)
SELECT CAST(1 AS BIGINT) AS rank, 'mystery' AS value, count(*) AS n, false AS known, string_agg(paper || ':' || l || ':1', ' ' ORDER BY i) FILTER (WHERE i <= 3) AS places FROM y
UNION ALL SELECT 2, 'ldots', count(*), true, string_agg(paper || ':' || l || ':' || (length(body) + 11), ' ' ORDER BY j) FILTER (WHERE j <= 3) FROM y WHERE k % 2 = 1""",
    "gate_findings": f"""WITH {_V}, p AS (SELECT DISTINCT paper FROM v), q AS (SELECT * FROM p WHERE NOT (paper % 37 = 5 AND paper % 23 = 1))
SELECT 'files' AS gate, paper, 'left' AS side FROM q WHERE paper % 37 = 5 UNION ALL SELECT 'files', paper, 'right' FROM q WHERE paper % 23 = 1 OR paper % 29 = 2
UNION ALL SELECT 'parse', paper, 'left' FROM q WHERE paper % 37 <> 5 AND paper % 41 = 6 UNION ALL SELECT 'recount', paper, 'right' FROM q WHERE paper % 37 <> 5 AND paper % 23 <> 1 AND (paper % 29 = 2 OR paper % 31 = 3)""",
    "paper_digests": f"""WITH {_V}, a AS (SELECT paper, 1 AS section, k AS verse, nfc_normalize(body) || CASE WHEN paper % 4 = 1 THEN chr(8217) || 's' ELSE '' END AS text, CASE WHEN (paper + k) % 3 = 0 THEN '0-' || length(regexp_extract(body, '^[^ ]+')) ELSE '' END AS spans FROM v
UNION ALL SELECT DISTINCT paper, 2, 1, 'pair text', '' FROM v), d AS (SELECT paper, section, verse, sha256(paper || '|' || section || '|' || verse || '|' || text || '|' || spans) AS d FROM a),
s AS (SELECT paper, section, count(*) AS n, sha256(string_agg(d, '' ORDER BY verse, d)) AS d FROM d GROUP BY ALL)
SELECT paper, CAST(sum(n) AS BIGINT) AS verses, sha256(string_agg(d, '' ORDER BY section, d)) AS digest, CASE WHEN paper % 15 = 7 THEN 'gone' WHEN paper % 9 = 4 THEN 'changed' ELSE 'same' END AS change FROM s GROUP BY paper""",
    "book_report_lines": f"""WITH {_P} SELECT CAST(row_number() OVER (ORDER BY paper) - 1 AS BIGINT) AS place, concat('| ', paper, ' | ', left_verses, ' | ', right_verses, ' | ', common, ' | ', only_left, ' | ', only_right, ' | ', text_diffs, ' | ', italic_diffs, ' | ', status, ' |') AS line FROM t""",
    "tokens_in_sql": r"""WITH t AS (SELECT doc_id, string_split(replace(text, 'the ', '\hyp{}the '), chr(10)) AS ls FROM documents), l AS (SELECT doc_id, unnest(ls) AS x, generate_subscripts(ls, 1) AS k FROM t)
SELECT doc_id, CAST(k AS INTEGER) AS line, CAST(len(regexp_extract_all(x, '\\hyp|[{}\[\]]|%.*|[^\\{}\[\]%]+')) + 1 AS BIGINT) AS tokens, CAST(length(x) + 1 AS INTEGER) AS last FROM l""",
}
