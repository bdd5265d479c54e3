"""Tokenizer, both extractors, floaters, and the SQL table function."""

import pytest

from quirefold.functions.macros import TABLE, macro_table
from quirefold.operators import html, tex
from quirefold.operators.html import drop_floaters
from quirefold.sources.files import verses_of


def kinds(src):
    return [(k, v) for k, v, *_ in tex.tokens(src)]


@pytest.mark.parametrize(
    ("src", "want"),
    [
        ("hello world", [("TEXT", "hello world")]),
        ("\\pc  x", [("MACRO", "pc"), ("TEXT", "x")]),
        ("a\\-b\\\\c", [("TEXT", "a"), ("MACRO", "-"), ("TEXT", "b"), ("MACRO", "\\"), ("TEXT", "c")]),
        ("{x}[y]", [("OPEN_BRACE", "{"), ("TEXT", "x"), ("CLOSE_BRACE", "}"), ("OPEN_BRACKET", "["), ("TEXT", "y"), ("CLOSE_BRACKET", "]")]),
        ("a% note\nb", [("TEXT", "a"), ("COMMENT", " note"), ("NEWLINE", "\n"), ("TEXT", "b")]),
        ("end\\", [("TEXT", "end"), ("MACRO", "")]),
        ("\\par\nx", [("MACRO", "par"), ("NEWLINE", "\n"), ("TEXT", "x")]),
        ("well\\hyp{}known", [("TEXT", "well"), ("MACRO", "hyp"), ("OPEN_BRACE", "{"), ("CLOSE_BRACE", "}"), ("TEXT", "known")]),
    ],
)
def test_tokens(src, want):
    assert kinds(src) == want


def test_token_places():
    assert [(v, line, col) for _, v, line, col in tex.tokens("ab\n\\vs  c{d}")] == [("ab", 1, 1), ("\n", 1, 3), ("vs", 2, 1), ("c", 2, 6), ("{", 2, 7), ("d", 2, 8), ("}", 2, 9)]


def test_arguments():
    cur = tex.Cursor(tex.tokens(" \n{a{b}\\hyp{}c}[o[p]]{open"))
    assert tex.source(cur.argument()) == "a{b}\\hyp {}c"
    assert tex.source(cur.enclosed("OPEN_BRACKET", "CLOSE_BRACKET")) == "o[p]"
    at = cur.at
    assert cur.argument() is None and cur.at == at


PAPER = r"""\upaper{7}{A \bibemph{Fine} Title}
\author{Some \textsc{One}}
% a comment with \nosuchmacro
\vs p007 0:1 First --- part\fnc{note \bibemph{x}} and ``q'' $2\times 10^{27}$ ok.
\usection{One~Head}
\vs p007 1:1 \pc Well\hyp{}known \bibemph{slanted words} here.
next line {\hspace*{1em}\itshape leaning} upright \tunemarkup{t}{\kern1pt}done\kern-1pt{}.
\vs p007 1:2 \begin{quoting}[x]quoted\end{quoting} \makeatletter\write@mark{z}\makeatother kept\\[1ex]joined
\usectiontwo{2 and 3}{Both \ldots}
\vs p007 2:1 \makebox[1cm][l]{boxed} 606\ts{th}\linebreak[2]x
\printvssuper{4} \bibemph{line} one\par
line two\par
\vsmark{9}{1}marked\par
"""


def test_extract_tex():
    got = tex.extract(PAPER, 7)
    assert (got["title"], got["author"], got["subtitle"]) == ("A Fine Title", "Some One", None)
    assert [(s["n"], s["title"], s["combined"], s["combined_with"]) for s in got["sections"]] == [(1, "One Head", False, None), (2, "Both ...", True, 3), (3, "Both ...", True, 2)]
    v = {(x["section"], x["verse"]): (x["text"], [x["text"][i["s"] : i["e"]] for i in x["italics"]]) for x in got["verses"]}
    assert v[0, 1] == ("First \u2014 part and ``q'' 2 x 10^27 ok.".replace("^27", "^27"), []) or v[0, 1][0] == "First \u2014 part and ``q'' 2 x 10^27 ok."
    assert v[1, 1] == ("Well-known slanted words here. next line leaning upright done.", ["slanted words", "leaning"])
    assert v[1, 2] == ("quoted keptjoined", [])
    assert v[2, 1] == ("boxed 606th x", [])
    assert v[3, 4] == ("line one", ["line"]) and v[3, 5] == ("line two", [])
    assert v[9, 1] == ("marked", [])
    assert got["verses"][1]["macros_seen"] == ["pc", "hyp", "bibemph", "hspace", "itshape", "tunemarkup", "kern"]


@pytest.mark.parametrize("src", ["\\upaper{8}{x}", "\\vs p007 1:1 \\mystery", "\\vs p007 1:1 \\begin{tabular}x", "\\vs p008 1:1 x", "\\vs nonsense"])
def test_tex_errors(src):
    with pytest.raises(tex.MarkupError):
        tex.extract(src, 7)


PAGE = """<nav><p id="x">no</p></nav><h1 id="U7_0_0">Paper 7. A  Fine Title</h1>
<h2 id="U7_1_0">1. One Head</h2><h2 id="U7_3_0">2. and 3. Both ...</h2><h2 id="U7_4_0">IV. Roman</h2>
<p id="U7_0_1"><small>0:1</small>IF THE Finite x</p>
<p id="U7_1_1"><small>1:1.1 (2.3)</small> Well <em>slanted <span class="scaps">caps</span></em> 10<sup>27</sup> 606<sup>th</sup><span class="dot">....</span><em></em> <small>kept</small></p>
<p id="U7_1_2">plain</p><p id="U7_1_2F">* * *</p><p id="U7_1_3F">alone</p><p id="U8_1_1">other paper</p>"""


def test_extract_html():
    got = html.extract(PAGE, 7)
    assert got["title"] == "A Fine Title"
    assert [(s["n"], s["title"], s["combined_with"]) for s in got["sections"]] == [(1, "One Head", None), (2, "Both ...", 3), (3, "Both ...", 2), (4, "Roman", None)]
    v = {(x["section"], x["verse"], x["floater"]): (x["text"], [x["text"][i["s"] : i["e"]] for i in x["italics"]]) for x in got["verses"]}
    assert v[0, 1, False] == ("If the Finite x", [])
    assert v[1, 1, False] == ("Well slanted CAPS 10^27 606th kept", ["slanted CAPS"])
    assert len(v) == 5
    with pytest.raises(tex.MarkupError):
        html.extract('<h2 id="U7_9_0">2. and 3. x</h2>', 7)


def test_opener():
    assert html.plain_opener("THE FIRST Cause") == "The first Cause"
    assert html.plain_opener("A GREAT, thing") == "A great, thing"
    assert html.plain_opener("Plain THE") == "Plain THE"


def test_frames(spark):
    files = spark.createDataFrame([("p007.tex", PAPER), ("p008.tex", "\\mystery"), ("notes.tex", "x"), ("p009.tex", None)], "path string, src string")
    rows = {r.path: r for r in tex.tex_papers(files).collect()}
    assert len(rows["p007.tex"].verses) == 7 and rows["p007.tex"].error is None
    assert "unknown macro" in rows["p008.tex"].error and "not a paper" in rows["notes.tex"].error and rows["p009.tex"].verses == []
    pages = spark.createDataFrame([("ThePaper007.html", PAGE)], "path string, src string")
    left = {(r.section, r.verse): r.text for r in drop_floaters(verses_of(html.html_papers(pages))).collect()}
    assert left == {(0, 1): "If the Finite x", (1, 1): "Well slanted CAPS 10^27 606th kept", (1, 2): "plain", (1, 3): "alone"}


def test_table_function(spark):
    tex.register(spark)
    spark.createDataFrame([(1, "a\\pc b"), (2, "")], "id int, src string").createOrReplaceTempView("sources")
    rows = spark.sql("SELECT id, t.kind, t.value FROM sources, LATERAL tokenize(src) t ORDER BY t.ord").collect()
    assert [tuple(r) for r in rows] == [(1, "TEXT", "a"), (1, "MACRO", "pc"), (1, "TEXT", "b")]


def test_macro_table(spark):
    rows = macro_table(spark).groupBy("action").count().collect()
    assert {r.action: r["count"] for r in rows} == {"STRIP": 31, "STRUCTURAL": 10, "EMIT_TEXT": 9, "EMIT_ARG": 6, "EMIT_ARG_ITALIC": 2} and len(TABLE) == 58


def test_pieces_equal_the_whole(monkeypatch):
    """A paper read in parts gives what it gives as a whole, wherever something is still open at a line that begins like a verse."""
    from quirefold.operators import tex

    verse = lambda k, x: f"\\vs p007 1:{k} {x}"
    plain = [verse(k, f"word {k} \\bibemph{{b}} [c] x") for k in range(12)]
    odd = {
        "plain": plain,
        "open group": [*plain[:3], verse(3, "a {\\itshape b"), *plain[4:8], "c} d", *plain[8:]],
        "argument over verses": [*plain[:3], verse(3, "a\\fnc{b"), *plain[4:8], "c} d", *plain[8:]],
        "bracket over verses": [*plain[:3], verse(3, "a \\makebox[b"), *plain[4:8], "]{c} d", *plain[8:]],
        "never closed": [*plain[:3], verse(3, "a \\bibemph{b ["), *plain[4:]],
        "stray closing": [*plain[:3], verse(3, "a } b ] c {d}"), *plain[4:]],
        "hidden part": [*plain[:3], verse(3, "a \\makeatletter b"), *plain[4:8], "\\makeatother c", *plain[8:]],
        "head and lines": ["\\upaper{7}{T}", "\\author{A}", "\\usection{S}", *plain[:4], "\\printvssuper{5} a\\par", "b\\par", *plain[4:], "\\usectiontwo{2 and 3}{U}", "% \\vs p007 9:9 no", verse(90, "a % c {"), *plain],
    }
    for name, lines in odd.items():
        want = tex.extract("\n".join(lines), 7)
        for size in (1, 60, 200, 10_000):
            *pieces, head = tex.extract_pieces(iter(lines), 7, size)
            assert dict(head, verses=[v for p in pieces for v in p["verses"]]) == want, (name, size)
            assert name != "plain" or size > 60 or len(pieces) > 4
    broken = [*plain, verse(50, "a \\nosuchmacro b"), *plain]
    for size in (1, 10_000):
        try:
            list(tex.extract_pieces(iter(broken), 7, size))
            raise AssertionError("parsed")
        except tex.MarkupError as e:
            assert str(e) == "unknown macro \\nosuchmacro at 13:17"


def test_a_broken_file_has_no_verses(spark, monkeypatch):
    from quirefold.operators import tex

    monkeypatch.setattr(tex, "PIECE_CHARS", 1)
    rows = [(f"p00{p}.tex", k, f"\\vs p00{p} 1:{k} x" + (" \\nosuchmacro" if (p, k) == (1, 7) else "")) for p in (1, 2) for k in range(1, 10)]
    heads, verses = tex.tex_pieces(spark.createDataFrame(rows, "path string, place int, line string"))
    assert {r.paper: r.error is None for r in heads.collect()} == {1: False, 2: True}
    assert sorted(v.verse for r in verses.collect() for v in r.verses if r.paper == 2) == list(range(1, 10)) and {r.paper for r in verses.collect()} == {2}
