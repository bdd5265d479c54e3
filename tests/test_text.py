"""Text and span functions against plain definitions."""

import random
import re
import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quirefold.functions import spans as sp
from quirefold.functions import text as tx

ODD = "a\u00a0b  c\u02bcd\u2009\u202fe\x1f\x85\u3000f \t\n g  "


def test_normalize_columns(spark):
    df = spark.createDataFrame([(ODD,), ("e\u0301",), ("",), (None,)], "t string")
    got = [r[0] for r in df.select(tx.normalize(F.col("t"))).collect()]
    assert got == ["a b c\u2019d e f g", "\u00e9", "", None]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab -~$\t\u00a0\u02bc", max_size=40), st.lists(st.tuples(st.integers(0, 45), st.integers(0, 45)), max_size=4))
def test_collapse_and_typeset(text, spans):
    out, moved = sp.collapse(text, spans)
    assert out == re.sub(r"\s+", " ", text).strip()
    assert all(0 <= s < e <= len(out) for s, e in moved) and moved == sp.merge(moved)
    printed, _ = sp.typeset(text, spans)
    plain = text.replace("---", "\u2014").replace("--", "\u2013").replace("~", " ").replace("$", "")
    assert printed == re.sub(r"\s+", " ", plain).strip()


def test_spans_follow_their_words():
    text = "  one --  two~$three$  end "
    for word in ("one", "two", "three", "end"):
        at = text.index(word)
        out, moved = sp.typeset(text, [(at, at + len(word))])
        assert [out[s:e] for s, e in moved] == [word]
    assert sp.typeset("a--b", [(1, 3)])[1] == [(1, 2)] and sp.typeset("a $ b", [(2, 3)])[1] == []
    assert sp.normalize("x  y", [(0, 2), (2, 3)]) == ("x y", [(0, 2)])


def test_normalize_spans(spark):
    df = spark.createDataFrame([(" a  b ", [(1, 3)]), (None, None), ("c", None)], "t string, i array<struct<s:int,e:int>>")
    got = [r[0] for r in df.select(tx.normalize_spans("t", "i")).collect()]
    assert (got[0].text, [tuple(x) for x in got[0].italics]) == ("a b", [(0, 2)])
    assert got[1].text is None and got[2].text == "c" and got[2].italics == []


def test_suspicious_merge_shift(spark):
    df = spark.createDataFrame([(ODD, [(5, 6), (0, 2), (2, 3)]), ("plain", [])], "t string, i array<struct<s:int,e:int>>")
    rows = df.select(tx.suspicious(F.col("t")).alias("g"), tx.merge_spans(F.col("i")).alias("m"), tx.shift_spans(F.col("i"), F.lit(10)).alias("s")).collect()
    assert rows[0].g == {"NBSP": 1, "NARROW_NBSP": 1, "THIN_SPACE": 1, "MODIFIER_APOSTROPHE": 1} and rows[1].g == {}
    assert [tuple(x) for x in rows[0].m] == [(0, 3), (5, 6)] and rows[1].m == []
    assert [tuple(x) for x in rows[0].s] == [(15, 16), (10, 12), (12, 13)]


def test_typeset_half_even_changes(spark):
    df = spark.createDataFrame([("a---b--c~d$", 0.5, "cat", "cart"), ("x", 1.5, "q", "q")], "t string, y double, a string, b string")
    rows = df.select(tx.typeset(F.col("t")).alias("p"), tx.half_even(F.col("y")).alias("n"), tx.changes("a", "b").alias("c")).collect()
    assert [r.p for r in rows] == ["a\u2014b\u2013c d", "x"] and [r.n for r in rows] == [0, 2]
    assert [(c.tag, c.left, c.right, c.before, c.after) for c in rows[0].c] == [("insert", "", "r", "ca", "t")] and rows[1].c == []


def test_list_openers(spark):
    src = "\\vs p001 1:1 \\ublistelem{1.} a\n\\pc \\vs p001 1:2 \\ublistelem{1.} b\n\\vs p001 1:3 c\n\\vs p001 1:4 \\ublistelem{2.} d"
    text, n = tx.mark_list_openers(F.col("s"))
    r = spark.createDataFrame([(src,)], "s string").select(text.alias("t"), n.alias("n")).first()
    assert r.n == 1 and r.t == "\\pc " + src


def test_composed():
    assert sp.normalize("e\u0301 x", [])[0] == unicodedata.normalize("NFC", "e\u0301 x")


def test_composed_texts_stay_in_the_jvm():
    """Of the code points taken as composed, each and each two together are what composition makes of them."""
    known = [chr(c) for c in range(0x11000) if not 0xD800 <= c < 0xE000 and in_class(c)]
    assert len(known) > 20_000 and all(unicodedata.is_normalized("NFC", c) and not unicodedata.combining(c) for c in known)
    rng = random.Random(0)
    assert all(unicodedata.is_normalized("NFC", rng.choice(known) + rng.choice(known)) for _ in range(50_000))


def in_class(c):
    return any(int(a, 16) <= c <= int(b, 16) for a, b in re.findall(r"\\x\{(\w+)\}-\\x\{(\w+)\}", tx.COMPOSED))


def test_both_ways_of_normalizing_agree(spark):
    rng = random.Random(4)
    rows = []
    for k in range(400):
        t = "".join(rng.choices("ab c\t\u00a0\u02bc\u2009é日-\u202f" + ("\u0301e" if k % 4 == 0 else ""), k=rng.randrange(30)))
        rows.append((k, t, [(rng.randrange(-2, 33), rng.randrange(-2, 33)) for _ in range(rng.randrange(4))]))
    rows += [(1000, None, None), (1001, "x", None)]
    df = spark.createDataFrame(rows, "k int, t string, i array<struct<s:int,e:int>>")
    got = {r.k: r for r in df.select("k", tx.is_composed(F.col("t")).alias("c"), tx.normalize_both(F.col("t"), F.col("i"), F.lit(True)).alias("n"), tx.normalize(F.col("t")).alias("p")).collect()}
    assert 250 < sum(r.c for r in got.values()) < 400
    for k, t, i in rows:
        want = (None, []) if t is None else sp.normalize(t, i or [])
        assert (got[k].n.text, [tuple(x) for x in got[k].n.italics]) == want and got[k].p == want[0], t


def test_composed_texts_are_not_sent_to_python(spark):
    df = spark.createDataFrame([("plain and é ’ —",)] * 50 + [("e\u0301",)], "t string")
    assert df.where(~tx.is_composed(F.col("t"))).count() == 1


def plain_places(text, pattern, change):
    """Where each place lands, character by character."""
    out, where, done = "", [], 0
    for m in re.finditer(pattern, text):
        new = change(m)
        where += range(len(out), len(out) + m.start() - done + 1)
        out += text[done : m.start()]
        where += [len(out) + len(new) if m[0].isspace() else len(out)] * (len(m[0]) - 1)
        out, done = out + new, m.end()
    return out + text[done:], where + list(range(len(out), len(out) + len(text) - done + 1))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab -~$\t  ", max_size=30), st.lists(st.tuples(st.integers(-1, 33), st.integers(-1, 33)), max_size=4))
def test_spans_by_their_places(text, spans):
    """Spans followed by their own places land where a map of all places puts them."""
    typed, first = plain_places(text, r"-{2,3}|[~$]", lambda m: {"---": "—", "--": "–", "~": " ", "$": ""}[m[0]])
    for function, start, steps in ((sp.collapse, text, list(range(len(text) + 1))), (sp.typeset, typed, first)):
        out, second = plain_places(start, f"{sp.SPACE}+", lambda m: "" if m.start() == 0 or m.end() == len(start) else " ")  # noqa: B023
        at = lambda p: min(second[steps[min(max(p, 0), len(text))]], len(out))  # noqa: B023, E731
        assert function(text, spans) == (out, sp.merge([(at(s), at(e)) for s, e in spans if at(s) < at(e)]))


def test_text_without_spans_needs_no_places(monkeypatch):
    monkeypatch.setattr(sp, "_collapsed_places", None)
    assert sp.typeset(" a -- b ", []) == ("a – b", []) and sp.collapse(" a  b ", []) == ("a b", [])


def test_spans_go_to_python_as_text(spark):
    """No array goes to the Python function: Spark tells a batch's size at each row, and with arrays that takes as long as the batch."""
    df = spark.createDataFrame([("e\u0301 x", [(0, 2)]), ("y", None), (None, [(0, 1)])], "t string, i array<struct<s:int,e:int>>")
    for made in (tx.normalize_spans(F.col("t"), F.col("i")), tx.normalize_both(F.col("t"), F.col("i"), F.lit(True))):
        out = df.select(made.alias("n"))
        assert re.search(r"_normalized\([^\n]*array_join\(", out._jdf.queryExecution().analyzed().toString())
        assert [r[0] and (r[0][0], [tuple(x) for x in r[0][1]]) for r in out.collect()] == [("\u00e9 x", [(0, 2)]), ("y", []), (None, [])]


def test_only_loose_text_is_collapsed(spark):
    spaces = [chr(c) for c in range(0x3001) if re.match(sp.SPACE, chr(c))]
    texts = [t for s in spaces for t in (s, f"{s}a", f"a{s}", f"a{s}b", f"a {s}b", f"\u4e00{s}b")] + ["", "a", "a b", "\u00e4 \u4e00"]
    got = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string").select("t", tx.is_loose(F.col("t")), tx.collapse(F.col("t"))).collect()
    assert all((loose, text) == (t != " ".join(t.split()), " ".join(t.split())) for t, loose, text in got if t is not None)
    assert tuple(got[-1]) == (None, None, None)
