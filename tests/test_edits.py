"""Character edits against the standard library's, which they have to equal."""

import difflib
import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quirefold.functions import edits as ed


def library(a, b):
    return [c for c in difflib.SequenceMatcher(None, a, b).get_opcodes() if c[0] != "equal"]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab cé", max_size=40), st.text(alphabet="ab cé", max_size=40), st.booleans())
def test_short_texts(a, b, by_place):
    held, ed.PAIRS = ed.PAIRS, 0 if by_place else ed.PAIRS
    try:
        assert ed.edits(a, b) == library(a, b)
    finally:
        ed.PAIRS = held


@pytest.mark.parametrize("pairs", [0, 1_000_000])
def test_texts_with_common_characters(monkeypatch, pairs):
    """From 200 characters on, common ones begin no block."""
    monkeypatch.setattr(ed, "PAIRS", pairs)
    rng = random.Random(pairs)
    letters = "etaoin shrdlu" * 6 + "cmfwypvbgkqjxz.,;" + "\U0001f600é"
    for n in (150, 199, 200, 201, 400, 1200):
        for _ in range(12):
            a = "".join(rng.choices(letters, k=n))
            b = list(a)
            for _ in range(rng.randrange(12)):
                k = rng.randrange(len(b))
                b[k : k + rng.randrange(3)] = rng.choices(letters, k=rng.randrange(4))
            assert ed.edits(a, "".join(b)) == library(a, "".join(b))


def test_long_texts_take_seconds():
    rng = random.Random(2)
    a = "".join(chr(0x4E00 + rng.randrange(120)) for _ in range(100_000))
    b = list(a)
    for k in rng.sample(range(100_000), 30):
        b[k] = "x"
    began = time.perf_counter()
    got = ed.edits(a, "".join(b))
    assert len(got) == 30 and all(t == "replace" and i2 - i1 == 1 for t, i1, i2, _, _ in got)
    assert time.perf_counter() - began < 60


def test_ends_that_differ_need_no_search(monkeypatch):
    """Texts that differ at one end only have the blocks that the search finds, without it."""
    rng, pairs = random.Random(5), []
    for n in (0, 1, 7, 199, 210, 450):
        for alphabet in ("a", "ab", "abcdefgh ", "abcdefghijklmnopqrstuvwxyz ,."):
            body = "".join(rng.choice(alphabet) for _ in range(n))
            pairs += [(x + body, y + body) for x, y in (("\u2603", ""), ("", "\u2604\u2604"), ("\u2603a", "\u2604"))] + [(body + "\u2603", body + "\u2604"), (body, body + "\u2602"), (body + "\u2603\u2605", body)]
    want = [ed.Matcher(*p).blocks() for p in pairs]
    found = [ed.at_one_end(*p) for p in pairs]
    assert all(f is None or f == w for f, w in zip(found, want, strict=True)) and sum(f is not None for f in found) > 100
    monkeypatch.setattr(ed, "Matcher", None)
    assert ed.edits("some text\u2603", "some text\u2604") == [("replace", 9, 10, 9, 10)]
    assert ed.edits("text " * 100, "\u2602" + "text " * 100) == [("replace", 0, 500, 0, 501)]  # common characters only
