"""TeX-style papers: tokens as a table, and verses with italic spans.

Parsing a document is sequential by nature, so it is one Arrow-batched function
per document; documents are independent rows, and all that follows is relational.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from ..functions import macros as mc
from ..functions.spans import Runs, Spans, typeset
from ..schemas import PAPER, TOKEN
from ..sources.scratch import stored

_LEX = re.compile(r"\\(?:(?P<word>[^\W\d_]+)[ \t]*|(?P<sign>.)|(?P<lone>\Z))|(?P<group>[{}\[\]])|%(?P<note>[^\n]*)|(?P<line>\n)|(?P<text>[^\\{}\[\]%\n]+)", re.DOTALL)
_GROUP = {"{": "OPEN_BRACE", "}": "CLOSE_BRACE", "[": "OPEN_BRACKET", "]": "CLOSE_BRACKET"}
_LENGTH = re.compile(r"[+-]?\d+(?:\.\d+)?(?:pt|em|ex|mm|cm|in|bp|pc|sp|mu)")
_VERSE = re.compile(r"\s*p(\d+)\s+(\d+):(\d+)(?:\s+(.*))?$", re.DOTALL)
FILE = re.compile(r"p(\d{3,})\.tex$")


def tokens(src: str, line: int = 1) -> list[tuple[str, str, int, int]]:
    """(kind, value, line, column) of each token; lines count from ``line``, columns from 1."""
    out, start = [], 0
    for m in _LEX.finditer(src):
        at = (line, m.start() - start + 1)
        kind = m.lastgroup
        if kind in ("word", "sign", "lone"):
            out.append(("MACRO", m[kind], *at))
        elif kind == "group":
            out.append((_GROUP[m[kind]], m[kind], *at))
        elif kind == "note":
            out.append(("COMMENT", m[kind], *at))
        elif kind == "line":
            out.append(("NEWLINE", "\n", *at))
        else:
            out.append(("TEXT", m[kind], *at))
        if kind in ("line", "sign") and m[kind] == "\n":
            if kind == "line":
                line, start = line + 1, m.end()
    return out


class MarkupError(ValueError):
    pass


class Cursor:
    """A place in a list of tokens; text tokens may be shortened in place of being consumed."""

    def __init__(self, items: list[tuple]) -> None:
        self.items, self.at = list(items), 0

    def here(self) -> tuple | None:
        return self.items[self.at] if self.at < len(self.items) else None

    def bite(self, size: int) -> str:
        """Takes ``size`` characters off the text token here."""
        kind, value, *place = self.items[self.at]
        if size < len(value):
            self.items[self.at] = (kind, value[size:], *place)
        else:
            self.at += 1
        return value[:size]

    def enclosed(self, opening: str, closing: str) -> list[tuple] | None:
        """The tokens of a balanced group that comes next, behind white space; else nothing is consumed."""
        k = self.at
        while k < len(self.items) and (self.items[k][0] == "NEWLINE" or self.items[k][0] == "TEXT" and not self.items[k][1].strip()):
            k += 1
        if k >= len(self.items) or self.items[k][0] != opening:
            return None
        depth, begin = 1, k + 1
        for j in range(begin, len(self.items)):
            depth += (self.items[j][0] == opening) - (self.items[j][0] == closing)
            if not depth:
                self.at = j + 1
                return self.items[begin:j]
        return None

    def argument(self) -> list[tuple] | None:
        return self.enclosed("OPEN_BRACE", "CLOSE_BRACE")


def source(items: list[tuple] | None) -> str:
    """Tokens written out again; a word macro gets one space."""
    parts = []
    for kind, value, *_ in items or []:
        parts.append({"MACRO": f"\\{value}" + " " * value[:1].isalpha(), "COMMENT": f"%{value}"}.get(kind, value))
    return "".join(parts)


def flatten(cur: Cursor, out: Runs, seen: list[str], italic: bool = False) -> None:
    """Adds text up to a boundary macro, a closing brace or the end."""
    while (tok := cur.here()) is not None and tok[0] != "CLOSE_BRACE":
        kind, value = tok[0], tok[1]
        if kind == "MACRO":
            if value in mc.BOUNDARIES:
                return
            cur.at += 1
            italic = _macro(cur, out, seen, italic, value, tok)
            continue
        cur.at += 1
        if kind == "NEWLINE":
            out.add(" ", italic)
        elif kind == "OPEN_BRACE":
            flatten(cur, out, seen, italic)
            if (end := cur.here()) is not None and end[0] == "CLOSE_BRACE":
                cur.at += 1
        elif kind != "COMMENT":
            out.add(value, italic)


def _macro(cur: Cursor, out: Runs, seen: list[str], italic: bool, name: str, tok: tuple) -> bool:
    """One macro's effect; returns whether what follows in the group is italic."""
    if name == "makeatletter":
        while (t := cur.here()) is not None:
            cur.at += 1
            if t[:2] == ("MACRO", "makeatother"):
                break
        return italic
    if name == "makeatother":
        return italic
    macro = mc.TABLE.get(name)
    if macro is None:
        raise MarkupError(f"unknown macro \\{name} at {tok[2]}:{tok[3]}")
    seen.append(name)
    after = cur.here()
    if name in mc.STARRED and after is not None and after[0] == "TEXT" and after[1][0] == "*":
        cur.bite(1)
    if name == "itshape":
        return True
    if name in ("begin", "end"):
        env = source(cur.argument())
        if name == "begin":
            cur.enclosed("OPEN_BRACKET", "CLOSE_BRACKET")
        if env not in mc.ENVIRONMENTS:
            raise MarkupError(f"unknown environment {env!r} at {tok[2]}:{tok[3]}")
        if name == "begin" and env == "multicols":
            cur.argument()
        return italic
    for _ in range(macro.optional):
        cur.enclosed("OPEN_BRACKET", "CLOSE_BRACKET")
    given: list[list[tuple]] = []
    for _ in range(macro.args):
        arg = cur.argument()
        if arg is None and name in mc.BARE_LENGTH:
            t = cur.here()
            if t is not None and t[0] == "TEXT" and (m := _LENGTH.match(t[1])):
                cur.bite(m.end())
        given.append(arg or [])
    if macro.action == mc.TEXT:
        out.add(macro.text, italic)
    elif macro.action in (mc.ARG, mc.ITALIC_ARG):
        flatten(Cursor(given[macro.which - 1]), out, seen, italic or macro.action == mc.ITALIC_ARG)
    return italic


def plain(items: list[tuple] | None) -> str:
    """Title text of an argument."""
    runs = Runs()
    flatten(Cursor(items or []), runs, [])
    return typeset(runs.text(), [])[0]


class _Paper:
    """Sections and verses of one paper as they are met."""

    def __init__(self, number: int) -> None:
        self.number, self.head = number, dict.fromkeys(("title", "subtitle", "author"))
        self.sections: list[dict] = []
        self.verses: list[dict] = []
        self.counter, self.poetic, self.key, self.taken = 0, False, None, 0
        self.fresh()

    def fresh(self) -> None:
        self.runs, self.seen = Runs(), []

    def flush(self) -> None:
        if self.key is not None:
            text, spans = typeset(self.runs.text(), self.runs.spans())
            if text or spans:
                self.verses.append(dict(section=self.key[0], verse=self.key[1], text=text, italics=_rows(spans), macros_seen=self.seen, floater=False, ord=self.taken + len(self.verses)))
        self.fresh()

    def take(self) -> list[dict]:
        """The verses since the last call."""
        out, self.verses = self.verses, []
        self.taken += len(out)
        return out

    def heading(self, numbers: list[int], title: str) -> None:
        self.flush()
        self.poetic, self.key = False, None
        self.counter = numbers[-1]
        pair = len(numbers) > 1
        self.sections += [dict(n=n, title=title, combined=pair, combined_with=sum(numbers) - n if pair else None) for n in numbers]

    def line_end(self) -> None:
        if not self.poetic:
            return
        if self.runs.text().strip():
            key = self.key
            self.flush()
            self.key = key and (key[0], key[1] + 1)
        else:
            self.fresh()


def _rows(spans: Spans) -> list[dict]:
    return [{"s": s, "e": e} for s, e in spans]


def _number(items: list[tuple] | None) -> int:
    return int(source(items).strip())


def _read(cur: Cursor, paper: _Paper) -> None:
    """Goes on with a paper; its last verse stays open."""
    number = paper.number
    while (tok := cur.here()) is not None:
        name = tok[1] if tok[0] == "MACRO" and tok[1] in mc.BOUNDARIES else None
        if name is None:
            flatten(cur, paper.runs, paper.seen)
            if (tok := cur.here()) is not None and tok[0] == "CLOSE_BRACE":
                cur.at += 1
            continue
        cur.at += 1
        if name == "upaper":
            own, title = cur.argument(), cur.argument()
            if _number(own) != number:
                raise MarkupError(f"paper number {source(own)!r} in file {number}")
            paper.head["title"] = plain(title)
        elif name == "upapertitle":
            paper.head["subtitle"] = plain(cur.argument())
        elif name == "author":
            paper.head["author"] = plain(cur.argument())
        elif name == "usection":
            paper.heading([paper.counter + 1], plain(cur.argument()))
        elif name == "usectiontwo":
            cur.argument()
            paper.heading([paper.counter + 1, paper.counter + 2], plain(cur.argument()))
        elif name == "vs":
            paper.flush()
            paper.poetic = False
            t = cur.here()
            m = _VERSE.match(t[1]) if t is not None and t[0] == "TEXT" else None
            if m is None or int(m[1]) != number:
                raise MarkupError(f"bad verse header at {tok[2]}:{tok[3]}")
            cur.at += 1
            paper.key = (int(m[2]), int(m[3]))
            paper.runs.add(m[4] or "")
        elif name == "vsmark":
            paper.key = (_number(cur.argument()), _number(cur.argument()))
            paper.poetic = True
        elif name == "printvssuper":
            paper.flush()
            paper.key, paper.poetic = (paper.counter, _number(cur.argument())), True
        else:
            paper.line_end()


def extract(src: str, number: int) -> dict:
    """Header, sections and verses of one paper; raises MarkupError."""
    paper = _Paper(number)
    _read(Cursor(tokens(src)), paper)
    paper.flush()
    return dict(paper.head, sections=paper.sections, verses=paper.verses)


#: Characters of a source that are parsed at a time, where it can be cut.
PIECE_CHARS = 1_000_000


def whole(items: list[tuple]) -> bool:
    """Whether nothing that these tokens open is still open at their end: braces, brackets, a part between makeatletter and makeatother."""
    depth, inner = {"BRACE": 0, "BRACKET": 0}, False
    for kind, value, *_ in items:
        if kind == "MACRO":
            inner = (inner or value == "makeatletter") and value != "makeatother"
        elif kind.startswith("OPEN_"):
            depth[kind[5:]] += 1
        elif kind.startswith("CLOSE_"):
            depth[kind[6:]] = max(0, depth[kind[6:]] - 1)
    return not inner and not any(depth.values())


def parts(lines: Iterator[str], size: int) -> Iterator[list[tuple]]:
    """Tokens of a source, given line by line, in parts of about ``size`` characters.

    It is cut before lines that open a verse, where nothing is open: there a parser of the
    whole source would be at its top level too.  A source that can't be cut is one part.
    """
    held, n, wanted, at = [], 0, size, 1
    for line in lines:
        if n >= wanted and line.startswith("\\vs "):
            items = tokens("".join(held), at)
            if whole(items):
                yield items
                at += len(held)
                held, n, wanted = [], 0, size
            else:
                wanted *= 2
        held.append(line + "\n")
        n += len(line) + 1
    if held:
        yield tokens("".join(held)[:-1], at)


def extract_pieces(lines: Iterator[str], number: int, size: int | None = None) -> Iterator[dict]:
    """What ``extract`` gives, in pieces: verses as they are read, at last the header with all sections and no verses; raises MarkupError."""
    paper = _Paper(number)
    for items in parts(lines, size or PIECE_CHARS):
        _read(Cursor(items), paper)
        if paper.verses:
            yield dict(sections=[], verses=paper.take())
    paper.flush()
    yield dict(sections=[], verses=paper.take())
    yield dict(paper.head, sections=paper.sections, verses=[])


def parsed(files: DataFrame, parse: Callable[[str, int], dict], name: re.Pattern) -> DataFrame:
    """One row per (path, src) file, schema PAPER; a file that can't be parsed has ``error`` set."""
    schema = to_arrow_schema(files.sparkSession.createDataFrame([], PAPER).schema)

    def paper(path: str | None, src: str | None) -> dict:
        m = name.search(path or "")
        row = dict(path=path, paper=int(m[1]) if m else None, title=None, subtitle=None, author=None, sections=[], verses=[], error=None)
        try:
            if m is None:
                raise MarkupError(f"not a paper file: {path}")
            return row | parse(src or "", int(m[1]))
        except (MarkupError, ValueError) as e:
            return row | dict(error=str(e))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                some = b.slice(lo, 256)
                yield pa.RecordBatch.from_pylist([paper(*x) for x in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True)], schema=schema)

    return files.select("path", "src").mapInArrow(run, PAPER)


def tex_pieces(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(headers, verses), both of schema PAPER, of TeX files given as lines (path, place, line): a paper's verses are in as many rows as its source has parts.

    A file's lines go through one task in order, but no row and no task holds a whole file;
    of a file that can't be parsed there is the header with its ``error`` and no verse.
    """
    columns = f"{PAPER}, is_head boolean"
    schema = to_arrow_schema(lines.sparkSession.createDataFrame([], columns).schema)

    def rows(path: str, own: Iterator[str]) -> Iterator[dict]:
        m = FILE.search(path)
        row = dict(path=path, paper=int(m[1]) if m else None, title=None, subtitle=None, author=None, sections=[], verses=[], error=None, is_head=False)
        try:
            if m is None:
                raise MarkupError(f"not a paper file: {path}")
            for piece in extract_pieces(own, int(m[1])):
                yield row | piece | dict(is_head=not piece["verses"] and "title" in piece)
        except (MarkupError, ValueError) as e:
            yield row | dict(error=str(e), is_head=True)
            for _ in own:  # the next file's lines come behind these
                pass

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = (x for b in batches for x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        for path, own in groupby(every, lambda x: x[0]):
            for row in rows(path, (line for _, line in own)):
                yield pa.RecordBatch.from_pylist([row], schema=schema)

    dealt = lines.repartition("path").sortWithinPartitions("path", "place").select("path", "line")
    found = stored(dealt.mapInArrow(run, columns), "pieces")
    heads = found.where("is_head").drop("is_head")
    broken = heads.where("error is not null").select("path")
    return heads, found.where("not is_head").drop("is_head").join(broken, "path", "left_anti")


def tex_papers(files: DataFrame) -> DataFrame:
    """Papers of TeX files."""
    return parsed(files, extract, FILE)


def token_table(files: DataFrame, *, id_col: str = "path", src_col: str = "src") -> DataFrame:
    """(id, ord, kind, value, line, col): a row per token."""

    kinds = [to_arrow_type(files.schema[id_col].dataType), pa.int32(), pa.string(), pa.string(), pa.int32(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 64):
                some = b.slice(lo, 64)
                out = [(i, k, *t) for i, src in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True) for k, t in enumerate(tokens(src or ""))]
                columns = zip(*out, strict=True) if out else [[]] * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    kind, names = files.schema[id_col].dataType.simpleString(), [id_col, "ord", "kind", "value", "line", "col"]
    return files.select(id_col, src_col).mapInArrow(run, f"`{id_col}` {kind}, {TOKEN}")


_TOKEN = T.StructType([T.StructField(n, T.StringType() if k == "string" else T.IntegerType()) for n, k in (x.split() for x in TOKEN.split(", "))])


@F.udtf(returnType=_TOKEN)
class Tokenize:
    """SQL: ``SELECT ... FROM t, LATERAL tokenize(t.src)`` after ``register``."""

    def eval(self, src: str):  # noqa: ANN201
        for k, t in enumerate(tokens(src or "")):
            yield (k, *t)


@F.udtf
class TokenTable:
    """SQL: ``SELECT ... FROM token_table(TABLE(files) PARTITION BY path)`` after ``register``; the files' first two columns are their key and source."""

    @staticmethod
    def analyze(files: AnalyzeArgument) -> AnalyzeResult:
        if not files.isTable or len(files.dataType.fields) < 2:
            raise ValueError("token_table takes a table whose first two columns are a key and a source")
        return AnalyzeResult(T.StructType([T.StructField(files.dataType.fields[0].name, files.dataType.fields[0].dataType), *_TOKEN.fields]))

    def eval(self, row: Row):  # noqa: ANN201
        for k, t in enumerate(tokens(row[1] or "")):
            yield (row[0], k, *t)


def register(spark: SparkSession) -> None:
    spark.udtf.register("tokenize", Tokenize)
    spark.udtf.register("token_table", TokenTable)
