"""The macro table that tells how each macro of the markup becomes text."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

DROP, TEXT, ARG, ITALIC_ARG, STRUCTURE = "STRIP", "EMIT_TEXT", "EMIT_ARG", "EMIT_ARG_ITALIC", "STRUCTURAL"


@dataclass(frozen=True)
class Macro:
    action: str
    optional: int = 0
    args: int = 0
    which: int = 1
    text: str = ""


# Names, actions, argument counts and texts of the markup's macros.
STRUCTURE_ARGS = {"vs": 0, "vsmark": 2, "printvssuper": 1, "upaper": 2, "author": 1, "usection": 1, "usectiontwo": 2, "begin": 1, "end": 1, "itshape": 0}
DROPPED = """Large small separatorshort separatorline pc plusone plustwo minusone vsetoff hsetoff par newline relax newpage -
parindent baselineskip columnwidth linewidth makeatletter makeatother""".split()
DROPPED_ARGS = {"tunemarkup": (0, 2), "thispagestyle": (0, 1), "\\": (1, 0), "vspace": (1, 1), "hspace": (1, 1), "kern": (0, 1), "setlength": (0, 2), "fnc": (0, 1), "footnote": (0, 1), "write": (0, 1)}
TEXTS = {"hyp": (0, 1, "-"), "bibnobreakspace": (0, 0, " "), "ldots": (0, 0, "..."), "bibdf": (0, 0, ""), "linebreak": (1, 0, " "), "_": (0, 0, "_"), ",": (0, 0, " "), " ": (0, 0, " "), "times": (0, 0, " x ")}
KEPT_ARG = {"textcolor": (0, 2, 2), "ublistelem": (0, 1, 1), "textsc": (0, 1, 1), "preftitle": (0, 1, 1), "ts": (0, 1, 1), "makebox": (2, 1, 1)}
ITALIC = ["bibemph", "emph"]
STARRED = {"vspace", "hspace"}
BARE_LENGTH = {"kern", "vspace", "hspace"}
ENVIRONMENTS = {"quoting", "ubquote", "multicols"}
#: Macros that end a run of body text.
BOUNDARIES = {"vs", "vsmark", "printvssuper", "upaper", "upapertitle", "author", "usection", "usectiontwo", "par"}

TABLE: dict[str, Macro] = (
    {n: Macro(STRUCTURE, args=a) for n, a in STRUCTURE_ARGS.items()}
    | {n: Macro(DROP) for n in DROPPED}
    | {n: Macro(DROP, o, a) for n, (o, a) in DROPPED_ARGS.items()}
    | {n: Macro(TEXT, o, a, text=t) for n, (o, a, t) in TEXTS.items()}
    | {n: Macro(ARG, o, a, w) for n, (o, a, w) in KEPT_ARG.items()}
    | {n: Macro(ITALIC_ARG, args=1) for n in ITALIC}
)


def macro_table(spark: SparkSession) -> DataFrame:
    """The table as a small dimension (58 rows)."""
    rows = [(n, m.action, m.optional, m.args, m.which, m.text, n in STARRED, n in BARE_LENGTH) for n, m in sorted(TABLE.items())]
    return spark.createDataFrame(rows, "name string, action string, opt int, args int, which int, text string, starred boolean, bare_length boolean")
