"""Which of many endings texts have: one walk from a text's end, however many endings there are."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The key under which a node of the trie has its ending; no text has an empty character.
ENDING = ""


def reversed_trie(endings: Iterable[str]) -> dict:
    """Nodes by character, read backwards; a node that ends one has it under ENDING."""
    root: dict = {}
    for ending in endings:
        node = root
        for ch in reversed(ending):
            node = node.setdefault(ch, {})
        node[ENDING] = ending
    return root


def endings_of(text: str, trie: dict) -> list[str]:
    """The endings that ``text`` has, the shortest first; the walk stops where no ending goes on."""
    found, node = [], trie
    for k in range(len(text) - 1, -1, -1):
        node = node.get(text[k])
        if node is None:
            break
        if ENDING in node:
            found.append(node[ENDING])
    return found


def endings(texts: Column, known: Callable[[], list[str]]) -> Column:
    """array<string> of the endings each text has; ``known`` gives all endings, once in a worker's batch stream."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        trie = reversed_trie(known())
        for texts in batches:
            yield texts.map(lambda t: [] if t is None else endings_of(t, trie))

    return run(texts)
