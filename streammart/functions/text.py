"""Splitting search text into words.

One rule, for any dictionary: read the lower-cased text from left to right; where a dictionary
entry stands, the longest one is a word; else a run of letters, digits and combining marks of any
script but Han is a word; else a Han character is a word; anything else separates.  An entry never
begins or ends inside a run, so ``c`` does not match in ``cat``, while ``c++`` or ``t恤`` match.

In smart mode entries that overlap are not taken from the left: of all ways to lay entries side by
side the text is cut by the one that covers most characters, of these the one with fewest entries, of
these the one whose entries stand furthest to the right (largest sum of starts).  What lies between is cut
as above.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A character of a run, for Java's regular expressions and for Python's.
_RUN_JVM = r"[\p{L}\p{N}\p{M}&&[^\p{IsHan}]]"
_RUN = r"[[\p{L}\p{N}\p{M}]--\p{Han}]"
WORD_PATTERN = _RUN_JVM + r"+|\p{IsHan}"


def _entries(dictionary: Iterable[str]) -> list[str]:
    return sorted({w.lower() for w in dictionary if w})


def words(text: Column | str, dictionary: Iterable[str] = (), smart: bool = False) -> Column:
    """The words of a text as an array, in order, duplicates kept; null for a null text.

    Without a dictionary this stays in the JVM; with one it is a vectorised function, the same for
    every size of the dictionary, which is sent to each executor.
    """
    column = F.col(text) if isinstance(text, str) else text
    entries = _entries(dictionary)
    if entries:
        return _dictionary_words(entries, smart)(F.lower(column))
    return F.regexp_extract_all(F.lower(column), F.lit(f"({WORD_PATTERN})"), F.lit(1))


#: Automata of this process, by digest of their entries: built once, whatever the number of batches.
_built: dict[str, Callable[[str, bool], list[str]]] = {}


def _automaton(digest: str, entries: list[str]) -> Callable[[str, bool], list[str]]:
    if digest not in _built:
        _built[digest] = _splitter(entries)
    return _built[digest]


def _splitter(entries: list[str]) -> Callable[[str, bool], list[str]]:
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for entry in entries:
        automaton.add_word(entry, len(entry))
    automaton.make_automaton()
    one_run = regex.compile(_RUN, regex.V1)
    between = regex.compile(_RUN + r"+|\p{Han}", regex.V1)

    def matches(text: str) -> Iterator[tuple[int, int]]:
        """(begin, end) of every entry in the text that cuts no run, by end."""
        inside = lambda at: 0 < at < len(text) and one_run.match(text[at - 1]) and one_run.match(text[at])
        for last, size in automaton.iter(text):
            if not inside(last + 1 - size) and not inside(last + 1):
                yield last + 1 - size, last + 1

    def longest(text: str) -> list[tuple[int, int]]:
        """From the left, the longest entry at each place."""
        ends: dict[int, int] = {}
        for begin, end in matches(text):
            ends[begin] = max(end, ends.get(begin, end))
        taken, at = [], 0
        for begin in sorted(ends):
            if begin >= at:
                at = ends[begin]
                taken.append((begin, at))
        return taken

    def best(text: str) -> list[tuple[int, int]]:
        """The best path through the graph of entries; places between entries are steps without value."""
        ends, values, backs = [0], [(0, 0, 0)], [None]
        for begin, end in matches(text):
            # Where the path to ``begin`` stands: the last place at or before it where an entry ends.
            low, high = 0, len(ends) - 1
            while low < high:
                mid = (low + high + 1) // 2
                low, high = (mid, high) if ends[mid] <= begin else (low, mid - 1)
            covered, count, starts = values[low]
            value = (covered + end - begin, count - 1, starts + begin)
            if ends[-1] != end:
                ends.append(end)
                values.append(values[-1])
                backs.append((None, len(ends) - 2))
            # At a tie the entry that begins further right is taken.
            if value > values[-1] or (value == values[-1] and (backs[-1][0] is None or begin > backs[-1][0][0])):
                values[-1], backs[-1] = value, ((begin, end), low)
        taken, at = [], len(ends) - 1
        while backs[at] is not None:
            entry, at = backs[at]
            if entry:
                taken.append(entry)
        return taken[::-1]

    def split(text: str, smart: bool) -> list[str]:
        found, at = [], 0
        for begin, end in best(text) if smart else longest(text):
            found.extend(between.findall(text, at, begin))
            found.append(text[begin:end])
            at = end
        found.extend(between.findall(text, at))
        return found

    return split


def _dictionary_words(entries: list[str], smart: bool):
    digest = hashlib.sha256("\0".join(entries).encode()).hexdigest()
    spark = SparkSession.getActiveSession()
    sent = spark.sparkContext.broadcast(entries)

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def split(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cut = _automaton(digest, sent.value)
        for texts in batches:
            for some in _pieces(texts):
                yield some.map(lambda t: None if t is None else cut(t, smart))

    return split


#: Characters whose words a Python worker holds at once, unless one text is longer.
PIECE = 1 << 18


def _pieces(texts: pd.Series, size: int = PIECE) -> Iterator[pd.Series]:
    """The texts in order, cut into runs of at most ``size`` characters or one text."""
    begin, held = 0, 0
    for at, text in enumerate(texts):
        length = len(text) if text is not None else 0
        if at > begin and held + length > size:
            yield texts.iloc[begin:at]
            begin, held = at, 0
        held += length
    yield texts.iloc[begin:]


def register_word_table(
    spark: SparkSession, name: str = "ik_analyze", dictionary: Iterable[str] = (), smart: bool = False
) -> None:
    """Register a table function for ``LATERAL name(text)`` in SQL, with the words of ``words()``."""
    entries = _entries(dictionary)
    pattern = f"({WORD_PATTERN})".replace("\\", "\\\\")
    found = f"regexp_extract_all(lower(txt), '{pattern}', 1)"
    if entries:
        spark.udf.register(f"{name}_words", _dictionary_words(entries, smart))
        found = f"{name}_words(lower(txt))"
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(txt STRING) RETURNS TABLE(word STRING) "
        f"RETURN SELECT explode({found})"
    )
