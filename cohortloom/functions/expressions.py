"""Scalar Column expressions shared by the operators. All stay inside codegen."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text to replace in a procedure name, and its replacement.
NAME_REPLACEMENTS = ((" ", "_"), ("%", "percent"), ("'", ""))


def normalized_name(name: Column) -> Column:
    """Lower-case identifier form of a free-text name."""
    replaced = reduce(
        lambda text, pair: F.replace(text, F.lit(pair[0]), F.lit(pair[1])),
        NAME_REPLACEMENTS,
        name,
    )
    return F.lower(replaced)


def date_key_to_timestamp(date_key: Column) -> Column:
    """Midnight of a date key, without a time zone."""
    return date_key.cast("timestamp_ntz")


def int_date_key(yyyymmdd: Column) -> Column:
    """Date of an integer key such as 20150131."""
    return F.to_date(yyyymmdd.cast("string"), "yyyyMMdd")


def year_boundaries(start: Column, end: Column) -> Column:
    """Number of New Year's days crossed between two dates (not elapsed years)."""
    return F.year(end) - F.year(start)


def presence_flag(value: Column) -> Column:
    """1 when a value is there, 0 when it is NULL."""
    return value.isNotNull().cast("int")


def in_window(moment: Column, start: Column, end: Column) -> Column:
    """Half-open interval test: start is in, end is out."""
    return (moment >= start) & (moment < end)


def any_of(conditions: list[Column]) -> Column:
    """OR of the conditions, FALSE when there are none."""
    return reduce(lambda a, b: a | b, conditions) if conditions else F.lit(False)


def all_of(conditions: list[Column]) -> Column:
    """AND of the conditions, TRUE when there are none."""
    return reduce(lambda a, b: a & b, conditions) if conditions else F.lit(True)


# Up to this many patterns are ORed as LIKE tests. A long OR makes a generated
# method that the JVM does not compile; one regular expression does not. Both
# forms find the same texts: neither has an escape character.
LIKE_TESTS = 12


def _like_regex(pattern: str) -> str:
    """A regular expression that finds what a LIKE pattern matches."""
    start = "" if pattern.startswith("%") else "^"
    end = "" if pattern.endswith("%") else r"\z"
    wild = {"%": ".*", "_": "."}
    return start + "".join(wild.get(c) or re.escape(c) for c in pattern.strip("%")) + end


def _like(text: Column, pattern: str) -> Column:
    """LIKE in which the backslash is a character like any other."""
    unused = next(c for c in map(chr, range(1, len(pattern) + 2)) if c not in pattern)
    return F.like(text, F.lit(pattern), F.lit(unused))


def uncovered(patterns: Sequence[str]) -> list[str]:
    """The patterns without those that a plain ``%text%`` of the list covers.

    What ``%sacubitril%valsartan%`` matches contains valsartan, so ``%valsartan%``
    matches it too.
    """
    kept: list[str] = []
    plain: list[str] = []
    for pattern in sorted(dict.fromkeys(patterns), key=len):
        if any(core in run for core in plain for run in re.split("[%_]", pattern)):
            continue
        kept.append(pattern)
        core = pattern.strip("%")
        if core and pattern[0] == pattern[-1] == "%" and not re.search("[%_]", core):
            plain.append(core)
    return [p for p in dict.fromkeys(patterns) if p in kept]


def like_any(text: Column, patterns: Sequence[str], case_sensitive: bool = False) -> Column:
    """TRUE when ``text`` matches any LIKE pattern (``%`` and ``_``, no escapes).

    The patterns are literals, so Catalyst turns a short list into plain
    contains / prefix / suffix / equality tests.
    """
    if not case_sensitive:
        text = F.lower(text)
        patterns = [p.lower() for p in patterns]
    patterns = uncovered(patterns)
    if len(patterns) <= LIKE_TESTS:
        return any_of([_like(text, p) for p in patterns])
    # (?s) lets % span line breaks; "\z", unlike $, is the very end of the text.
    return text.rlike("(?s)" + "|".join(_like_regex(p) for p in patterns))
