"""Small Column helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\s\x1c-\x1f]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with value evaluated once per row, also where body uses it inside a lambda."""
    return F.get(F.transform(F.array(value), body), 0)


#: Every white-space character: what ``SPACE`` matches under (?U).
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    """Without white space (of any script) at both ends; only the ends are looked at."""
    return F.btrim(c, F.lit(SPACES))


def squeeze(c: Column) -> Column:
    """Runs of blanks and tabs as one blank."""
    return F.regexp_replace(c, r"[ \t]+", " ")


def strip_chars(c: Column, chars: str, left: bool = True) -> Column:
    """Without any of ``chars`` at the end and, unless told otherwise, at the start."""
    return F.btrim(c, F.lit(chars)) if left else F.rtrim(c, F.lit(chars))


def capital(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.substr(c, F.lit(2)))


def non_blank(c: Column) -> Column:
    """NULL where nothing is left of the text."""
    return F.when(c != "", c)


def first_of_each(items: Column, key: Callable[[Column], Column]) -> Column:
    """The items of an array whose key occurs for the first time, in order (for short arrays)."""
    return let(items, lambda xs: let(F.transform(xs, key), lambda ks: F.filter(xs, lambda x, i: F.array_position(ks, F.get(ks, i)) == i + 1)))


def any_of(patterns: list[str]) -> str:
    return "(?:" + "|".join(patterns) + ")"
