"""Column expressions that several native operators use."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\f\r"
UPPER, LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Between words of letters and digits, after A-Z became a-z.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), the value computed once for each row: a lambda's variable is bound to it, where Catalyst would repeat an expression inside a lambda for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOW)


def space_words(text: Column) -> Column:
    """Words between blanks, tabs and line ends; none for null."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, r"[\x20\x09-\x0D]+"))


def space_word_count(text: Column) -> Column:
    """How many words space_words has, counted at their first characters."""
    return F.regexp_count(F.concat(F.lit(" "), F.coalesce(text, F.lit(""))), F.lit(r"[\x20\x09-\x0D][^\x20\x09-\x0D]")).cast("long")


def count_of(text: Column, chars: str) -> Column:
    """How many of these characters the text has."""
    return F.regexp_count(text, F.lit("[" + "".join(c if c.isalnum() else f"\\{c}" for c in chars) + "]"))


def total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda a, x: a + x)
