"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NON_LETTERS = "[^a-zA-Z]+"


def letter_runs(text: Column) -> Column:
    """Split on every run of non-letters. Case is kept and edge tokens may be empty."""
    return F.split(text, NON_LETTERS)


def clean_words(text: Column) -> Column:
    """Array of lower-case letter-only words; the split comes before lower() on purpose, since
    lower() turns some non-ASCII capitals into ASCII letters."""
    return F.transform(F.filter(letter_runs(text), lambda w: w != ""), F.lower)


def space_split(text: Column) -> Column:
    """Split on single spaces and keep empty tokens."""
    return F.split(text, " ")


def first_match(text: Column, pattern: str) -> Column:
    """First match of ``pattern`` or an empty string."""
    return F.regexp_extract(text, f"({pattern})", 1)


def between(text: Column, left: str, right: str) -> Column:
    """Text after the first ``left`` up to the first ``right``; null when a marker is missing."""
    begin = F.locate(left, text) + len(left)
    end = F.locate(right, text)
    return F.when(
        (F.locate(left, text) > 0) & (end >= begin), text.substr(begin, end - begin)
    )


def after(text: Column, marker: str) -> Column:
    """Text behind the first ``marker``; null when it is missing."""
    at = F.locate(marker, text)
    return F.when(at > 0, text.substr(at + len(marker), F.length(text)))


def parse_floats(line: Column, sep: str = ",") -> Column:
    """Strip trailing white space, split, cast each field to double."""
    return F.transform(F.split(F.rtrim(line), sep), lambda x: F.trim(x).cast("double"))


def repeat_text(text: Column, times: int) -> Column:
    return F.repeat(text, times)


def build_path(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def format_number(pattern: str, value: Column) -> Column:
    return F.format_string(pattern, value)
