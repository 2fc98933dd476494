"""Text columns: tokenising, delimited fields, formatting."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def without_last(col: Column, last: str) -> Column:
    """The text without one final ``last`` character, if it ends in one."""
    return F.when(col.endswith(last), F.left(col, F.length(col) - 1)).otherwise(col)


def lines(text) -> Column:
    """The lines of a text as a line reader would deliver them, but for a final ``\\r`` of each,
    which :func:`without_last` takes off."""
    c = F.col(text) if isinstance(text, str) else text
    whole = F.split(without_last(c, "\n"), "\n")
    return F.when(c != "", whole).otherwise(F.array().cast("array<string>"))


def words_on_space(line) -> Column:
    """Split on single blanks. Empty words between blanks stay, those at the end go;
    an empty line is one empty word, a line of blanks only has none."""
    c = F.col(line) if isinstance(line, str) else line
    cut = F.rtrim(c)
    return F.when((cut == "") & (c != ""), F.array().cast("array<string>")).otherwise(
        F.split(cut, " ")
    )


def words_on_whitespace(text) -> Column:
    """Split on every white-space character; the empty words are left to be dropped."""
    return F.split(text, r"\s")


def words_lowered(text) -> Column:
    """Lower-case and split on runs of non-word characters; empty words likewise."""
    return F.split(F.lower(text), r"\W+")


def field(parts: Column, index: int, dtype: str, strict: bool = True) -> Column:
    """Field ``index`` of a split line, trimmed and cast. A missing or malformed field
    fails the query when ``strict``, otherwise it is null."""
    if strict:
        return F.trim(F.element_at(parts, index + 1)).cast(dtype)
    return F.trim(F.try_element_at(parts, F.lit(index + 1))).try_cast(dtype)


def record_text(name: str, *cols: str) -> Column:
    """``Name(a,b,c)`` rendering of a row."""
    return F.concat(F.lit(f"{name}("), F.concat_ws(",", *cols), F.lit(")"))


def joined(sep: str, *cols) -> Column:
    return F.concat_ws(sep, *cols)
