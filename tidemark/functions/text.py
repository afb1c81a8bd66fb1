"""Escaped, separator-delimited text as column expressions.

One record is one line. A field writes its backslashes, separators, line feeds
and carriage returns with a leading backslash, so a separator that is not
escaped always ends a field. All steps are literal replacements and one split:
they run inside generated code and cost time linear in the text, however long.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The text formats that producers and consumers share.
SOH = "\x01"
SUB = "\x1a"
NULL_MARK = "\\N"
# letter after the backslash -> character, as COPY text writes them
COPY_ESCAPES = {"b": "\b", "f": "\f", "n": "\n", "r": "\r", "t": "\t", "v": "\v"}
# the subset a delimited table reader knows
LINE_ESCAPES = {"n": "\n", "r": "\r"}

# U+0000 cannot occur in the source databases' text, so it can mark places.
_MARK = "\x00"
_BACKSLASH = _MARK + "b"
_SEPARATOR = _MARK + "s"


def _swap(column: Column, old: str, new: str) -> Column:
    return F.replace(column, F.lit(old), F.lit(new))


def checked(text: Column) -> Column:
    """The text itself; fails the query where it holds U+0000."""
    return F.when(F.contains(text, F.lit(_MARK)),
                  F.raise_error(F.lit("text holds U+0000"))).otherwise(text)


def escape(value: Column, sep: str, escapes: dict[str, str] = LINE_ESCAPES) -> Column:
    """``value`` as it stands in a file; NULL stays NULL.

    Line feeds are common in text and the other special characters are rare, so
    one look decides between a single replacement and all of them.
    """
    value = value.cast("string")
    rare = [c for c in escapes.values() if c != "\n"]
    special = "[" + "".join(re.escape(c) for c in [_MARK, "\\", sep, *rare]) + "]"
    every = _swap(_swap(checked(value), "\\", "\\\\"), sep, "\\" + sep)
    for letter, char in escapes.items():
        every = _swap(every, char, "\\" + letter)
    return F.when(value.rlike(special), every).otherwise(_swap(value, "\n", "\\n"))


# types whose text form has none of the characters an escape is for
_PLAIN = (T.NumericType, T.BooleanType, T.DatetimeType)


def is_plain(dtype: T.DataType, sep: str) -> bool:
    return isinstance(dtype, _PLAIN) and sep in (SOH, SUB)


def join_fields(schema: T.StructType, sep: str, null_value: str,
                escapes: dict[str, str] = LINE_ESCAPES) -> Column:
    """One line of text from a row; NULL becomes ``null_value``."""
    fields = []
    for f in schema.fields:
        value = F.col(f"`{f.name}`").cast("string")
        if not is_plain(f.dataType, sep):
            value = escape(value, sep, escapes)
        fields.append(F.coalesce(value, F.lit(null_value)))
    return F.concat_ws(sep, *fields)


def split_fields(line: Column, sep: str) -> Column:
    """Raw fields of a line, as an array.

    Pairs of backslashes are set aside first, from the left as a reader would
    take them; after that a backslash before a separator is an escape, and any
    other separator ends a field. Fields still hold the two marks, which
    :func:`unescape` resolves.
    """
    held = _swap(_swap(checked(line), "\\\\", _BACKSLASH), "\\" + sep, _SEPARATOR)
    return F.split(held, re.escape(sep), -1)


def unescape(field: Column, sep: str, null_value: str,
             escapes: dict[str, str] = LINE_ESCAPES) -> Column:
    """The value of a raw field; the NULL test sees the field before unescaping."""
    lines = _swap(field, "\\n", "\n")
    every = _swap(lines, _SEPARATOR, sep)
    for letter, char in escapes.items():
        every = _swap(every, "\\" + letter, char)
    # a backslash before any other character stands for that character
    every = _swap(_swap(every, "\\", ""), _BACKSLASH, "\\")
    special = F.contains(lines, F.lit("\\")) | F.contains(lines, F.lit(_MARK))
    return F.when(field == null_value, None).when(special, every).otherwise(lines)
