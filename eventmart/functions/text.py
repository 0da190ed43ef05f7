r"""Repair of text that was UTF-8 encoded and then read as latin-1.

``BeyoncÃ©`` becomes ``Beyoncé``. Backslash escapes (hex, octal, unicode) are
resolved first and surrounding double quotes are stripped last. The function is
total: a value that cannot be such text (characters outside latin-1, a broken
escape, bytes that are not UTF-8) keeps its text. Named escapes ``\N{...}``
count as broken.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_LATIN1 = r"\A[\x00-\xff]*\z"

# A run without backslash, or one escape: \xhh \uhhhh \Uhhhhhhhh \ooo \c, or a
# backslash that ends the text.
_TOKEN = (
    r"(?s)[^\\]+|\\(?:x[0-9a-fA-F]{2}|u[0-9a-fA-F]{4}|U[0-9a-fA-F]{8}|[0-7]{1,3}|.|\z)"
)

# Escapes that stand for one fixed text (fixed values).
_SIMPLE = {
    "\\\n": "",
    "\\\\": "\\",
    "\\'": "'",
    '\\"': '"',
    "\\a": "\a",
    "\\b": "\b",
    "\\f": "\f",
    "\\n": "\n",
    "\\r": "\r",
    "\\t": "\t",
    "\\v": "\v",
}
# What is left of an escape that could not be completed (fixed values).
_BROKEN = ["\\", "\\x", "\\u", "\\U", "\\N"]


def _latin1_char(digits: Column, base: int) -> Column:
    """The character with this number, NULL outside latin-1."""
    number = F.conv(digits, base, 10).cast("bigint")
    return F.when(number < 256, F.char(number))


def _resolve(token: Column) -> Column:
    """The text of one token, NULL for a broken escape."""
    resolved = F.when(~token.startswith("\\"), token)
    for escape, text in _SIMPLE.items():
        resolved = resolved.when(token == escape, F.lit(text))
    kind = F.substring(token, 2, 1)
    return (
        resolved.when(token.isin(_BROKEN), F.lit(None))
        .when(kind.isin("x", "u", "U"), _latin1_char(F.substr(token, F.lit(3)), 16))
        .when(kind.between("0", "7"), _latin1_char(F.substr(token, F.lit(2)), 8))
        .otherwise(token)
    )


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _unescape(text: Column) -> Column:
    """Resolve all backslash escapes; NULL if any of them is broken."""
    parts = F.transform(F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0)), _resolve)
    return _let(
        parts, lambda p: F.when(~F.exists(p, lambda x: x.isNull()), F.array_join(p, ""))
    )


def _redecode(text: Column) -> Column:
    """Read latin-1 text as the UTF-8 bytes it was; NULL if it is no such text."""
    recoded = F.try_validate_utf8(F.encode(text, "ISO-8859-1").cast("string"))
    return F.when(text.rlike(_LATIN1), recoded)


def repair_text(column: Column | str) -> Column:
    """Native column expression; plain ASCII without escapes skips all decoding."""
    text = F.col(column) if isinstance(column, str) else column
    repaired = (
        F.when(
            text.contains("\\"),
            F.when(
                text.rlike(_LATIN1), F.coalesce(_let(_unescape(text), _redecode), text)
            ).otherwise(text),
        )
        .when(F.octet_length(text) == F.length(text), text)
        .otherwise(F.coalesce(_redecode(text), text))
    )
    return F.btrim(repaired, F.lit('"'))
