"""Text functions over the built-in ones, and the Arrow functions that have no built-in counterpart."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Line ends as Python's splitlines() knows them.
LINE_ENDS = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"
#: Full-width digits and signs, and their plain forms.
WIDE, PLAIN = "０１２３４５６７８９Ｒｒ＃　", "0123456789Rr# "


def narrow(c: Column) -> Column:
    return F.translate(c, WIDE, PLAIN)


def strip_all(c: Column) -> Column:
    """Blanks of any script off both ends; Spark's trim knows the space only."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def squeeze_out(c: Column) -> Column:
    """All blanks removed."""
    return F.regexp_replace(c, r"(?U)\s+", "")


def pad_id(c: Column, width: int) -> Column:
    """Zeros in front, never cut (lpad alone cuts longer ids)."""
    text = c.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def numbered_lines(text: Column) -> Column:
    """Array of (no, line) from 1; the empty piece after a final line end is no line."""
    parts = F.split(text, LINE_ENDS)
    parts = F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)
    return F.transform(parts, lambda x, i: F.struct((i + 1).alias("no"), x.alias("line")))


def code_of(c: Column, codes: dict[str, str]) -> Column:
    """A literal map; null for unknown values."""
    return F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])[c]


def _form(form: str):
    @F.pandas_udf("string")
    def normal(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else unicodedata.normalize(form, x))

    return normal


def nfkc(c: Column) -> Column:
    return _form("NFKC")(c)


def nfc(c: Column) -> Column:
    return _form("NFC")(c)


def decoded(content: Column, charset: str) -> Column:
    """The text of whole files' bytes. A byte that the charset does not have fails the query. Spark's own decode() knows such charsets only by session settings that change other queries."""

    @F.pandas_udf("string")
    def text(s: pd.Series) -> pd.Series:
        return s.map(lambda b: None if b is None else bytes(b).decode(charset))

    return text(content)
