"""Escapes of the form that the fragment files use."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_ESCAPE = re.compile(r"\\(?:x([0-9a-fA-F]{2})|u([0-9a-fA-F]{4})|U([0-9a-fA-F]{8})|([0-7]{1,3})|(\n)|([\\'\"abfnrtv]))")
#: Single-letter escapes.
_LETTERS = {"\\": "\\", "'": "'", '"': '"', "a": "\a", "b": "\b", "f": "\f", "n": "\n", "r": "\r", "t": "\t", "v": "\v"}


def _one(m: re.Match) -> str:
    for group, base in ((1, 16), (2, 16), (3, 16), (4, 8)):
        if m[group]:
            code = int(m[group], base)
            return chr(code) if code < 0x110000 else m[0]
    return "" if m[5] else _LETTERS[m[6]]


@F.pandas_udf(StringType())
def _decode(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: _ESCAPE.sub(_one, t).encode("utf-16", "surrogatepass").decode("utf-16", "replace"), na_action="ignore")


def decode_escapes(c: Column) -> Column:
    """Text with its backslash escapes decoded; texts without a backslash stay on the JVM's side, null stays null."""
    return F.when(F.position(F.lit("\\"), c) == 0, c).otherwise(_decode(F.when(F.position(F.lit("\\"), c) > 0, c)))
