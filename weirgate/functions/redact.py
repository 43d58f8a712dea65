"""Secrets removed from nested values, at any depth and inside lists."""

from __future__ import annotations

import json
import re
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Parts of key names that mark a secret.
SECRET_MARKERS = ("secret", "token", "password", "key", "connection_string")


def secret_key(key: Column) -> Column:
    """Whether a key looks like a secret's, whatever the case."""
    return reduce(lambda a, b: a | b, [F.contains(F.lower(key), F.lit(m)) for m in SECRET_MARKERS])


# Strings (with the colon of a key) and the marks between values of compact JSON.
_TOKEN = re.compile(r'"[^"\\]*(?:\\.[^"\\]*)*"(:)?|[\[\]{},]')


def _marked(text: str) -> bool:
    low = text.lower()
    return any(m in low for m in SECRET_MARKERS)


def _kept(text: str | None) -> str | None:
    """Compact JSON without the entries of marked keys; all else is copied as it stands."""
    if text is None or not _marked(text):
        return text
    out: list[str] = []
    # ``dropped``: depth of the object whose entry is being left out.
    at, depth, dropped = 0, 0, None
    for token in _TOKEN.finditer(text):
        mark = text[token.start()]
        if mark == '"':
            if token[1] and dropped is None:
                key = token[0][:-1]
                if _marked(json.loads(key) if "\\" in key else key):
                    out.append(text[at : token.start()])
                    dropped = depth
        elif mark in "[{":
            depth += 1
        elif mark == ",":
            if dropped == depth:
                at, dropped = token.end(), None
        else:
            if dropped == depth:
                at, dropped = token.start(), None
                # The comma before the last entry, over entries that went with it.
                while not out[-1]:
                    out.pop()
                out[-1] = out[-1].removesuffix(",")
            depth -= 1
    return "".join(out) + text[at:]


@F.pandas_udf(T.StringType())
def _without_marked(texts: pd.Series) -> pd.Series:
    return texts.map(_kept, na_action="ignore")


def without_nested_secrets(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns of JSON text or VARIANT without the entries of marked keys, however deep.

    Spark parses a value and writes it in compact form; the entries under a marked key are
    cut out of that text with all they hold. Objects come back with their keys in order.
    Text that is no JSON gives null: what cannot be read is not passed on. One pass, and no
    rows move.
    """
    kinds = dict(df.dtypes)
    texts = {c: F.to_json(F.col(c) if kinds[c] == "variant" else F.try_parse_json(F.col(c))) for c in columns}
    # Numbers in objects and lists have one form only after a second writing.
    again = {
        c: F.when(F.col(c).rlike(r"^[\[{]"), F.to_json(F.try_parse_json(c))).otherwise(F.col(c)) for c in columns
    }
    cleaned = df.withColumns(texts).withColumns(again).withColumns({c: _without_marked(c) for c in columns})
    return cleaned.withColumns({c: F.try_parse_json(c) for c in columns if kinds[c] == "variant"})
