"""The first JSON object in free text."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_FENCE = re.compile(r"```(?:json)?\s*(.*?)```", re.DOTALL)


def extract(text: str | None) -> str | None:
    """The whole text, a fenced block or the first object that parses, as it stands there."""
    if not text:
        return None
    decoder = json.JSONDecoder()
    for candidate in (text.strip(), *(m.strip() for m in _FENCE.findall(text))):
        try:
            json.loads(candidate)
        except ValueError:
            continue
        return candidate
    at = text.find("{")
    while at >= 0:
        try:
            _, end = decoder.raw_decode(text, at)
        except ValueError:
            at = text.find("{", at + 1)
            continue
        return text[at:end]
    return None


def json_blob(c: Column) -> Column:
    """The object's text, for from_json. Brackets within strings cannot be matched by built-in functions."""

    @F.pandas_udf("string")
    def run(text: pd.Series) -> pd.Series:
        return text.map(extract)

    return run(c)
