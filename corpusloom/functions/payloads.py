"""Payloads as text."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def payload_text(c: str | Column) -> Column:
    """A JSON string as it is, other JSON with sorted keys and an indent of two, as Python writes it; null is null, and what isn't JSON raises.

    Spark prints neither indents nor numbers as Python does, so this is a function over Arrow batches.
    """

    @F.pandas_udf("string")
    def run(values: pd.Series) -> pd.Series:
        def one(text):
            if text is None:
                return None
            value = json.loads(text)
            return value if isinstance(value, str) else json.dumps(value, sort_keys=True, ensure_ascii=False, indent=2)

        return values.map(one)

    return run(F.col(c) if isinstance(c, str) else c)
