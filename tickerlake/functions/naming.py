"""Column naming."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

# Where a camel-case name gets an underscore, applied in this order.
WORD_BREAKS = ["(.)([A-Z][a-z]+)", "([a-z0-9])([A-Z])"]


def camel_to_snake(name: str) -> str:
    for break_at in WORD_BREAKS:
        name = re.sub(break_at, r"\1_\2", name)
    return name.lower()


def snake_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[camel_to_snake(c) for c in df.columns])


def lower_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])
