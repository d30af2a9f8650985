"""Text formats of names and replies."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType


@F.pandas_udf(StringType())
def three_decimals(scores: pd.Series) -> pd.Series:
    """Decimal text of the exact binary value; the JVM's ``%.3f`` rounds its shortest text instead."""
    return scores.map(lambda s: None if pd.isna(s) else f"{s:.3f}")


def trimmed(text: Column) -> Column:
    """Without any surrounding white space, line ends included."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def suffix(name: Column) -> Column:
    """Lower-case suffix of a file name with its dot, or nothing."""
    return F.lower(F.regexp_extract(name, r"[^.](\.[^.]+)$", 1))


def stem(name: Column) -> Column:
    """File name without its last suffix."""
    return F.regexp_replace(name, r"(?<=[^.])\.[^.]+$", "")
