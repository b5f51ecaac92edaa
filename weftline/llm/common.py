"""Column expressions shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(c: Column | str) -> Column:
    """Without leading and trailing spaces (U+0020) and lower-cased; null where nothing is left."""
    c = F.col(c) if isinstance(c, str) else c
    folded = F.lower(F.trim(c))
    return F.when(folded != "", folded)


def require(df: DataFrame, *names: str) -> None:
    """Fail early, with the names, if a column an operator needs is missing."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}; there are: {', '.join(df.columns)}")
