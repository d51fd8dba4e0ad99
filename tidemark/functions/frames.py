"""Small helpers for frames: joins on keys that may be NULL, pandas handed back to Spark."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``left`` joined to ``right`` on equal keys, where NULL equals NULL; the keys come from ``left``."""
    other = right.withColumnsRenamed({k: f"_same_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_same_{k}"))
    return left.join(other, same, how).drop(*[f"_same_{k}" for k in keys])


def plain(pdf: pd.DataFrame) -> pd.DataFrame:
    """Replace extension-typed columns (Arrow strings in several chunks) by objects."""
    extension = {c: object for c in pdf.columns if not isinstance(pdf[c].dtype, np.dtype)}
    return pdf.astype(extension) if extension else pdf


def empty(names: list[str]) -> pd.DataFrame:
    """No rows; object columns convert to any Arrow type."""
    return pd.DataFrame({n: [] for n in names}, dtype=object)
