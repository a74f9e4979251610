"""Result-edge normalisation shared by every registered query."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_INTS = ("tinyint", "smallint", "int", "bigint")


def round_half_away(c, digits: int):
    """round(x * 10^d) / 10^d, half away from zero: the float rounding DuckDB and
    C use, and within an ulp of Python's round on the same value.

    Values are brought to 10 digits first: one that lies on a rounding edge, off by
    what the order of a sum leaves, then goes the same way in every run."""
    scale = float(10 ** digits)
    col = F.col(c) if isinstance(c, str) else c
    return F.round(F.round(col * 1e10, 0) / 1e10 * scale, 0) / scale


def finalize(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles to ``digits`` and widen integers to bigint (comparison edge only)."""
    cols = []
    for name, t in df.dtypes:
        if t in ("double", "float"):
            cols.append(round_half_away(F.col(name).cast("double"), digits).alias(name))
        elif t in _INTS:
            cols.append(F.col(name).cast("bigint").alias(name))
        else:
            cols.append(F.col(name))
    return df.select(*cols)
