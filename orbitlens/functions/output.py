"""Presentation helpers shared by the registered queries and their SQL checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

# Results are compared at 4 decimals; the tiny offset moves
# exact decimal ties (e.g. a mean of 0.00125) off the rounding boundary so
# that two engines with different float noise round them the same way.
ROUND_DIGITS = 4
TIE_OFFSET = 1e-9


def q(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c + F.lit(TIE_OFFSET), ROUND_DIGITS)


def q_sql(expr: str) -> str:
    return f"round(({expr}) + {TIE_OFFSET}, {ROUND_DIGITS})"


def round_doubles(df: DataFrame) -> DataFrame:
    """Round every DOUBLE/FLOAT column with ``q``."""
    return df.select(*[q(f.name).alias(f.name) if isinstance(f.dataType, (DoubleType, FloatType))
                       else F.col(f.name) for f in df.schema.fields])
