"""Document-key normalisation for joins.

The original compares document ids as text (``CAST(x AS VARCHAR)`` on both
sides). For two integral columns, text equality of the canonical decimal forms
is the same as numeric equality, so the join runs on BIGINT keys (cheaper to
hash and shuffle); any other combination is compared as strings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

_INTEGRAL = (ByteType, IntegerType, LongType, ShortType)


def _is_integral(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, _INTEGRAL)


def key_type(*sides: tuple[DataFrame, str]) -> str:
    return "bigint" if all(_is_integral(df, c) for df, c in sides) else "string"


def doc_key(df: DataFrame, col: str, ktype: str) -> Column:
    return F.col(col).cast(ktype)
