"""Column-expression helpers shared by the operators (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, ByteType, DecimalType, DoubleType, FloatType,
                               IntegerType, LongType, ShortType)

from ..specs import LOGIT_EPS


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_order(seed, salt, *keys) -> Column:
    """Deterministic 48-bit ordering key from md5(seed:salt:key...).

    Independent of partitioning (unlike ``rand``); DuckDB reproduces it with
    ``('0x'||substr(md5(concat_ws(':', seed, salt, key)),1,12))::BIGINT``.
    """
    parts = [F.lit(str(seed)), F.lit(str(salt))] + [col(k).cast("string") for k in keys]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 12), 16, 10).cast("bigint")


def nan_to_null(c) -> Column:
    c = col(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def to_double(c) -> Column:
    """Lenient numeric parse: unparsable -> null, NaN -> null."""
    return nan_to_null(col(c).cast("string").try_cast("double"))


_EXACT = (IntegerType, LongType, ShortType, ByteType, DecimalType, BooleanType)


def num(df: DataFrame | None, c) -> Column:
    """Numeric value of a column by its actual type: integral/decimal cast
    directly, floating point with NaN -> null, text parsed leniently."""
    if df is not None and isinstance(c, str) and c in df.columns:
        dt = df.schema[c].dataType
        if isinstance(dt, _EXACT):
            return F.col(c).cast("double")
        if isinstance(dt, (DoubleType, FloatType)):
            return nan_to_null(F.col(c).cast("double"))
    return to_double(c)


def binary01(df: DataFrame | None, c) -> Column:
    """0/1 integer flag, null when missing or outside {0, 1}."""
    if df is not None and isinstance(c, str) and c in df.columns \
            and isinstance(df.schema[c].dataType, (IntegerType, LongType, ShortType, ByteType)):
        return F.when(F.col(c).isin(0, 1), F.col(c).cast("int"))
    d = num(df, c)
    return F.when(d.isin(0.0, 1.0), d.cast("int"))


def truth(cond: Column) -> Column:
    """Missing comparison = criterion not met."""
    return F.coalesce(cond, F.lit(False))


def flag(cond: Column) -> Column:
    """Boolean (null kept) -> 0/1 integer."""
    return cond.cast("int")


def logit(p, eps: float = LOGIT_EPS) -> Column:
    c = F.least(F.greatest(col(p).cast("double"), F.lit(eps)), F.lit(1.0 - eps))
    return F.ln(c / (F.lit(1.0) - c))


def ratio(num: Column, den: Column) -> Column:
    """num/den, null (undefined) when den is 0 or null."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def r6(c) -> Column:
    """Round for oracle comparison; +0.0 removes negative zero."""
    return F.round(col(c).cast("double"), 6) + F.lit(0.0)


def compare(c: Column, op: str, value) -> Column:
    v = F.lit(value)
    return {
        ">=": c >= v, ">": c > v, "<=": c <= v, "<": c < v, "==": c == v, "!=": c != v,
    }[op]
