"""Cleaning and projection (C1-C9).  All row-wise, one projection each, so
they run unchanged on batch and streaming DataFrames."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import logit as _logit
from ..functions.exprs import num, to_double
from ..specs import COMPANION_SUFFIX, MISSING_CODES


class CleaningError(ValueError):
    pass


def _null_str() -> Column:
    return F.lit(None).cast("string")


def _trimmed(c: str) -> Column:
    return F.trim(F.col(c).cast("string"))


def preserve_missing_codes(df: DataFrame, cols: Iterable[str] | None = None,
                           codes: Sequence[str] = MISSING_CODES) -> DataFrame:
    """An exact (trimmed, case-sensitive) missing-reason code moves to
    ``<col>__missing_code`` and the value becomes null; blank -> null.
    Companions exist for every tracked column (null when unused)."""
    tracked = list(df.columns if cols is None else cols)
    out, companions = [], []
    for c in df.columns:
        if c in tracked:
            t = _trimmed(c)
            is_code = t.isin(list(codes))
            out.append(F.when(is_code | (t == ""), F.lit(None)).otherwise(F.col(c))
                       .cast(df.schema[c].dataType).alias(c))
            companions.append(F.when(is_code, t).otherwise(_null_str()).alias(c + COMPANION_SUFFIX))
        else:
            out.append(F.col(c))
    return df.select(*out, *companions)


def coerce_numeric(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Unparsable -> null (never zero), NaN -> null."""
    cols = set(cols)
    return df.select(*[num(df, c).alias(c) if c in cols else F.col(c) for c in df.columns])


def binary_value(c: str) -> Column:
    d = to_double(c)
    return F.when(d.isin(0.0, 1.0), d.cast("int")).otherwise(F.lit(None).cast("int"))


def binary_violation(c: str) -> Column:
    """A parsed number other than 0/1 (unparsable text is just missing)."""
    d = to_double(c)
    return d.isNotNull() & ~d.isin(0.0, 1.0)


def coerce_binary(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """0/1 integers; out-of-domain numbers become null here and are
    counted by :func:`binary_findings` / raised by :func:`assert_binary`."""
    cols = set(cols)
    return df.select(*[binary_value(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def binary_findings(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    row = df.agg(*[F.count(F.when(binary_violation(c), 1)).alias(c) for c in cols])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit("binary_domain").alias("finding"),
                 F.when(F.col(c) > 0, "error").otherwise("ok").alias("severity"),
                 F.lit(c).alias("variable"), F.col(c).cast("bigint").alias("n"))
        for c in cols])))


def assert_binary(df: DataFrame, cols: Sequence[str]) -> None:
    bad = [r.variable for r in binary_findings(df, cols).collect() if r.n > 0]
    if bad:
        raise CleaningError(f"values outside 0/1 in {bad}")


def normalise_text(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """C4: trim, '' -> null; companion columns are left alone."""
    cols = {c for c in cols if not c.endswith(COMPANION_SUFFIX)}
    return df.select(*[F.nullif(F.trim(F.col(c)), F.lit("")).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def clean_columns(df: DataFrame, numeric: Sequence[str], binary: Sequence[str],
                  tracked: Sequence[str] | None = None,
                  codes: Sequence[str] = MISSING_CODES) -> DataFrame:
    """C1-C4 fused into one projection: codes and blanks -> null with the
    reason kept, numeric and 0/1 coercion, every other column trimmed text."""
    tracked = list(df.columns if tracked is None else tracked)
    numeric, binary = set(numeric), set(binary)
    out, companions = [], []
    for c in df.columns:
        t = _trimmed(c)
        is_code = t.isin(list(codes))
        base = F.when(is_code | (t == ""), _null_str()).otherwise(F.col(c).cast("string"))
        if c in numeric:
            d = to_double(base)
            out.append(d.alias(c))
        elif c in binary:
            d = to_double(base)
            out.append(F.when(d.isin(0.0, 1.0), d.cast("int")).otherwise(F.lit(None).cast("int")).alias(c))
        else:
            out.append(F.nullif(F.trim(base), F.lit("")).alias(c))
        if c in tracked:
            companions.append(F.when(is_code, t).otherwise(_null_str()).alias(c + COMPANION_SUFFIX))
    return df.select(*out, *companions)


def derive_ratio(df: DataFrame, target: str, numerator: str, denominator: str) -> DataFrame:
    """Fill target only where it is null, numerator known, denominator > 0."""
    num, den = F.col(numerator).cast("double"), F.col(denominator).cast("double")
    filled = F.when(num.isNotNull() & (den > 0), num / den)
    if target in df.columns:
        return df.withColumn(target, F.coalesce(F.col(target).cast("double"), filled))
    return df.withColumn(target, filled)


def eligible_rows(df: DataFrame, eligibility_column: str | None, target: str | None) -> DataFrame:
    """Eligibility flag = 1 (missing = not eligible) and target known."""
    cond = F.lit(True)
    if eligibility_column:
        if eligibility_column not in df.columns:
            raise KeyError(f"no column {eligibility_column!r} to take eligibility from")
        cond = cond & F.coalesce(num(df, eligibility_column) == 1.0, F.lit(False))
    if target:
        if target not in df.columns:
            raise KeyError(f"no column {target!r} to take the label from")
        cond = cond & F.col(target).isNotNull()
    return df.filter(cond)


def select_features(df: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Ordered projection; an absent feature is an error."""
    missing = [f for f in features if f not in df.columns]
    if missing:
        raise KeyError(f"the model reads {missing}, which the table lacks")
    keep = [k for k in keys if k in df.columns and k not in features]
    return df.select(*keep, *features)


def group_findings(df: DataFrame, group_col: str) -> DataFrame:
    """Group key null or blank."""
    if group_col not in df.columns:
        raise KeyError(f"no column {group_col!r} to group rows by")
    bad = F.col(group_col).isNull() | (F.trim(F.col(group_col).cast("string")) == "")
    return df.agg(F.count(F.when(bad, 1)).cast("bigint").alias("n")).select(
        F.lit("group_key").alias("finding"),
        F.when(F.col("n") > 0, "error").otherwise("ok").alias("severity"),
        F.lit(group_col).alias("variable"), "n")


def require_groups(df: DataFrame, group_col: str) -> None:
    n = group_findings(df, group_col).first().n
    if n:
        raise CleaningError(f"{n} rows have no value in {group_col!r}")


def logit(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """ln(p/(1-p)) after clipping to [1e-6, 1-1e-6]."""
    return df.withColumn(out or f"logit_{col}", _logit(col))
