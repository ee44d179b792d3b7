"""Whole-table data-quality checks.

Each check returns a findings DataFrame ``(finding, severity, variable, n)``
with one row per checked item (``severity='ok'`` when n == 0), computed in
a single aggregate pass; :func:`assert_clean` is the one action that raises.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import num
from ..specs import (COMPANION_SUFFIX, IDENTIFIER_COLUMNS, MISSING_CODES,
                     UNSUPPORTED_CODE_PREFIX, SplitSpec)

FINDINGS_COLUMNS = ("finding", "severity", "variable", "n")


class ValidationError(ValueError):
    pass


def _finding(check: str, variable: str, n: Column, bad: Column | None = None) -> Column:
    bad = (n > 0) if bad is None else bad
    return F.struct(F.lit(check).alias("finding"),
                    F.when(bad, "error").otherwise("ok").alias("severity"),
                    F.lit(variable).alias("variable"), n.cast("bigint").alias("n"))


def _long(row: DataFrame, findings: list[Column]) -> DataFrame:
    return row.select(F.inline(F.array(*findings)))


def check_not_blank(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """V3: identifiers blank after trim (null counts as blank)."""
    cols = [c for c in cols if c in df.columns]
    row = df.agg(*[F.count(F.when(F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == "", 1))
                   .alias(c) for c in cols])
    return _long(row, [_finding("not_blank", c, F.col(c)) for c in cols])


def check_unique_key(df: DataFrame, key: str) -> DataFrame:
    """V4: number of key values that occur more than once (partial agg)."""
    dup = df.groupBy(key).count().filter(F.col("count") > 1)
    row = dup.agg(F.count(F.lit(1)).alias("n"))
    return _long(row, [_finding("unique_key", key, F.col("n"))])


def check_flag_domain(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """V5: missing, non-numeric or outside {0,1}."""
    cols = [c for c in cols if c in df.columns]
    row = df.agg(*[F.count(F.when(~F.coalesce(num(df, c).isin(0.0, 1.0), F.lit(False)), 1)).alias(c)
                   for c in cols])
    return _long(row, [_finding("flag_domain", c, F.col(c)) for c in cols])


def check_range(df: DataFrame, col: str, lo: float, hi: float, integer: bool = True) -> DataFrame:
    """V6: missing/non-numeric, outside [lo, hi], and (by decision Q9) non-integer."""
    d = num(df, col)
    row = df.agg(
        F.count(F.when(d.isNull(), 1)).alias("missing"),
        F.count(F.when(~d.between(lo, hi), 1)).alias("outside"),
        F.count(F.when(d != F.floor(d), 1)).alias("non_integer"),
    )
    checks = [_finding("range_missing", col, F.col("missing")),
              _finding("range_outside", col, F.col("outside"))]
    if integer:
        checks.append(_finding("range_non_integer", col, F.col("non_integer")))
    return _long(row, checks)


def _periods(year: Column, spec: SplitSpec) -> tuple[Column, Column]:
    dev = year.between(spec.development_start_year, spec.development_end_year)
    tmp = year.between(spec.temporal_start_year, spec.temporal_end_year)
    return F.coalesce(dev, F.lit(False)), F.coalesce(tmp, F.lit(False))


def check_expected_counts(df: DataFrame, year_col: str, spec: SplitSpec) -> DataFrame:
    """V7: observed minus expected for total / development / temporal (one agg)."""
    dev, tmp = _periods(num(df, year_col), spec)
    row = df.agg(F.count(F.lit(1)).alias("total"),
                 F.count(F.when(dev, 1)).alias("development"),
                 F.count(F.when(tmp, 1)).alias("temporal"))
    exp = {"total": spec.expected_total_n, "development": spec.expected_development_n,
           "temporal": spec.expected_temporal_n}
    return _long(row, [_finding("expected_counts", k, F.col(k) - F.lit(v),
                                (F.col(k) - F.lit(v)) != 0)
                       for k, v in exp.items() if v is not None])


def overlap_groups(df: DataFrame, group_col: str, year_col: str, spec: SplitSpec) -> DataFrame:
    """Entities seen on both sides of the period boundary (one shuffle,
    map-side partial aggregation keeps a hot entity cheap)."""
    dev, tmp = _periods(num(df, year_col), spec)
    per = df.groupBy(group_col).agg(F.max(dev.cast("int")).alias("d"),
                                    F.max(tmp.cast("int")).alias("t"))
    return per.filter((F.col("d") == 1) & (F.col("t") == 1)).select(group_col)


def check_group_overlap(df: DataFrame, group_col: str, year_col: str, spec: SplitSpec) -> DataFrame:
    """V8."""
    row = overlap_groups(df, group_col, year_col, spec).agg(F.count(F.lit(1)).alias("n"))
    return _long(row, [_finding("group_overlap", group_col, F.col("n"))])


def scan_missing_codes(df: DataFrame, cols: Sequence[str] | None = None,
                       identifier_cols: Sequence[str] = IDENTIFIER_COLUMNS + ("index_case_flag",),
                       codes: Sequence[str] = MISSING_CODES) -> DataFrame:
    """One pass; only code-like cells are exploded.

    Returns ``(variable, code, n, severity)``: ``error`` for an unsupported
    ``MISS_*`` code or any code inside an identifier column, else ``info``.
    """
    cols = [c for c in (df.columns if cols is None else cols) if not c.endswith(COMPANION_SUFFIX)]
    cells = F.array(*[F.struct(F.lit(c).alias("variable"),
                               F.trim(F.col(c).cast("string")).alias("code")) for c in cols])
    code_like = F.filter(cells, lambda s: s["code"].isin(list(codes))
                         | s["code"].startswith(UNSUPPORTED_CODE_PREFIX))
    counts = (df.select(F.explode(code_like).alias("cell"))
              .groupBy(F.col("cell.variable").alias("variable"), F.col("cell.code").alias("code"))
              .agg(F.count(F.lit(1)).alias("n")))
    bad = (F.col("code").startswith(UNSUPPORTED_CODE_PREFIX)
           | F.col("variable").isin(list(identifier_cols)))
    return counts.withColumn("severity", F.when(bad, "error").otherwise("info"))


def missingness_report(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """N, missing_n, missing_fraction per column in one wide aggregate;
    ordered by fraction desc, variable asc."""
    cols = [c for c in (df.columns if cols is None else cols) if not c.endswith(COMPANION_SUFFIX)]
    row = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count(F.col(c)).alias(f"__c{i}") for i, c in enumerate(cols)])
    long = row.select(F.col("__n").alias("n"), F.inline(F.array(*[
        F.struct(F.lit(c).alias("variable"), F.col(f"__c{i}").alias("present"))
        for i, c in enumerate(cols)])))
    return (long.select("variable", F.col("n").cast("bigint").alias("n"),
                        (F.col("n") - F.col("present")).cast("bigint").alias("missing_n"),
                        F.try_divide((F.col("n") - F.col("present")).cast("double"),
                                     F.col("n").cast("double")).alias("missing_fraction"))
            .orderBy(F.desc("missing_fraction"), F.asc("variable")))


def union_findings(*frames: DataFrame) -> DataFrame:
    out = frames[0].select(*FINDINGS_COLUMNS)
    for f in frames[1:]:
        out = out.unionByName(f.select(*FINDINGS_COLUMNS))
    return out


def validate_registry(df: DataFrame, spec: SplitSpec, key: str = "study_case_id",
                      group_col: str = "study_patient_id", year_col: str = "index_year",
                      id_cols: Sequence[str] = ("study_patient_id", "study_case_id",
                                                "aneurysm_id", "procedure_id"),
                      flag_cols: Sequence[str] = ("index_case_flag",),
                      strict_counts: bool = False) -> DataFrame:
    """V3-V8 as one findings table: the row-level checks (V3, V5, V6 and,
    in strict mode, V7) in ONE aggregate pass; the key and entity checks
    (V4, V8) are one partial-aggregate shuffle each."""
    ids = [c for c in id_cols if c in df.columns]
    flags = [c for c in flag_cols if c in df.columns]
    y = num(df, year_col)
    dev, tmp = _periods(y, spec)
    aggs = [F.count(F.when(F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == "", 1)).alias(f"nb{i}")
            for i, c in enumerate(ids)]
    aggs += [F.count(F.when(~F.coalesce(num(df, c).isin(0.0, 1.0), F.lit(False)), 1)).alias(f"fd{i}")
             for i, c in enumerate(flags)]
    aggs += [F.count(F.when(y.isNull(), 1)).alias("rm"),
             F.count(F.when(~y.between(spec.development_start_year, spec.temporal_end_year), 1)).alias("ro"),
             F.count(F.when(y != F.floor(y), 1)).alias("ri"),
             F.count(F.lit(1)).alias("total"), F.count(F.when(dev, 1)).alias("development"),
             F.count(F.when(tmp, 1)).alias("temporal")]
    row = df.agg(*aggs)
    checks = [_finding("not_blank", c, F.col(f"nb{i}")) for i, c in enumerate(ids)]
    checks += [_finding("flag_domain", c, F.col(f"fd{i}")) for i, c in enumerate(flags)]
    checks += [_finding("range_missing", year_col, F.col("rm")), _finding("range_outside", year_col, F.col("ro")),
               _finding("range_non_integer", year_col, F.col("ri"))]
    if strict_counts:
        exp = {"total": spec.expected_total_n, "development": spec.expected_development_n,
               "temporal": spec.expected_temporal_n}
        checks += [_finding("expected_counts", k, F.col(k) - F.lit(v), (F.col(k) - F.lit(v)) != 0)
                   for k, v in exp.items() if v is not None]
    return union_findings(_long(row, checks), check_unique_key(df, key),
                          check_group_overlap(df, group_col, year_col, spec))


def assert_clean(findings: DataFrame) -> None:
    errors = findings.filter(F.col("severity") == "error").collect()
    if errors:
        raise ValidationError("; ".join(f"{r.finding}:{r.variable}={r.n}" for r in errors))
