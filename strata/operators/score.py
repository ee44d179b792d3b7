"""Points scorecards (K1-K5): sum of points; a missing input scores 0."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import compare, truth
from ..specs import SCORECARD_C, SCORECARD_E, SCORECARD_O, SCORECARD_R_PROVISIONAL

Rule = tuple[str, str, object, int]


def points_expr(rules: Sequence[Rule]) -> Column:
    total = F.lit(0)
    for column, op, value, points in rules:
        total = total + F.when(truth(compare(F.col(column), op, value)), F.lit(points)).otherwise(0)
    return total.cast("int")


def points_score(df: DataFrame, rules: Sequence[Rule], out: str = "score") -> DataFrame:
    missing = [r[0] for r in rules if r[0] not in df.columns]
    if missing:
        raise KeyError(f"Missing score variables: {missing}")
    return df.withColumn(out, points_expr(rules))


def score_c(df: DataFrame) -> DataFrame:
    """K1, scored on the temporal period by the caller."""
    return points_score(df, SCORECARD_C, "pcoma_c_score")


def score_o(df: DataFrame) -> DataFrame:
    """K2, rows with palsy = 1."""
    return points_score(df.filter(F.col("preop_cn3_palsy") == 1), SCORECARD_O, "pcoma_o_score")


def score_e(df: DataFrame, label: str = "derived_poor_outcome_90d") -> DataFrame:
    """K3, rows with a known label."""
    return points_score(df.filter(F.col(label).isNotNull()), SCORECARD_E, "pcoma_e_score")


def score_r_provisional(df: DataFrame) -> DataFrame:
    """K5: provisional 0-13 weights; the final 0-17 score is not defined."""
    return points_score(df, SCORECARD_R_PROVISIONAL, "pcoma_r_score_provisional")


def score_r(df: DataFrame) -> DataFrame:
    raise NotImplementedError("final ischaemia score weights are unresolved; "
                              "use score_r_provisional and label it provisional")
