"""Rule-based outcome labels.

Contract: a missing outcome stays missing; a row whose sources break the
rule gets a null label and is counted in the endpoint's findings (the
``assert_*``/``strict`` path raises instead); a supplied label is compared
row by row (E6) and used only where the rule cannot decide.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import binary01, num
from ..specs import (ASSESSMENT_WINDOW, COMPOSITE_DURATION_SEC, COMPOSITE_MIN_COMPONENTS,
                     COMPOSITE_REPOSITIONS, ORDINAL_CUT, ORDINAL_MAX, ORDINAL_MIN,
                     SURVIVAL_HORIZON_DAYS)
from .kernels import materialize
from .validate import _finding, _long


class EndpointDefinitionError(ValueError):
    pass


COMPOSITE_SOURCES = ("pcoma_c_exposure_component", "pcoma_c_reconstruction_component",
                     "temporary_clip_cumulative_sec", "clip_reposition_count",
                     "flow_rescue_manoeuvre_flag", "rupture_escalation_flag")
ADJUDICATED_SOURCES = ("new_postop_dwi_lesion_flag", "new_postop_ct_hypodensity_flag",
                       "new_postop_ischaemic_deficit_flag", "lesion_anatomically_concordant_flag",
                       "preexisting_infarct_flag", "delayed_cerebral_ischaemia_flag",
                       "vasospasm_related_infarct_flag", "venous_infarction_flag",
                       "nonprocedural_embolic_lesion_flag",
                       "ischaemia_mechanism_indeterminate_flag")


def _has(df: DataFrame, cols: Sequence[str]) -> bool:
    return all(c in df.columns for c in cols)


def require_sources(df: DataFrame, cols: Sequence[str], endpoint: str) -> None:
    """Absent source columns are an error (never defaulted to zero)."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise EndpointDefinitionError(f"{endpoint}: its sources {missing} are not in the table")


def _bin_bad(df: DataFrame, c: str, allow_missing: bool) -> Column:
    d = num(df, c)
    bad = d.isNotNull() & ~d.isin(0.0, 1.0)
    return bad if allow_missing else (bad | d.isNull())


def composite_label(df: DataFrame, sources: Sequence[str] = COMPOSITE_SOURCES,
                    label: str = "derived_high_complexity_case",
                    count_col: str = "pcoma_c_component_count",
                    duration_cut: float = COMPOSITE_DURATION_SEC,
                    repositions_cut: int = COMPOSITE_REPOSITIONS,
                    min_count: int = COMPOSITE_MIN_COMPONENTS,
                    supplied: str | None = "derived_high_complexity_case") -> DataFrame:
    """Count of six components; label = count >= 2 OR repositions OR rescue.

    Falls back to the supplied 0/1 label when the sources are absent (E0).
    The supplied label, if any, is kept as ``<label>__supplied`` for E6.
    """
    if not _has(df, sources):
        if supplied and supplied in df.columns:
            return df.withColumn(label, binary01(df, supplied))
        require_sources(df, sources, "composite label")
    staged = df.withColumns({
        "__c1": binary01(df, sources[0]), "__c2": binary01(df, sources[1]),
        "__dur": num(df, sources[2]), "__rep": num(df, sources[3]),
        "__c5": binary01(df, sources[4]), "__c6": binary01(df, sources[5])})
    if supplied and supplied in df.columns:
        staged = staged.withColumn(f"{label}__supplied", binary01(df, supplied))
    dur, rep = F.col("__dur"), F.col("__rep")
    c3 = F.when(dur >= 0, (dur > duration_cut).cast("int"))
    c4 = F.when(rep >= 0, (rep >= repositions_cut).cast("int"))
    staged = staged.withColumns({"__c3": c3, "__c4": c4})
    count = (F.col("__c1") + F.col("__c2") + F.col("__c3") + F.col("__c4") + F.col("__c5")
             + F.col("__c6"))                                  # null if any source invalid
    derived = F.when(count.isNotNull(),
                     ((count >= min_count) | (F.col("__c4") == 1) | (F.col("__c5") == 1)).cast("int"))
    return (staged.withColumns({count_col: count.cast("int"), label: derived})
            .drop("__c1", "__c2", "__c3", "__c4", "__c5", "__c6", "__dur", "__rep"))


def composite_findings(df: DataFrame, sources: Sequence[str] = COMPOSITE_SOURCES) -> DataFrame:
    require_sources(df, sources, "composite label")
    flags = [sources[i] for i in (0, 1, 4, 5)]
    dur, rep = num(df, sources[2]), num(df, sources[3])
    aggs = [F.count(F.when(_bin_bad(df, c, False), 1)).alias(c) for c in flags]
    aggs += [F.count(F.when(dur.isNull() | (dur < 0), 1)).alias(sources[2]),
             F.count(F.when(rep.isNull() | (rep < 0), 1)).alias(sources[3])]
    row = df.agg(*aggs)
    return _long(row, [_finding("composite_source", c, F.col(c)) for c in sources])


def adjudicated_label(df: DataFrame, sources: Sequence[str] = ADJUDICATED_SOURCES,
                      label: str = "derived_procedure_related_ischemia_flag",
                      supplied: str | None = "derived_procedure_related_ischemia_flag") -> DataFrame:
    """((dwi OR ct) AND concordant) OR deficit, AND NOT any exclusion;
    decided only where all ten sources are known and the mechanism is not
    indeterminate; otherwise the supplied label; else null (finding)."""
    if not _has(df, sources):
        if supplied and supplied in df.columns:
            return df.withColumn(label, binary01(df, supplied))
        require_sources(df, sources, "adjudicated label")
    tmp = {c: f"__a{i}" for i, c in enumerate(sources)}
    staged = df.withColumns({tmp[c]: binary01(df, c) for c in sources})
    f = {c: F.col(tmp[c]) for c in sources}
    dwi, ct, deficit, concordant = (f[sources[i]] == 1 for i in range(4))
    exclusions = None
    for c in sources[4:9]:
        e = f[c] == 1
        exclusions = e if exclusions is None else (exclusions | e)
    indeterminate = f[sources[9]] == 1
    sufficient = None
    for c in sources:
        k = f[c].isNotNull()
        sufficient = k if sufficient is None else (sufficient & k)
    rule = (((dwi | ct) & concordant) | deficit) & ~exclusions
    derived = F.when(sufficient & ~indeterminate, rule.cast("int"))
    if supplied and supplied in df.columns:
        staged = staged.withColumn(f"{label}__supplied", binary01(df, supplied))
        derived = F.coalesce(derived, F.col(f"{label}__supplied"))
    return staged.withColumn(label, derived).drop(*tmp.values())


def survival_fields(df: DataFrame, palsy: str = "preop_cn3_palsy",
                    event_cols: Sequence[str] = ("cn3_complete_recovery_12m",
                                                 "cn3_complete_recovery_event"),
                    recovery_time: str = "time_to_complete_recovery_days",
                    last_assessment: str = "cn3_last_assessment_days",
                    death_flag: str = "death_before_cn3_recovery",
                    death_time: str = "death_time_days",
                    horizon: float = SURVIVAL_HORIZON_DAYS,
                    event_out: str = "pcoma_o_event", time_out: str = "pcoma_o_time_days",
                    landmark_out: str = "derived_cn3_nonrecovery_12m") -> DataFrame:
    """E3 + E4 as expressions (no per-row loop).

    Eligible rows (palsy = 1): event = 1 -> time = recovery time, valid in
    (0, horizon]; event = 0 -> time = least(horizon, last assessment if > 0,
    death time if died and > 0).  Non-eligible rows get nulls.  Landmark
    label (E4) = 1 - event where eligible and the event is known.
    A null death flag is read as "no death" (decision Q4).
    """
    if palsy not in df.columns:
        raise EndpointDefinitionError(f"survival fields require {palsy}")
    event_col = next((c for c in event_cols if c in df.columns), None)
    if event_col is None:
        raise EndpointDefinitionError(f"survival fields require one of {list(event_cols)}")
    require_sources(df, [recovery_time, last_assessment], "survival fields")
    staged = df.withColumns({
        "__elig": F.coalesce(binary01(df, palsy) == 1, F.lit(False)),
        "__ev": binary01(df, event_col),
        "__rec": num(df, recovery_time), "__last": num(df, last_assessment),
        "__died": F.coalesce(binary01(df, death_flag) == 1, F.lit(False))
        if death_flag in df.columns else F.lit(False),
        "__dt": num(df, death_time) if death_time in df.columns else F.lit(None).cast("double")})
    eligible, event = F.col("__elig"), F.col("__ev")
    rec, last, died, dtime = F.col("__rec"), F.col("__last"), F.col("__died"), F.col("__dt")
    censor = F.least(F.lit(float(horizon)), F.when(last > 0, last), F.when(died & (dtime > 0), dtime))
    valid_event_time = (rec > 0) & (rec <= horizon)
    time = (F.when(eligible & (event == 1) & F.coalesce(valid_event_time, F.lit(False)), rec)
            .when(eligible & (event == 0), censor))
    staged = staged.withColumn(time_out, time.cast("double"))
    ev = F.when(F.col(time_out).isNotNull(), event)
    return (staged.withColumns({
        event_out: ev.cast("int"),
        landmark_out: F.when(eligible & event.isNotNull(), 1 - event).cast("int")})
        .drop("__elig", "__ev", "__rec", "__last", "__died", "__dt"))


def survival_findings(df: DataFrame, palsy: str = "preop_cn3_palsy",
                      event_col: str = "cn3_complete_recovery_12m",
                      recovery_time: str = "time_to_complete_recovery_days") -> DataFrame:
    eligible = F.coalesce(binary01(df, palsy) == 1, F.lit(False))
    event = binary01(df, event_col)
    rec = num(df, recovery_time)
    row = df.agg(
        F.count(F.when(_bin_bad(df, palsy, False), 1)).alias("palsy"),
        F.count(F.when(eligible & event.isNull(), 1)).alias("event"),
        F.count(F.when(eligible & (event == 1) & ~F.coalesce((rec > 0) & (rec <= SURVIVAL_HORIZON_DAYS),
                                                            F.lit(False)), 1)).alias("time"))
    return _long(row, [_finding("survival_palsy_domain", palsy, F.col("palsy")),
                       _finding("survival_event_missing", event_col, F.col("event")),
                       _finding("survival_event_time", recovery_time, F.col("time"))])


def thresholded_ordinal_label(df: DataFrame, value: str = "mrs_90d",
                              flag: str = "mrs_90d_window_eligible_flag",
                              day: str = "mrs_90d_assessment_day",
                              label: str = "derived_poor_outcome_90d",
                              cut: int = ORDINAL_CUT, lo: int = ORDINAL_MIN, hi: int = ORDINAL_MAX,
                              window: tuple[int, int] = ASSESSMENT_WINDOW,
                              supplied: str | None = "derived_poor_outcome_90d") -> DataFrame:
    """E5: label = value > cut where eligible and known; eligibility from the
    flag column, else the assessment-day window, else value known.  Values
    outside [lo, hi] or non-integer (decision Q8) give a null label."""
    require_sources(df, [value], "ordinal label")
    v = num(df, value)
    valid_v = F.when(v.between(lo, hi) & (v == F.floor(v)), v)
    if flag in df.columns:
        eligible = F.coalesce(binary01(df, flag) == 1, F.lit(False))
    elif day in df.columns:
        eligible = F.coalesce(num(df, day).between(*window), F.lit(False))
    else:
        eligible = v.isNotNull()
    staged = df.withColumns({"__v": valid_v, "__e": eligible})
    derived = F.when(F.col("__e") & F.col("__v").isNotNull(), (F.col("__v") > cut).cast("int"))
    if supplied and supplied in df.columns:
        staged = staged.withColumn(f"{label}__supplied", binary01(df, supplied))
        derived = F.coalesce(derived, F.when(F.col("__e"), F.col(f"{label}__supplied")))
    return (staged.withColumns({flag: F.col("__e").cast("int"), label: derived})
            .drop("__v", "__e"))


def ordinal_findings(df: DataFrame, value: str = "mrs_90d", lo: int = ORDINAL_MIN,
                     hi: int = ORDINAL_MAX) -> DataFrame:
    v = num(df, value)
    row = df.agg(F.count(F.when(v.isNotNull() & ~(v.between(lo, hi) & (v == F.floor(v))), 1)).alias("n"))
    return _long(row, [_finding("ordinal_domain", value, F.col("n"))])


def label_concordance(df: DataFrame, supplied: str, derived: str, key: str,
                      first: int = 10) -> DataFrame:
    """Rows where both labels are known and differ: the count and the
    first ``first`` row keys.  The rows are read once: each task gives its count
    and its own first keys, of which the first overall are taken."""
    a, b = binary01(df, supplied), F.col(derived)
    mism = df.filter(a.isNotNull() & b.isNotNull() & (a != b))

    def part(batches):
        n, keys = 0, []
        for batch in batches:
            n += batch.num_rows
            own = pc.array_sort_indices(batch.column(0), null_placement="at_start").slice(0, first)
            keys = sorted([*keys, *batch.column(0).take(own).to_pylist()], key=lambda k: (k is not None, k))[:first]
        yield pa.RecordBatch.from_arrays([pa.array([n, *[None] * len(keys)], pa.int64()), pa.array([None, *keys], pa.string()),
                                          pa.array([False, *[True] * len(keys)])], names=["n", "k", "is_key"])

    parts = materialize(mism.select(F.col(key).cast("string").alias("k")).mapInArrow(part, "n bigint, k string, is_key boolean"))
    n = parts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_mismatch")).withColumn("k", F.lit(None).cast("string"))
    ids = parts.filter("is_key").select("k").orderBy("k").limit(first).withColumn("n_mismatch", F.lit(None).cast("bigint"))
    keys = F.array_sort(F.collect_list("k"))
    return n.unionByName(ids).agg(
        F.max("n_mismatch").alias("n_mismatch"),
        F.when(F.size(keys) > 0, F.concat_ws(",", keys)).alias("first_keys"),
    ).select(F.lit(derived).alias("variable"), "n_mismatch", "first_keys")


def attach_endpoints(df: DataFrame) -> DataFrame:
    """Apply E1, E2, E3/E4 and E5 in order (one chained projection)."""
    out = composite_label(df)
    out = adjudicated_label(out)
    out = survival_fields(out)
    return thresholded_ordinal_label(out)


def endpoint_audit(df: DataFrame, split_col: str = "split",
                   derived: Sequence[str] = ("pcoma_c_component_count",
                                             "derived_high_complexity_case",
                                             "derived_procedure_related_ischemia_flag",
                                             "pcoma_o_event", "pcoma_o_time_days",
                                             "derived_cn3_nonrecovery_12m",
                                             "mrs_90d_window_eligible_flag",
                                             "derived_poor_outcome_90d")) -> DataFrame:
    """Per split and derived column, rows and non-null count."""
    labelled = attach_endpoints(df)
    per = labelled.groupBy(split_col).agg(F.count(F.lit(1)).alias("n_rows"),
                                          *[F.count(F.col(c)).alias(c) for c in derived])
    return per.select(F.col(split_col).alias("split"), F.col("n_rows").cast("bigint").alias("n_rows"),
                      F.inline(F.array(*[F.struct(F.lit(c).alias("variable"),
                                                  F.col(c).cast("bigint").alias("non_null"))
                                         for c in derived])))
