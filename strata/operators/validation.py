"""Validation jobs.

Every fit has an encoder learnt from its own training rows; the encoders of folds
and replicates come from shared histograms.  Bootstrap replicates
are *weights* on the rows (Spark ML ``weightCol``), never duplicated rows;
fits are independent Spark jobs submitted from a small driver thread pool.
Metric-only modes (fixed scores, no refit) run every replicate in one job
keyed by the replicate id (see the ``bootstrap_auc`` / ``permutation_test``
queries).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..specs import GLOBAL_SEED, INNER_CV_SPLITS, LEARNING_CURVE_FRACTIONS, OUTER_CV_SPLITS, ModelSpec
from .encode import FoldSafeEncoder
from .kernels import materialize
from .many_fits import Design, bootstrap_refits, permutation_refits
from .metrics import auc_ap, binary_metric_bundle, youden_threshold
from .models import EstimatorFactory, _numeric, model_rows
from .resample import cluster_bootstrap, group_index, permute_labels, stratified_group_folds
from .stages import EncodedPipeline, FoldSafeEncoding

ENCODERS = 32            # replicates whose encoders come from one scan


def evaluate_by(predictions: DataFrame, by: Sequence[str], label: str = "observed",
                score: str = "probability", threshold_from: str | None = "development",
                split_col: str = "split", model_col: str = "model_key") -> DataFrame:
    """One grouped job over a stacked prediction table (many models x
    periods): each model's Youden threshold from its ``threshold_from``
    period, then the metric bundle for every (model, period)."""
    by = list(by)
    if threshold_from is None:
        thr = None
    else:
        thr = youden_threshold(predictions.filter(F.col(split_col) == threshold_from), [model_col], label, score)
    return binary_metric_bundle(predictions, by, label, score, thr)


CONVERGED = 1000         # iterations from which an elastic net is its optimum and not a limit's result


def _many(rows: DataFrame, spec: ModelSpec, estimator: EstimatorFactory) -> Design | None:
    """The shared design of replicates that are solved together, by :mod:`.many_fits`; None where each
    one is fitted by its estimator: no elastic net, one that is stopped early, or a wide design."""
    if getattr(estimator, "penalty", None) is None or estimator.max_iter < CONVERGED:
        return None
    if rows.filter(~F.col("label").isin(0, 1) | F.col("label").isNull()).limit(1).count():
        return None
    return Design.of(rows, _numeric(spec), spec.categorical)


def _p1(df: DataFrame) -> DataFrame:
    return df.withColumn("probability", vector_to_array("probability")[1])


def bootstrap_optimism(df: DataFrame, spec: ModelSpec, estimator: EstimatorFactory, n_boot: int,
                       key: str = "study_case_id", group: str = "study_patient_id",
                       seed: int = GLOBAL_SEED, parallelism: int = 4) -> DataFrame:
    """U5 (refit mode): apparent AUC - mean(bootstrap AUC - AUC of the
    bootstrap model on the original rows); SE of the latter (ddof 1).

    A replicate is a weight on the rows.  Its encoder learns from the rows it drew, as
    often as it drew them: a histogram of distinct values gives the encoders of
    ``ENCODERS`` replicates in one scan.  Elastic nets are solved together (:mod:`.many_fits`)."""
    rows = materialize(model_rows(df, spec, key, group))
    encoder = FoldSafeEncoder(_numeric(spec), spec.categorical)
    design = _many(rows, spec, estimator)
    if design is not None:
        apparent, found = bootstrap_refits(rows, encoder, design, estimator.penalty, estimator.max_iter, group, n_boot, seed)
        return _optimism(df, apparent, [(r, own - every, every) for r, own, every in found])
    enc = materialize(encoder.fit(rows).transform_vector(rows, keep=["label"]))
    apparent_model = estimator(enc.count()).fit(enc)
    apparent = auc_ap(_p1(apparent_model.transform(enc)), [], "label", "probability").first().roc_auc
    weights = cluster_bootstrap(rows.withColumn("label", F.col("label").cast("int")), group, "label", n_boot, seed)
    weights = materialize(weights)
    # redrawn single-class replicates leave gaps in the ids
    valid = sorted(r.rep for r in weights.select("rep").distinct().collect())
    encoders = {}
    for at in range(0, len(valid), ENCODERS):
        some = valid[at:at + ENCODERS]
        drawn = weights.filter(F.col("rep").isin(some)).groupBy(group).pivot("rep", some).agg(F.sum("weight"))
        names = [f"__w{r}" for r in some]
        drawn = drawn.toDF(group, *names)
        encoders.update(zip(some, encoder.fit_weighted(rows.join(drawn, group), [F.col(c) for c in names]), strict=True))

    def one(rep: int):
        own = rows.join(weights.filter(F.col("rep") == rep).select(group, F.col("weight").cast("double")),
                        group, "left")
        enc = materialize(encoders[rep].transform_vector(own, keep=["label", "weight"]))
        w = enc.filter("weight > 0")
        est = estimator(int(w.agg(F.sum("weight")).first()[0]))
        est.setWeightCol("weight")
        m = est.fit(w)
        boot_auc = auc_ap(_p1(m.transform(w)), [], "label", "probability", weight="weight").first().roc_auc
        orig_auc = auc_ap(_p1(m.transform(enc)), [], "label", "probability").first().roc_auc
        return rep, boot_auc - orig_auc, orig_auc

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        res = list(pool.map(one, valid))
    return _optimism(df, apparent, res)


def _optimism(df: DataFrame, apparent: float, res: Sequence[tuple[int, float, float]]) -> DataFrame:
    spark = df.sparkSession
    reps = spark.createDataFrame([(r, float(o), float(t)) for r, o, t in res], "rep long, optimism double, test_auc double")
    return reps.agg(F.count(F.lit(1)).alias("replicates"), F.lit(float(apparent)).alias("apparent_auc"),
                    F.avg("optimism").alias("mean_optimism"),
                    (F.lit(float(apparent)) - F.avg("optimism")).alias("optimism_corrected_auc"),
                    F.stddev_samp("test_auc").alias("test_auc_standard_error"))


def _oof_auc(encoded: Sequence[DataFrame], estimator: EstimatorFactory) -> float:
    """AUC of the out-of-fold predictions; ``encoded[f]`` are all rows as the encoder of
    training fold f sees them."""
    parts = []
    for f, enc in enumerate(encoded):
        train, valid = enc.filter(F.col("fold") != f), enc.filter(F.col("fold") == f)
        m = estimator(train.count()).fit(train)
        parts.append(_p1(m.transform(valid)).select("label", "probability"))
    return float(auc_ap(reduce(DataFrame.unionByName, parts), [], "label", "probability").first().roc_auc)


def permutation_test(df: DataFrame, spec: ModelSpec, estimator: EstimatorFactory, n_perm: int,
                     key: str = "study_case_id", group: str = "study_patient_id", k: int = OUTER_CV_SPLITS,
                     seed: int = GLOBAL_SEED, parallelism: int = 4) -> DataFrame:
    """U6 (refit mode): grouped OOF AUC on fixed folds for the real labels
    and for ``n_perm`` global label permutations (G4), refitting every
    model; p = (#{perm >= base} + 1) / (B + 1).  Elastic nets are solved together
    (:mod:`.many_fits`)."""
    rows = model_rows(df, spec, key, group)
    folds = stratified_group_folds(rows, group, "label", k, seed)
    rows = materialize(rows.join(folds, group))
    encoders, _ = FoldSafeEncoder(_numeric(spec), spec.categorical).fit_folds(rows, "fold", k)
    design = _many(rows, spec, estimator)
    if design is not None:
        base, *vals = permutation_refits(rows, encoders, design, estimator.penalty, estimator.max_iter, key, n_perm, seed).tolist()
        return _permutation_result(df, base, vals)
    # encoders never read a label, and encoding is a projection: a permutation moves the
    # plain rows once, to meet their labels, and every training fold encodes them as it reads

    def auc(labelled: DataFrame) -> float:
        return _oof_auc([e.transform_vector(labelled, keep=["label", "fold"]) for e in encoders], estimator)

    base = auc(rows)
    perm = materialize(permute_labels(rows.select(key, "label"), key, "label", n_perm, seed))
    plain = rows.drop("label", group)

    def one(b: int) -> float:
        own = perm.filter(F.col("b") == b).select(key, F.col("label_permuted").alias("label"))
        return auc(materialize(plain.join(own, key).drop(key)))

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        vals = list(pool.map(one, range(n_perm)))
    return _permutation_result(df, base, vals)


def _permutation_result(df: DataFrame, base: float, vals: Sequence[float]) -> DataFrame:
    spark = df.sparkSession
    v = spark.createDataFrame([(float(x),) for x in vals], "auc double")
    return v.agg(F.lit(base).alias("baseline_grouped_oof_auc"), F.count(F.lit(1)).alias("permutations"),
                 ((F.count(F.when(F.col("auc") >= base, 1)) + 1) / (F.count(F.lit(1)) + 1)).alias("p_value"),
                 F.avg("auc").alias("permuted_auc_mean"), F.stddev_samp("auc").alias("permuted_auc_sd"))


def learning_curve(df: DataFrame, spec: ModelSpec, estimator: EstimatorFactory,
                   fractions: Sequence[float] = LEARNING_CURVE_FRACTIONS, key: str = "study_case_id",
                   group: str = "study_patient_id", k: int = OUTER_CV_SPLITS,
                   seed: int = GLOBAL_SEED) -> DataFrame:
    """First group fold as validation; nested subsets (G6) of the
    training groups; fit per fraction (encoder on the subset only); train
    and validation AUC, rows, groups.  Single-class subsets are skipped."""
    rows = model_rows(df, spec, key, group)
    folds = stratified_group_folds(rows, group, "label", k, seed)
    rows = materialize(rows.join(folds, group))
    train, valid = rows.filter(F.col("fold") != 0), rows.filter(F.col("fold") == 0)
    gidx = materialize(group_index(train, group, seed))
    G = gidx.count()
    out = []
    for f in fractions:
        n_f = max(2, int(math.ceil(float(f) * G)))
        sub = train.join(gidx.filter(F.col("group_idx") < n_f).select(group), group, "left_semi")
        st = sub.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("p")).first()
        if not st.p or st.p == st.n:
            continue
        enc = FoldSafeEncoder(_numeric(spec), spec.categorical).fit(sub)
        m = estimator(st.n).fit(enc.transform_vector(sub, keep=["label"]))
        tr = auc_ap(_p1(m.transform(enc.transform_vector(sub, keep=["label"]))), [], "label", "probability")
        va = auc_ap(_p1(m.transform(enc.transform_vector(valid, keep=["label"]))), [], "label", "probability")
        out.append((float(f), int(n_f), int(st.n), float(tr.first().roc_auc), float(va.first().roc_auc)))
    return df.sparkSession.createDataFrame(
        out, "fraction double, patient_groups long, n_rows long, train_auc double, validation_auc double")


def nested_cv(df: DataFrame, spec: ModelSpec, estimator: EstimatorFactory, grid: dict,
              key: str = "study_case_id", group: str = "study_patient_id", outer_k: int = OUTER_CV_SPLITS,
              inner_k: int = INNER_CV_SPLITS, seed: int = GLOBAL_SEED, parallelism: int = 4) -> DataFrame:
    """Outer group folds x inner group folds (``CrossValidator`` with a
    ``foldCol``), grid of estimator params, best refit per outer fold;
    the encoder is part of the pipeline, so it is fitted on each inner training fold;
    per-fold outer AUC and best params (mean/sd over rows of the result)."""
    rows = model_rows(df, spec, key, group)
    outer = stratified_group_folds(rows, group, "label", outer_k, seed, out="outer")
    rows = materialize(rows.join(outer, group))
    res = []
    for f in range(outer_k):
        train, test = rows.filter(F.col("outer") != f), rows.filter(F.col("outer") == f)
        inner = stratified_group_folds(train, group, "label", inner_k, seed + 1 + f, out="inner")
        train = train.join(inner, group)
        train = materialize(train)
        est = estimator(train.count())
        pipeline = EncodedPipeline(stages=[FoldSafeEncoding(numericCols=_numeric(spec),
                                                            categoricalCols=list(spec.categorical)), est])
        pg = ParamGridBuilder()
        for name, values in grid.items():
            pg = pg.addGrid(est.getParam(name), list(values))
        cv = CrossValidator(estimator=pipeline, estimatorParamMaps=pg.build(), foldCol="inner", numFolds=inner_k,
                            evaluator=BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC",
                                                                  numBins=0),
                            parallelism=parallelism, seed=seed)
        fitted = cv.fit(train).bestModel
        best = fitted.stages[-1]
        auc = auc_ap(_p1(fitted.transform(test)), [], "label", "probability").first().roc_auc
        params = {n: best.getOrDefault(best.getParam(n)) for n in grid}
        res.append((f, float(auc), str(sorted(params.items()))))
    return df.sparkSession.createDataFrame(res, "outer_fold long, outer_auc double, best_params string")
