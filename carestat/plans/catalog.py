"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each query reads the given tables through the encounter view, so its work
grows with them. Names carry the inventory id they exercise.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import col
from ..operators import profile as P
from ..schema import DIAG_COLUMNS, MEDICATIONS, NUMERIC_COLUMNS
from . import tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


FEATURE_COLUMNS = ["age_numeric", "age_group", "total_visits", "total_meds_used",
                   "med_diversity_ratio", "diagnosis_complexity", "stay_length_cat",
                   "lab_intensity", "primary_diabetes", "any_diabetes_diag",
                   "has_circulatory_disease", "has_respiratory_disease",
                   "circulatory_respiratory_comorbidity", "insulin_with_high_A1C",
                   "med_changes_count"]
CLINICAL_NUMERIC = ["time_in_hospital", "num_lab_procedures", "num_procedures",
                    "num_medications", "number_diagnoses"]


def _pick(df: DataFrame, cols) -> DataFrame:
    return df.select(*[col(c) for c in cols])


# ------------------------------------------------------------- sources ----
@query("s1_encounter_view")
def s1_encounter_view(spark, sf_dir):
    return tables.raw(spark, sf_dir)


@query("s7_target_distribution")
def s7_target_distribution(spark, sf_dir):
    return P.value_distribution(tables.sentinel_free(spark, sf_dir), "readmitted")


# ------------------------------------------------------------- cleaning ---
@query("c1_sentinel_nulls")
def c1_sentinel_nulls(spark, sf_dir):
    return _pick(tables.cleaned(spark, sf_dir),
                 ["encounter_id", "race", "medical_specialty", *DIAG_COLUMNS])


@query("c2_decoded_codes")
def c2_decoded_codes(spark, sf_dir):
    return _pick(tables.cleaned(spark, sf_dir),
                 ["encounter_id", "admission_type", "discharge_disposition", "admission_source"])


@query("c3_numeric_columns")
def c3_numeric_columns(spark, sf_dir):
    return _pick(tables.cleaned(spark, sf_dir), ["encounter_id", *NUMERIC_COLUMNS])


@query("c4_c5_medication_flags")
def c4_c5_medication_flags(spark, sf_dir):
    cols = [c for m in MEDICATIONS for c in (f"{m}_used", f"{m}_dosage")]
    return _pick(tables.cleaned(spark, sf_dir), ["encounter_id", *cols])


@query("c6_c8_diagnosis_columns")
def c6_c8_diagnosis_columns(spark, sf_dir):
    cols = [f"{d}_{s}" for d in DIAG_COLUMNS
            for s in ("category", "is_diabetes", "is_circulatory", "is_respiratory")]
    return _pick(tables.cleaned(spark, sf_dir), ["encounter_id", *cols])


@query("c9_c12_lab_and_targets")
def c9_c12_lab_and_targets(spark, sf_dir):
    return _pick(tables.cleaned(spark, sf_dir),
                 ["encounter_id", "A1C_value", "glucose_value", "readmitted_30d",
                  "readmitted_class"])


@query("c13_cleaned_table")
def c13_cleaned_table(spark, sf_dir):
    return tables.cleaned(spark, sf_dir)


# ------------------------------------------------------------- features ---
@query("f1_f14_features")
def f1_f14_features(spark, sf_dir):
    return _pick(tables.featured(spark, sf_dir), ["encounter_id", *FEATURE_COLUMNS])


# ------------------------------------------------------------- profiling --
@query("p1_shape")
def p1_shape(spark, sf_dir):
    return P.shape(tables.raw(spark, sf_dir))


@query("p2_missing_profile")
def p2_missing_profile(spark, sf_dir):
    return P.missing_profile(tables.sentinel_free(spark, sf_dir))


@query("p3_race_distribution")
def p3_race_distribution(spark, sf_dir):
    return P.value_distribution(tables.sentinel_free(spark, sf_dir), "race")


@query("p4_age_distribution")
def p4_age_distribution(spark, sf_dir):
    return P.value_distribution(tables.sentinel_free(spark, sf_dir), "age", order_by_key=True)


@query("p5_rate_by_age")
def p5_rate_by_age(spark, sf_dir):
    return P.rate_by_category(tables.cleaned(spark, sf_dir, keep_ids=True), "age")


@query("p5_rates_by_category")
def p5_rates_by_category(spark, sf_dir):
    return P.rates_by_categories(tables.cleaned(spark, sf_dir, keep_ids=True), P.RATE_COLUMNS)


@query("p5_rate_by_diagnosis_join")
def p5_rate_by_diagnosis_join(spark, sf_dir):
    return P.rate_by_category_join(tables.cleaned(spark, sf_dir), "diag_1_category")


@query("p6_rate_pct_by_group")
def p6_rate_pct_by_group(spark, sf_dir):
    cols = [*P.DEMOGRAPHIC_COLUMNS, *P.CLINICAL_CATEGORICAL_COLUMNS, *MEDICATIONS]
    return P.rates_by_categories(tables.featured(spark, sf_dir), cols, percent=True,
                                 rate_name="readmission_rate")


@query("p7_extreme_groups")
def p7_extreme_groups(spark, sf_dir):
    return P.extreme_groups(tables.featured(spark, sf_dir),
                            [*P.DEMOGRAPHIC_COLUMNS, *P.CLINICAL_CATEGORICAL_COLUMNS])


@query("p8_binned_rates")
def p8_binned_rates(spark, sf_dir):
    return P.binned_rates(tables.featured(spark, sf_dir))


@query("p9_numeric_correlations")
def p9_numeric_correlations(spark, sf_dir):
    return P.correlations(tables.featured(spark, sf_dir), NUMERIC_COLUMNS, include_target=True)


@query("p10_medication_correlations")
def p10_medication_correlations(spark, sf_dir):
    return P.correlations(tables.featured(spark, sf_dir), [f"{m}_used" for m in MEDICATIONS])


@query("p11_correlation_trend")
def p11_correlation_trend(spark, sf_dir):
    return P.correlation_trend(tables.featured(spark, sf_dir), CLINICAL_NUMERIC)


@query("p12_medication_usage")
def p12_medication_usage(spark, sf_dir):
    return P.medication_usage(tables.featured(spark, sf_dir))


@query("p13_medication_rate_difference")
def p13_medication_rate_difference(spark, sf_dir):
    return P.medication_rate_difference(tables.featured(spark, sf_dir))


@query("p14_box_summary")
def p14_box_summary(spark, sf_dir):
    return P.box_summary(tables.featured(spark, sf_dir))


@query("p15_top_readouts")
def p15_top_readouts(spark, sf_dir):
    fea = tables.featured(spark, sf_dir)
    num = P.correlations(fea, NUMERIC_COLUMNS)
    med = P.correlations(fea, [f"{m}_used" for m in MEDICATIONS])
    age = P.rate_by_category(fea, "age")
    diag = P.rate_by_category(fea, "diag_1_category")
    return (P.top_k(num, "correlation", "feature", 5, "numeric_correlation")
            .unionByName(P.top_k(med, "correlation", "feature", 5, "medication_correlation"))
            .unionByName(P.top_k(age, "readmission_rate_30d", "age", 3, "age_rate"))
            .unionByName(P.top_k(diag, "readmission_rate_30d", "diag_1_category", 3,
                                 "diagnosis_rate")))


@query("p16_pick_lists")
def p16_pick_lists(spark, sf_dir):
    return P.distinct_values(tables.featured(spark, sf_dir), ["age", "gender"])


@query("p18_band_rates")
def p18_band_rates(spark, sf_dir):
    return P.band_comparisons(tables.featured(spark, sf_dir))


@query("p19_comorbidity_lift")
def p19_comorbidity_lift(spark, sf_dir):
    return P.comorbidity_lift(tables.featured(spark, sf_dir))


# ------------------------------------------------------------- scoring ----
from ..operators import impact as B  # noqa: E402
from ..operators import metrics as E  # noqa: E402
from ..operators import score as R  # noqa: E402


def rule_scored(spark, sf_dir) -> DataFrame:
    """Featured encounters with the rule score and its tiers."""
    df = R.with_rule_score(tables.featured(spark, sf_dir))
    return df.withColumns({"risk_tier": R.risk_tier("rule_score"),
                           "report_tier": R.report_tier("scaled_rule_score")})


def scored_population(spark, sf_dir) -> DataFrame:
    """(encounter_id, label, score): the rule score over its maximum, unrounded, as probability."""
    df = rule_scored(spark, sf_dir).withColumn("share", F.col("rule_score") / F.lit(R.RULE_SCORE_MAX))
    return E.scored_view(df, "readmitted_30d", "share", key="encounter_id")


@query("r2_rule_score")
def r2_rule_score(spark, sf_dir):
    df = rule_scored(spark, sf_dir)
    return df.select("encounter_id", F.round("rule_score", 9).alias("rule_score"),
                     "scaled_rule_score")


@query("r3_r4_risk_tiers")
def r3_r4_risk_tiers(spark, sf_dir):
    return rule_scored(spark, sf_dir).select("encounter_id", "risk_tier", "report_tier")


@query("r5_recommended_actions")
def r5_recommended_actions(spark, sf_dir):
    return R.recommended_actions(rule_scored(spark, sf_dir))


@query("r6_tier_population")
def r6_tier_population(spark, sf_dir):
    return R.tier_population(rule_scored(spark, sf_dir))


# ------------------------------------------------------------ evaluation --
@query("e2_confusion_matrix")
def e2_confusion_matrix(spark, sf_dir):
    return E.confusion(scored_population(spark, sf_dir))


@query("e3_threshold_metrics")
def e3_threshold_metrics(spark, sf_dir):
    return E.threshold_metrics(scored_population(spark, sf_dir))


@query("e4_class_report")
def e4_class_report(spark, sf_dir):
    return E.class_report(scored_population(spark, sf_dir))


@query("e5_e6_ranking_metrics")
def e5_e6_ranking_metrics(spark, sf_dir):
    return E.ranking_metrics(scored_population(spark, sf_dir))


@query("e7_roc_points")
def e7_roc_points(spark, sf_dir):
    return E.roc_points(scored_population(spark, sf_dir))


@query("e8_pr_points")
def e8_pr_points(spark, sf_dir):
    return E.pr_points(scored_population(spark, sf_dir))


@query("e9_prevalence")
def e9_prevalence(spark, sf_dir):
    return E.prevalence(scored_population(spark, sf_dir))


@query("e10_normalized_confusion")
def e10_normalized_confusion(spark, sf_dir):
    return E.normalized_confusion(scored_population(spark, sf_dir))


@query("e11_comparison_table")
def e11_comparison_table(spark, sf_dir):
    sc = scored_population(spark, sf_dir)
    return E.comparison_table([E.model_metrics(sc, "Rule Score", 0.5, 0),
                               E.model_metrics(sc, "Rule Score (threshold 0.3)", 0.3, 1)])


@query("e14_score_histogram")
def e14_score_histogram(spark, sf_dir):
    return E.score_histogram(scored_population(spark, sf_dir))


# ---------------------------------------------------------------- impact --
@query("b1_b3_cost_analysis")
def b1_b3_cost_analysis(spark, sf_dir):
    return B.cost_analysis(scored_population(spark, sf_dir))


@query("b2_scenarios")
def b2_scenarios(spark, sf_dir):
    return B.scenarios(B.cost_analysis(scored_population(spark, sf_dir)))


@query("b4_high_risk_summary")
def b4_high_risk_summary(spark, sf_dir):
    return B.high_risk_summary(scored_population(spark, sf_dir))


@query("b5_threshold_sweep")
def b5_threshold_sweep(spark, sf_dir):
    return B.threshold_sweep(scored_population(spark, sf_dir))


@query("b6_high_risk_profile")
def b6_high_risk_profile(spark, sf_dir):
    return B.high_risk_profile(tables.featured(spark, sf_dir), scored_population(spark, sf_dir))


@query("b7_intervention_optimization")
def b7_intervention_optimization(spark, sf_dir):
    return B.intervention_optimization(B.threshold_sweep(scored_population(spark, sf_dir)))


@query("b8_optimal_threshold")
def b8_optimal_threshold(spark, sf_dir):
    return B.optimal_threshold(
        B.intervention_optimization(B.threshold_sweep(scored_population(spark, sf_dir))))


@query("b9_hospital_sizes")
def b9_hospital_sizes(spark, sf_dir):
    sc = scored_population(spark, sf_dir)
    opt = B.optimal_threshold(B.intervention_optimization(B.threshold_sweep(sc)))
    return B.scale_to_sizes(opt, sc.agg(F.count(F.lit(1)).alias("total_patients")))


@query("b10_what_if_grid")
def b10_what_if_grid(spark, sf_dir):
    return B.what_if_grid(B.threshold_sweep(scored_population(spark, sf_dir)))


@query("b11_strategy_comparison")
def b11_strategy_comparison(spark, sf_dir):
    return B.strategy_comparison(B.cost_analysis(scored_population(spark, sf_dir)))


@query("b12_top_fraction_capture")
def b12_top_fraction_capture(spark, sf_dir):
    return B.top_fraction_capture(scored_population(spark, sf_dir))


@query("b13_size_benefits")
def b13_size_benefits(spark, sf_dir):
    return B.size_benefits(scored_population(spark, sf_dir))


@query("s11_kpi_table")
def s11_kpi_table(spark, sf_dir):
    sc = scored_population(spark, sf_dir)
    opt = B.optimal_threshold(B.intervention_optimization(B.threshold_sweep(sc)))
    return B.kpi_table(B.cost_analysis(sc), opt)


# ------------------------------------------------------------ modelling ---
import uuid  # noqa: E402

from ..operators import prepare as M  # noqa: E402
from ..operators import train as T  # noqa: E402
from ..session import ensure_checkpoint_dir, scratch_path  # noqa: E402
from ..sources import sinks as SK  # noqa: E402


def split_view(spark, sf_dir) -> DataFrame:
    """Key, label and model features of the featured rows, with the exact split. They are derived once and kept as
    Parquet in the shared checkpoint folder: the split's own passes read a key and a label of it, model preparation
    the columns it needs. Columns that no model takes are not derived."""
    def build():
        path = scratch_path(spark, f"featured-{uuid.uuid4().hex}")
        rows = tables.featured(spark, sf_dir)
        taken = {"encounter_id", M.TARGET, *M11_TEXTS, *(c for g in M.feature_groups(rows).values() for c in g)}
        SK.write_table(_pick(rows, [c for c in rows.columns if c in taken]), path)
        return M.stratified_split(spark.read.parquet(path))
    return tables._memo("split", spark, sf_dir, build)


def split_keys(spark, sf_dir) -> DataFrame:
    """Key, label and split of every encounter, as in ``split_view``: the split hangs on these two columns alone, so
    only they are derived and kept (the optimizer leaves out line items, which add no rows, and features)."""
    def build():
        path = scratch_path(spark, f"labels-{uuid.uuid4().hex}")
        SK.write_table(tables.featured(spark, sf_dir).select("encounter_id", M.TARGET), path)
        return M.stratified_split(spark.read.parquet(path))
    return tables._memo("split_keys", spark, sf_dir, build)


@query("m3_stratified_split")
def m3_stratified_split(spark, sf_dir):
    return split_keys(spark, sf_dir).select("encounter_id", "readmitted_30d", "split")


@query("p17_class_counts")
def p17_class_counts(spark, sf_dir):
    return P.class_counts(split_keys(spark, sf_dir))


@query("t1_class_weights")
def t1_class_weights(spark, sf_dir):
    train = split_keys(spark, sf_dir).filter(F.col("split") == "train")
    return T.class_weights(train.withColumnRenamed("readmitted_30d", "label"))


def preparation_view(spark, sf_dir):
    """The preparation fitted on the training rows (memoized per session)."""
    def build():
        split = split_view(spark, sf_dir)
        return M.fit_preparation(split.filter(F.col("split") == "train"), M.feature_groups(split))
    return tables._memo("preparation", spark, sf_dir, build)


def matrix_view(spark, sf_dir):
    """(matrix, preparation): split + train-fitted preparation, checkpointed to
    the shared checkpoint folder so six fits and the scoring reuse it without
    recomputing the encounter pipeline (and survive executor loss)."""
    def build():
        ensure_checkpoint_dir(spark)
        split, prep = split_view(spark, sf_dir), preparation_view(spark, sf_dir)
        matrix = prep.transform(split).select(
            "encounter_id", F.col("readmitted_30d").alias("label"), "split", "features")
        # iterative training pays per partition and per round: size the
        # partitions by rows (~1M each), never below the cluster's parallelism
        n_rows = split.count()
        parts = max(spark.sparkContext.defaultParallelism, -(-n_rows // 1_000_000))
        return matrix.repartition(parts).checkpoint(), prep
    return tables._memo("matrix", spark, sf_dir, build)


def model_view(spark, sf_dir, name):
    """One fitted model of the suite (memoized per session)."""
    def build():
        matrix, _ = matrix_view(spark, sf_dir)
        factory, scheme, over = T.model_suite()[name]
        return T.fit(matrix.filter(F.col("split") == "train"), factory, scheme, over)
    return tables._memo(f"model:{name}", spark, sf_dir, build)


def suite_view(spark, sf_dir):
    """Six fitted models and their test metrics (memoized per session)."""
    def build():
        matrix, _ = matrix_view(spark, sf_dir)
        test = matrix.filter(F.col("split") == "test")
        # the fits are independent: their jobs share the cluster
        with ThreadPoolExecutor(len(T.MODEL_ORDER)) as pool:
            fitted = dict(zip(T.MODEL_ORDER, pool.map(lambda n: model_view(spark, sf_dir, n), T.MODEL_ORDER)))
        rows = [E.model_metrics(E.scored_view(T.predict(fitted[n], test), "label", "score"), n, 0.5, i)
                for i, n in enumerate(T.MODEL_ORDER)]
        out = rows[0]
        for r in rows[1:]:
            out = out.unionByName(r)
        return out.checkpoint(), fitted
    return tables._memo("suite", spark, sf_dir, build)


@query("m10_feature_names")
def m10_feature_names(spark, sf_dir):
    prep = preparation_view(spark, sf_dir)
    return M.feature_name_table(prep, spark)


@query("m4_m5_numeric_statistics")
def m4_m5_numeric_statistics(spark, sf_dir):
    prep = preparation_view(spark, sf_dir)
    return M.numeric_statistics(prep, spark)


@query("m6_categorical_modes")
def m6_categorical_modes(spark, sf_dir):
    prep = preparation_view(spark, sf_dir)
    return M.categorical_modes(prep, spark)


@query("t8_e11_model_comparison")
def t8_e11_model_comparison(spark, sf_dir):
    rows, _ = suite_view(spark, sf_dir)
    return E.comparison_table([rows.orderBy("model_order")])


@query("t9_best_model")
def t9_best_model(spark, sf_dir):
    rows, _ = suite_view(spark, sf_dir)
    return E.best_model(rows)


@query("e1_best_model_predictions")
def e1_best_model_predictions(spark, sf_dir):
    rows, fitted = suite_view(spark, sf_dir)
    best = E.best_model(rows).first()["model"]
    matrix, _ = matrix_view(spark, sf_dir)
    return T.predict(fitted[best], matrix.filter(F.col("split") == "test"))


@query("e12_feature_importance")
def e12_feature_importance(spark, sf_dir):
    _, prep = matrix_view(spark, sf_dir)
    return T.feature_importance(model_view(spark, sf_dir, "Random Forest"), prep.feature_names,
                                spark, top_n=20)


@query("e13_linear_contributions")
def e13_linear_contributions(spark, sf_dir):
    from ..operators.explain import mean_abs_contributions
    matrix, prep = matrix_view(spark, sf_dir)
    return mean_abs_contributions(model_view(spark, sf_dir, "Logistic Regression"),
                                  matrix.filter(F.col("split") == "test"), prep.feature_names)


@query("r1_batch_scoring")
def r1_batch_scoring(spark, sf_dir):
    from ..sources.codes import code_dimension
    prep = preparation_view(spark, sf_dir)
    model = model_view(spark, sf_dir, "Logistic Regression")
    return R.score_patients(tables.raw(spark, sf_dir), prep, model, code_dimension(spark))


@query("e13_tree_permutation_importance")
def e13_tree_permutation_importance(spark, sf_dir):
    from ..operators.explain import permutation_importance
    matrix, prep = matrix_view(spark, sf_dir)
    return permutation_importance(model_view(spark, sf_dir, "Random Forest"),
                                  matrix.filter(F.col("split") == "test"), prep.feature_names)


@query("e13_tree_contributions")
def e13_tree_contributions(spark, sf_dir):
    from ..operators.tree_shap import mean_contributions, tree_contributions
    matrix, prep = matrix_view(spark, sf_dir)
    rows = tree_contributions(model_view(spark, sf_dir, "Random Forest"), matrix.filter(F.col("split") == "test"))
    return mean_contributions(rows, prep.feature_names)


# --------------------------------------- files, saved models, model checks ---
from ..operators import verify as V  # noqa: E402
from ..sources import codes as CD  # noqa: E402
from ..sources import encounters as EN  # noqa: E402


def encounter_lines(spark, sf_dir) -> tuple[str, list[str]]:
    """The raw encounters as CSV lines in the shared folder, and the first three fields of every
    seventh one again, as a line that was cut off. Returns the folder and the column names."""
    raw = tables.raw(spark, sf_dir)
    path = scratch_path(spark, f"encounters-{uuid.uuid4().hex}")
    whole = F.to_csv(F.struct(*[col(c) for c in raw.columns]))
    cut = F.to_csv(F.struct("encounter_id", "patient_nbr", "race"))
    # both lines of a row at once: the encounters are derived once
    lines = F.when(F.col("encounter_id") % 7 == 0, F.array(whole, cut)).otherwise(F.array(whole))
    raw.select(F.explode(lines).alias("value")).write.text(path)
    return path, raw.columns


@query("s1_s8_csv_encounters")
def s1_s8_csv_encounters(spark, sf_dir):
    path, names = encounter_lines(spark, sf_dir)
    return EN.read_encounters_csv(spark, path, names)


@query("s1_malformed_lines")
def s1_malformed_lines(spark, sf_dir):
    path, names = encounter_lines(spark, sf_dir)
    bad = EN.malformed_lines(spark, path, names)
    return bad.select("line", F.size(F.split("line", ",")).alias("fields"))


@query("s8_table_round_trip")
def s8_table_round_trip(spark, sf_dir):
    """The cleaned table written by return class and read back."""
    path = scratch_path(spark, f"cleaned-{uuid.uuid4().hex}")
    SK.write_table(tables.cleaned(spark, sf_dir, keep_ids=True), path, partition_by=["readmitted"])
    return spark.read.parquet(path).select("encounter_id", "readmitted", "readmitted_30d", "time_in_hospital", "race")


@query("s6_missing_columns")
def s6_missing_columns(spark, sf_dir):
    return EN.missing_expected_columns(tables.raw(spark, sf_dir).drop("race", "insulin", "readmitted"))


def _code_file(spark, rows) -> str:
    return SK.write_table(rows, scratch_path(spark, f"codes-{uuid.uuid4().hex}"), "csv")


def _nations(spark, sf_dir):
    """Names of nations and regions stand for code descriptions."""
    n, r = (spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet") for t in ("nation", "region"))
    return n.join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey"))


@query("s2_s4_codes_with_category")
def s2_s4_codes_with_category(spark, sf_dir):
    rows = _nations(spark, sf_dir).select(F.col("r_name").alias("category"), F.when(F.col("n_nationkey") % 6 == 5, "x").otherwise(F.col("n_nationkey").cast("string")).alias("id"),
                                          F.when(F.col("n_nationkey") % 4 == 0, "NULL").otherwise(F.col("n_name")).alias("description"))
    return CD.read_code_list(spark, _code_file(spark, rows))


@query("s2_s4_codes_by_description")
def s2_s4_codes_by_description(spark, sf_dir):
    marks = F.array(*[F.lit(m.title()) for m in CD.CATEGORY_MARKERS.values()], F.lit("Other"))
    rows = _nations(spark, sf_dir).select(F.col("n_nationkey").alias("id"), F.concat_ws(" ", F.get(marks, F.col("n_nationkey") % 4), "n_name").alias("description"))
    return CD.read_code_list(spark, _code_file(spark, rows))


@query("s2_s5_codes_fallback")
def s2_s5_codes_fallback(spark, sf_dir):
    """A file of neither shape: the short lists, one category of them."""
    rows = _nations(spark, sf_dir).select("n_nationkey", "n_name")
    return CD.category_codes(CD.read_code_list(spark, _code_file(spark, rows)), "discharge_disposition")


M11_TEXTS = ["stay_text", "lab_text", "diag_1", "diag_2", "age"]


def residual_text_parts(spark, sf_dir):
    """Training and test rows with text columns: of numbers, of numbers in the training rows only, of codes."""
    df = split_view(spark, sf_dir).withColumns({
        "stay_text": F.concat(F.lit(" "), F.col("time_in_hospital").cast("string"), F.lit(".50 ")),
        "lab_text": F.when((F.col("split") == "test") & (F.col("num_lab_procedures") > 60), "many").otherwise(F.col("num_lab_procedures").cast("string"))})
    return df.where("split = 'train'"), df.where("split = 'test'")


@query("m11_residual_text_kinds")
def m11_residual_text_kinds(spark, sf_dir):
    return M.residual_text_kinds(*residual_text_parts(spark, sf_dir), M11_TEXTS)


@query("m11_resolved_text")
def m11_resolved_text(spark, sf_dir):
    """Per column and part after M11: numbers added up, or categories counted."""
    train, test, texts = M.resolve_residual_text(*residual_text_parts(spark, sf_dir), M11_TEXTS)
    rows = train.select("split", *M11_TEXTS).unionByName(test.select("split", *M11_TEXTS))
    values = F.array(*[F.struct(F.lit(c).alias("feature"), (F.lit(None).cast("double") if c in texts else col(c)).alias("x"),
                                (col(c) if c in texts else F.lit(None).cast("string")).alias("v")) for c in M11_TEXTS])
    return (rows.select("split", F.inline(values)).groupBy("feature", "split")
            .agg(F.round(F.sum("x"), 6).alias("total"), F.count_distinct("v").alias("categories")))


@query("m7_m9_matrix_rows")
def m7_m9_matrix_rows(spark, sf_dir):
    matrix, prep = matrix_view(spark, sf_dir)
    return M.matrix_rows(matrix, prep)


@query("s9_s10_saved_scores")
def s9_s10_saved_scores(spark, sf_dir):
    """Preparation, matrix and model saved, the first model that exists loaded, the test rows prepared and scored
    anew: whether the loaded ones give the scores of the fitted ones."""
    matrix, prep = matrix_view(spark, sf_dir)
    model = model_view(spark, sf_dir, "Logistic Regression")
    base = scratch_path(spark, f"saved-{uuid.uuid4().hex}")
    prep.save(spark, f"{base}/preparation")
    SK.save_model_ready(matrix, f"{base}/matrix")
    T.save_model(model, f"{base}/model")
    loaded = T.load_first([f"{base}/absent", f"{base}/model"])
    again = M.Preparation.load(spark, f"{base}/preparation")
    test = split_view(spark, sf_dir).where("split = 'test'")
    anew = T.predict(loaded, again.transform(test).withColumnRenamed("readmitted_30d", "label")).select("encounter_id", F.col("score").alias("anew"))
    kept = T.predict(loaded, SK.load_model_ready(spark, f"{base}/matrix").where("split = 'test'")).select("encounter_id", F.col("score").alias("kept"))
    own = T.predict(model, matrix.where("split = 'test'"))
    return (own.join(anew, "encounter_id", "full").join(kept, "encounter_id", "full")
            .select("encounter_id", F.col("label").cast("int").alias("label"), F.coalesce((F.col("score") == F.col("anew")) & (F.col("score") == F.col("kept")), F.lit(False)).alias("same")))


@query("t2_logistic_optimality")
def t2_logistic_optimality(spark, sf_dir):
    """Per coefficient of the logistic fit: whether the gradient of its objective is 0 within 1e-3."""
    matrix, prep = matrix_view(spark, sf_dir)
    train = T.with_weights(matrix.where("split = 'train'"), T.model_suite()["Logistic Regression"][1])
    g = V.logistic_gradient(model_view(spark, sf_dir, "Logistic Regression"), train, prep.feature_names)
    return g.select("feature", (F.abs("gradient") < 1e-3).alias("at_optimum"))


@query("t3_t8_e1_prediction_checks")
def t3_t8_e1_prediction_checks(spark, sf_dir):
    """Per model: its test rows and positives, scores outside [0, 1], and whether the comparison's figures follow
    from the predictions, counted another way."""
    rows, fitted = suite_view(spark, sf_dir)
    test = matrix_view(spark, sf_dir)[0].where("split = 'test'")
    figures = None
    for name in T.MODEL_ORDER:
        one = V.prediction_figures(T.predict(fitted[name], test).select("label", "score")).withColumn("model", F.lit(name))
        figures = one if figures is None else figures.unionByName(one)
    names = ["accuracy", "precision", "recall", "f1", "roc_auc"]
    met = figures.alias("a").join(rows.alias("b"), "model")
    agrees = F.lit(True)
    for c in names:
        agrees &= F.abs(F.col(f"a.{c}") - F.col(f"b.{c}")) <= 1e-6
    return met.select("model", F.col("rows").cast("long").alias("rows"), F.col("positives").cast("long").alias("positives"),
                      F.col("outside").cast("long").alias("outside"), agrees.alias("agrees"))
