"""Risk scoring and tiers.

The rule score is a pure column expression; tiers are CASE expressions with
cut-offs as parameters; recommended actions come from a literal three-row
dimension joined by broadcast (its size is fixed by the tier list).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import col, lookup, r6, safe_div, sql_lit

# --- fixed values: rule score weights --------------------------------------
AGE_WEIGHT = {
    "[0-10)": 0.1, "[10-20)": 0.1, "[20-30)": 0.1, "[30-40)": 0.15,
    "[40-50)": 0.2, "[50-60)": 0.25, "[60-70)": 0.3,
    "[70-80)": 0.35, "[80-90)": 0.4, "[90-100)": 0.45,
}
AGE_WEIGHT_DEFAULT = 0.3
MALE_WEIGHT, OTHER_GENDER_WEIGHT = 1.0, 0.9
A1C_WEIGHT = {"Norm": 0.7, ">7": 1.2, ">8": 1.5, "None": 1.0}
INSULIN_WEIGHT = {"No": 0.8, "Steady": 1.0, "Up": 1.3, "Down": 1.2}
BASE_RISK = 0.15
SCORE_CAP = 0.95
STAY_SCALE, MEDS_SCALE, DIAGNOSES_SCALE = 10.0, 20.0, 5.0
# Largest value the rule can reach (0.15 * 0.45 * 1.0 * 1 * 1 * 1 * 1.5 * 1.3);
# dividing by it spreads the score over [0, 1] for threshold sweeps.
RULE_SCORE_MAX = 0.131625

# --- fixed values: risk tiers and recommended actions ----------------------
TIER_CUTOFFS = (0.10, 0.25)            # < .10 Low, < .25 Moderate, else High
REPORT_TIER_CUTOFFS = (0.20, 0.32)     # < .20 Low, <= .32 Moderate, > .32 High
TIER_ACTIONS = {
    "High": [
        "Schedule follow-up appointment within 7 days",
        "Implement medication reconciliation",
        "Provide enhanced discharge education",
        "Arrange home health visit",
        "Consider telehealth monitoring",
    ],
    "Moderate": [
        "Schedule follow-up appointment within 14 days",
        "Provide standard discharge education",
        "Phone check-in within first week",
        "Review medication adherence",
    ],
    "Low": [
        "Schedule routine follow-up appointment",
        "Provide standard discharge instructions",
        "Ensure patient knows when to call for concerns",
    ],
}


def _capped_factor(x, scale: float):
    """min(x / scale, 1) that stays NULL for a NULL input (no silent 1.0)."""
    ratio = col(x).cast("double") / F.lit(scale)
    return F.when(ratio.isNotNull(), F.least(ratio, F.lit(1.0)))


def rule_score(age="age", gender="gender", stay="time_in_hospital", meds="num_medications",
               diagnoses="number_diagnoses", a1c="A1Cresult", insulin="insulin"):
    """R2: multiplicative rule score, capped at 0.95. Factor order is fixed so
    both engines produce the same double."""
    age_w = F.coalesce(lookup(col(age), AGE_WEIGHT), F.lit(AGE_WEIGHT_DEFAULT))
    gender_w = F.when(col(gender) == "Male", F.lit(MALE_WEIGHT)).otherwise(F.lit(OTHER_GENDER_WEIGHT))
    a1c_w = F.coalesce(lookup(col(a1c), A1C_WEIGHT), F.lit(1.0))
    ins_w = F.coalesce(lookup(col(insulin), INSULIN_WEIGHT), F.lit(1.0))
    factors = (age_w * gender_w * _capped_factor(stay, STAY_SCALE) * _capped_factor(meds, MEDS_SCALE)
               * _capped_factor(diagnoses, DIAGNOSES_SCALE) * a1c_w * ins_w)
    raw = F.lit(BASE_RISK) * factors
    return F.when(raw.isNotNull(), F.least(raw, F.lit(SCORE_CAP)))


def with_rule_score(df: DataFrame) -> DataFrame:
    """Adds ``rule_score`` and ``scaled_rule_score`` (rounded to 6 places)."""
    df = df.withColumn("rule_score", rule_score())
    return df.withColumn("scaled_rule_score", r6(F.col("rule_score") / F.lit(RULE_SCORE_MAX)))


def risk_tier(score, cutoffs: Sequence[float] = TIER_CUTOFFS):
    """< low Low, < high Moderate, else High."""
    lo, hi = cutoffs
    s = col(score) if isinstance(score, str) else score
    return (F.when(s < lo, F.lit("Low")).when(s < hi, F.lit("Moderate"))
            .when(s.isNotNull(), F.lit("High")))


def report_tier(score, cutoffs: Sequence[float] = REPORT_TIER_CUTOFFS):
    """> high High, >= low Moderate, else Low (published report cut-offs)."""
    lo, hi = cutoffs
    s = col(score) if isinstance(score, str) else score
    return (F.when(s > hi, F.lit("High")).when(s >= lo, F.lit("Moderate"))
            .when(s.isNotNull(), F.lit("Low")))


def action_dimension(spark: SparkSession) -> DataFrame:
    """(risk_tier, actions array): a three-row literal relation (JVM-side)."""
    rows = ", ".join("(" + sql_lit(t) + ", array(" + ", ".join(sql_lit(a) for a in acts) + "))"
                     for t, acts in TIER_ACTIONS.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(risk_tier, actions)")


def recommended_actions(df: DataFrame, *, tier: str = "risk_tier",
                        key: str = "encounter_id") -> DataFrame:
    """Long form (key, tier, action_no, action) via a broadcast lookup of the
    three-row action table and ``posexplode``."""
    dim = F.broadcast(action_dimension(df.sparkSession).withColumnRenamed("risk_tier", tier))
    # left join: an inner join would infer "tier IS NOT NULL" and push the
    # whole score expression into a second filter copy; posexplode of the
    # NULL array of an unmatched row yields nothing, so the result is equal
    return (df.select(key, tier).join(dim, tier, "left")
            .select(key, tier, F.posexplode("actions").alias("pos", "action"))
            .select(key, tier, (F.col("pos") + 1).alias("action_no"), "action"))


def tier_population(df: DataFrame, *, tier: str = "risk_tier", label: str = "readmitted_30d",
                    score: str = "rule_score") -> DataFrame:
    """Per tier count, share of all, actual return rate and mean score."""
    agg = df.groupBy(tier).agg(F.count(F.lit(1)).alias("count"),
                               F.avg(col(label)).alias("rate"), F.avg(col(score)).alias("mean"))
    total = F.sum("count").over(Window.partitionBy())  # over the three tiers
    return agg.select(tier, "count", r6(safe_div(F.col("count"), total)).alias("share"),
                      r6(F.col("rate")).alias("actual_rate"), r6(F.col("mean")).alias("mean_score"))


# --- fixed values: raw defaults for patients scored with partial inputs ----
# (derived columns are never defaulted; they are recomputed from these)
RAW_DEFAULTS = {
    "race": "Caucasian",
    "admission_type_id": 1,
    "discharge_disposition_id": 1,
    "admission_source_id": 7,
    "medical_specialty": "Internal Medicine",
    "number_outpatient": 0,
    "number_emergency": 0,
    "number_inpatient": 0,
    "diabetesMed": "Yes",
    "change": "No",
    "max_glu_serum": "None",
    "A1Cresult": "None",
    "diag_1": "428",
    "diag_2": "250",
    "diag_3": "250",
}


# raw columns without a default: a patient row must bring them
RAW_REQUIRED = ("age", "gender", "time_in_hospital", "num_medications", "num_lab_procedures",
                "num_procedures", "number_diagnoses")


def score_patients(patients: DataFrame, prep, model, codes: DataFrame, *,
                   defaults: dict | None = None, codes_bounded: bool = False) -> DataFrame:
    """R1 end to end: raw patient rows -> cleaning -> features -> fitted
    preparation -> model -> score and tier. ``RAW_REQUIRED`` columns must be
    there; other raw columns may be absent and take their default."""
    from pyspark.ml.functions import vector_to_array

    from ..schema import MEDICATIONS
    from .clean import clean
    from .features import features
    fill = dict(RAW_DEFAULTS if defaults is None else defaults)
    for m in MEDICATIONS:
        fill.setdefault(m, "No")
    absent = [c for c in RAW_REQUIRED if c not in patients.columns and c not in fill]
    if absent:
        raise ValueError(f"patients lack columns without a default: {', '.join(absent)}")
    missing = {c: F.lit(v) for c, v in fill.items() if c not in patients.columns}
    df = patients.withColumns(missing) if missing else patients
    present = {c: v for c, v in fill.items() if c in patients.columns}
    df = df.na.fill(present) if present else df
    fea = features(clean(df, codes, codes_bounded=codes_bounded))
    out = model.transform(prep.transform(fea))
    score = vector_to_array("probability")[1]
    return out.select(*[c for c in ("encounter_id",) if c in out.columns],
                      score.alias("risk_score"), risk_tier(score).alias("risk_tier"))
