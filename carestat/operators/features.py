"""Feature projections F1-F14 on the cleaned encounter table.

Feature lists are constants filtered by presence (a suffix search over an
already featured table would also pick up ``total_meds_used``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col, cut_right_closed, lookup_col
from ..schema import DIAG_COLUMNS, MEDICATIONS, VISIT_COLUMNS

# --- fixed values: age band midpoints and right-closed bin tables ---------
AGE_MIDPOINT = {
    "[0-10)": 5, "[10-20)": 15, "[20-30)": 25, "[30-40)": 35, "[40-50)": 45,
    "[50-60)": 55, "[60-70)": 65, "[70-80)": 75, "[80-90)": 85, "[90-100)": 95,
}
AGE_MIDPOINT_DEFAULT = 50
AGE_GROUP_BINS = ([0, 30, 50, 70, 100], ["Young", "Middle", "Senior", "Elderly"])
DIAGNOSIS_COMPLEXITY_BINS = ([0, 3, 6, 9, 20], ["Low", "Medium", "High", "Very High"])
STAY_LENGTH_BINS = ([0, 3, 7, 14, 100], ["Short", "Medium", "Long", "Very Long"])
LAB_INTENSITY_BINS = ([0, 25, 50, 75, 1000], ["Low", "Medium", "High", "Very High"])


def _sum(cols):
    return reduce(lambda a, b: a + b, cols)


def features(df: DataFrame) -> DataFrame:
    """Adds the 15 engineered features (those whose inputs are present)."""
    have = set(df.columns)
    first = {}
    if "age" in have:
        age_num = lookup_col("age", AGE_MIDPOINT, AGE_MIDPOINT_DEFAULT)
        first["age_numeric"] = age_num
        first["age_group"] = cut_right_closed(age_num, *AGE_GROUP_BINS)
    if all(c in have for c in VISIT_COLUMNS):
        first["total_visits"] = _sum([F.coalesce(col(c), F.lit(0)) for c in VISIT_COLUMNS])
    used = [f"{m}_used" for m in MEDICATIONS if f"{m}_used" in have]
    if used:
        total = F.expr(" + ".join(f"`{c}`" for c in used))
        first["total_meds_used"] = total
        first["med_diversity_ratio"] = total / F.lit(float(len(used)))
    if "number_diagnoses" in have:
        first["diagnosis_complexity"] = cut_right_closed(col("number_diagnoses"), *DIAGNOSIS_COMPLEXITY_BINS)
    if "time_in_hospital" in have:
        first["stay_length_cat"] = cut_right_closed(col("time_in_hospital"), *STAY_LENGTH_BINS)
    if "num_lab_procedures" in have:
        first["lab_intensity"] = cut_right_closed(col("num_lab_procedures"), *LAB_INTENSITY_BINS)
    diab = [f"{d}_is_diabetes" for d in DIAG_COLUMNS if f"{d}_is_diabetes" in have]
    if diab:
        first["primary_diabetes"] = col("diag_1_is_diabetes")
        if len(diab) >= 3:
            first["any_diabetes_diag"] = F.greatest(*[col(c) for c in diab])
    circ = [f"{d}_is_circulatory" for d in DIAG_COLUMNS if f"{d}_is_circulatory" in have]
    resp = [f"{d}_is_respiratory" for d in DIAG_COLUMNS if f"{d}_is_respiratory" in have]
    if circ:
        first["has_circulatory_disease"] = F.greatest(*[col(c) for c in circ]) if len(circ) > 1 else col(circ[0])
    if resp:
        first["has_respiratory_disease"] = F.greatest(*[col(c) for c in resp]) if len(resp) > 1 else col(resp[0])
    out = df.withColumns(first)
    second = {}
    if circ and resp:
        second["circulatory_respiratory_comorbidity"] = (
            (col("has_circulatory_disease") == 1) & (col("has_respiratory_disease") == 1)).cast("int")
    if "insulin_used" in have and "A1C_value" in have:
        second["insulin_with_high_A1C"] = F.coalesce(
            (col("insulin_used") == 1) & (col("A1C_value") >= 2), F.lit(False)).cast("int")
    dosage = [f"{m}_dosage" for m in MEDICATIONS if f"{m}_dosage" in have]
    if dosage:
        # a missing dosage counts as a change
        second["med_changes_count"] = F.expr(" + ".join(
            f"(CASE WHEN `{c}` IN (0, 1) THEN 0 ELSE 1 END)" for c in dosage))
    return out.withColumns(second) if second else out
