"""Schemas and fixed value lists of the encounter data model.

Everything in the "fixed values" blocks must equal the source definitions
for results to agree; they are stated plainly and in their natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: medication status columns, in source order -------------
MEDICATIONS = [
    "metformin", "repaglinide", "nateglinide", "chlorpropamide",
    "glimepiride", "acetohexamide", "glipizide", "glyburide",
    "tolbutamide", "pioglitazone", "rosiglitazone", "acarbose",
    "miglitol", "troglitazone", "tolazamide", "examide",
    "citoglipton", "insulin", "glyburide-metformin",
    "glipizide-metformin", "glimepiride-pioglitazone",
    "metformin-rosiglitazone", "metformin-pioglitazone",
]

# --- fixed values: expected raw columns (load-time check) -----------------
EXPECTED_COLUMNS = [
    "race", "gender", "age", "admission_type_id",
    "discharge_disposition_id", "admission_source_id",
    "time_in_hospital", "medical_specialty",
    "num_lab_procedures", "num_procedures",
    "num_medications", "number_outpatient",
    "number_emergency", "number_inpatient",
    "diag_1", "diag_2", "diag_3", "number_diagnoses",
    "max_glu_serum", "A1Cresult", *MEDICATIONS,
    "change", "diabetesMed", "readmitted",
]

# --- fixed values: numeric count columns coerced during cleaning ----------
NUMERIC_COLUMNS = [
    "time_in_hospital", "num_lab_procedures", "num_procedures",
    "num_medications", "number_outpatient", "number_emergency",
    "number_inpatient", "number_diagnoses",
]

DIAG_COLUMNS = ["diag_1", "diag_2", "diag_3"]
VISIT_COLUMNS = ["number_outpatient", "number_emergency", "number_inpatient"]

# id column -> decoded column (category name in the code dimension)
CODE_COLUMNS = {
    "admission_type_id": "admission_type",
    "discharge_disposition_id": "discharge_disposition",
    "admission_source_id": "admission_source",
}

# --- fixed values: model feature groups (order matters for the matrix) ----
CATEGORICAL_FEATURES = [
    "gender", "race", "age", "admission_type", "discharge_disposition",
    "admission_source", "medical_specialty", "diag_1_category",
    "diag_2_category", "diag_3_category", "A1Cresult", "max_glu_serum",
    "age_group", "diagnosis_complexity", "stay_length_cat", "lab_intensity",
]
NUMERIC_FEATURES = [
    "time_in_hospital", "num_lab_procedures", "num_procedures",
    "num_medications", "number_outpatient", "number_emergency",
    "number_inpatient", "number_diagnoses", "age_numeric",
    "total_visits", "total_meds_used", "med_diversity_ratio",
    "med_changes_count",
]
BINARY_FEATURES = [
    "diabetesMed", "change", "primary_diabetes", "any_diabetes_diag",
    "has_circulatory_disease", "has_respiratory_disease",
    "circulatory_respiratory_comorbidity", "insulin_with_high_A1C",
]
MED_USED_FEATURES = [f"{m}_used" for m in MEDICATIONS]

# --- fixed values: code dimension (id, description) per category ----------
# The text "NULL" is a missing description and is loaded as SQL NULL.
ADMISSION_TYPE_CODES = [
    (1, "Emergency"),
    (2, "Urgent"),
    (3, "Elective"),
    (4, "Newborn"),
    (5, "Not Available"),
    (6, "NULL"),
    (7, "Trauma Center"),
    (8, "Not Mapped"),
]
DISCHARGE_DISPOSITION_CODES = [
    (1, "Discharged to home"),
    (2, "Discharged/transferred to another short term hospital"),
    (3, "Discharged/transferred to SNF"),
    (4, "Discharged/transferred to ICF"),
    (5, "Discharged/transferred to another type of inpatient care institution"),
    (6, "Discharged/transferred to home with home health service"),
    (7, "Left AMA"),
    (8, "Discharged/transferred to home under care of Home IV provider"),
    (9, "Admitted as an inpatient to this hospital"),
    (10, "Neonate discharged to another hospital for neonatal aftercare"),
    (11, "Expired"),
    (12, "Still patient or expected to return for outpatient services"),
    (13, "Hospice / home"),
    (14, "Hospice / medical facility"),
    (15, "Discharged/transferred within this institution to Medicare approved swing bed"),
    (16, "Discharged/transferred/referred another institution for outpatient services"),
    (17, "Discharged/transferred/referred to this institution for outpatient services"),
    (18, "NULL"),
    (19, "Expired at home. Medicaid only, hospice."),
    (20, "Expired in a medical facility. Medicaid only, hospice."),
    (21, "Expired, place unknown. Medicaid only, hospice."),
    (22, "Discharged/transferred to another rehab fac including rehab units of a hospital."),
    (23, "Discharged/transferred to a long term care hospital."),
    (24, "Discharged/transferred to a nursing facility certified under Medicaid but not certified under Medicare."),
    (25, "Not Mapped"),
    (26, "Unknown/Invalid"),
    (30, "Discharged/transferred to another Type of Health Care Institution not Defined Elsewhere"),
    (27, "Discharged/transferred to a federal health care facility."),
    (28, "Discharged/transferred to a psychiatric hospital/unit of hospital"),
    (29, "Discharged/transferred to a Critical Access Hospital (CAH)."),
]
ADMISSION_SOURCE_CODES = [
    (1, "Physician Referral"),
    (2, "Clinic Referral"),
    (3, "HMO Referral"),
    (4, "Transfer from a hospital"),
    (5, "Transfer from a Skilled Nursing Facility (SNF)"),
    (6, "Transfer from another health care facility"),
    (7, "Emergency Room"),
    (8, "Court/Law Enforcement"),
    (9, "Not Available"),
    (10, "Transfer from critial access hospital"),
    (11, "Normal Delivery"),
    (12, "Premature Delivery"),
    (13, "Sick Baby"),
    (14, "Extramural Birth"),
    (15, "Not Available"),
    (17, "NULL"),
    (18, "Transfer From Another Home Health Agency"),
    (19, "Readmission to Same Home Health Agency"),
    (20, "Not Mapped"),
    (21, "Unknown/Invalid"),
    (22, "Transfer from hospital inpt/same fac reslt in a sep claim"),
    (23, "Born inside this hospital"),
    (24, "Born outside this hospital"),
    (25, "Transfer from Ambulatory Surgery Center"),
    (26, "Transfer from Hospice"),
]
CODE_LISTS = {
    "admission_type": ADMISSION_TYPE_CODES,
    "discharge_disposition": DISCHARGE_DISPOSITION_CODES,
    "admission_source": ADMISSION_SOURCE_CODES,
}

# --- fixed values: fallback lists used when a code file has no headers -----
FALLBACK_CODE_LISTS = {
    "admission_type": [(1, "Emergency"), (2, "Urgent"), (3, "Elective"), (4, "Newborn")],
    "discharge_disposition": [(1, "Discharged to home"),
                              (2, "Transferred to short term hospital"),
                              (11, "Expired")],
    "admission_source": [(1, "Physician Referral"), (7, "Emergency Room"),
                         (2, "Clinic Referral")],
}
# case-insensitive description substrings that identify a category
CATEGORY_MARKERS = {
    "admission_type": "admission type",
    "discharge_disposition": "discharge",
    "admission_source": "admission source",
}

CODE_SCHEMA = T.StructType([
    T.StructField("category", T.StringType()),
    T.StructField("id", T.IntegerType()),
    T.StructField("description", T.StringType()),
])


def encounter_schema() -> T.StructType:
    """Explicit schema of the raw encounter table (no inference)."""
    ints = {"admission_type_id", "discharge_disposition_id", "admission_source_id",
            *NUMERIC_COLUMNS}
    fields = [
        T.StructField("encounter_id", T.LongType(), False),
        T.StructField("patient_nbr", T.LongType()),
        T.StructField("encounter_date", T.DateType()),
    ]
    for c in EXPECTED_COLUMNS:
        fields.append(T.StructField(c, T.IntegerType() if c in ints else T.StringType()))
    return T.StructType(fields)
