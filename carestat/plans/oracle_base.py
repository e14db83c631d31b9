"""DuckDB SQL for the oracle side: encounter view, cleaned and featured tables.

Written independently of the Spark operators (plain window/self-join SQL,
CASE ladders) so that the two engines cross-check each other. Each oracle
query is ``WITH <ctes> SELECT ...`` over the pre-registered table views.
"""

from __future__ import annotations

from ..functions.columns import ICD9_CHAPTERS
from ..schema import CODE_LISTS, DIAG_COLUMNS, MEDICATIONS, NUMERIC_COLUMNS
from ..operators.clean import A1C_LEVEL, DOSAGE, GLUCOSE_LEVEL, READMIT_CLASS
from ..operators.features import (AGE_GROUP_BINS, AGE_MIDPOINT, DIAGNOSIS_COMPLEXITY_BINS,
                                  LAB_INTENSITY_BINS, STAY_LENGTH_BINS)
from ..sources.fixture import (A1C_BY_MOD12, CONSTANT_NO_MEDS, GLUCOSE_BY_MOD20, RACE_BY_SEGMENT,
                               SPECIALTY_BY_MOD9, STATUS_BY_REMAINDER)


def q(name: str) -> str:
    """Double-quoted identifier (hyphenated names)."""
    return '"' + name + '"'


def lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def case_map(expr: str, mapping: dict, default=None) -> str:
    whens = " ".join(f"WHEN {expr} = {lit(k)} THEN {lit(v)}" for k, v in mapping.items())
    return f"CASE {whens} ELSE {lit(default)} END"


def right_closed(expr: str, edges, labels) -> str:
    whens = " ".join(f"WHEN {expr} > {lo} AND {expr} <= {hi} THEN {lit(lab)}"
                     for lo, hi, lab in zip(edges[:-1], edges[1:], labels))
    return f"CASE {whens} END"


def _diag(d: str) -> str:
    return (f"CASE WHEN {d} IS NULL THEN '?' "
            f"WHEN {d} % 50 = 0 THEN 'V' || CAST({d} % 90 AS VARCHAR) "
            f"WHEN {d} % 37 = 0 THEN 'E' || CAST(800 + {d} % 200 AS VARCHAR) "
            f"WHEN {d} % 10 = 3 THEN '250.83' "
            f"ELSE CAST(1 + {d} % 1005 AS VARCHAR) END")


def _med(i: int, m: str) -> str:
    if m in CONSTANT_NO_MEDS:
        return "'No'"
    mod = 11 if (i < 9 or m == "insulin") else 97
    r = f"((o_orderkey * {7 + 2 * i} + o_custkey * {3 + i}) % {mod})"
    return case_map(r, STATUS_BY_REMAINDER, "No")


def encounters_cte() -> str:
    meds = ",\n      ".join(f"CAST({_med(i, m)} AS VARCHAR) AS {q(m)}" for i, m in enumerate(MEDICATIONS))
    return f"""
enc_lines AS (
  SELECT l_orderkey, CAST(SUM(l_quantity) AS BIGINT) AS qty, COUNT(*) AS n_lines,
         COUNT(DISTINCT l_partkey) AS n_parts, MIN(l_partkey) AS p_min,
         MAX(l_partkey) AS p_max, SUM(l_partkey) AS p_sum
  FROM lineitem GROUP BY l_orderkey),
enc_orders AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
         CAST(o_orderdate AS DATE) AS d,
         LEAD(CAST(o_orderdate AS DATE)) OVER (
           PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey) AS nd
  FROM orders),
enc_hist AS (
  SELECT a.o_orderkey,
         COUNT(b.o_orderkey) FILTER (WHERE b.o_orderstatus = 'O') AS n_out,
         COUNT(b.o_orderkey) FILTER (WHERE b.o_orderstatus = 'P') AS n_emg,
         COUNT(b.o_orderkey) FILTER (WHERE b.o_orderstatus = 'F') AS n_inp
  FROM enc_orders a LEFT JOIN enc_orders b
    ON a.o_custkey = b.o_custkey AND b.d >= a.d - 365 AND b.d < a.d
  GROUP BY a.o_orderkey),
enc_base AS (
  SELECT o.*, c.c_nationkey, c.c_mktsegment, h.n_out, h.n_emg, h.n_inp,
         COALESCE(li.qty, 0) AS qty, COALESCE(li.n_lines, 0) AS n_lines,
         COALESCE(li.n_parts, 0) AS n_parts, li.p_min AS d1,
         CASE WHEN COALESCE(li.n_parts, 0) >= 2 THEN li.p_max END AS d2,
         CASE WHEN COALESCE(li.n_parts, 0) >= 3 THEN CAST(li.p_sum AS BIGINT) END AS d3
  FROM enc_orders o
  JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN enc_hist h ON h.o_orderkey = o.o_orderkey
  LEFT JOIN enc_lines li ON li.l_orderkey = o.o_orderkey),
enc AS (
  SELECT CAST(o_orderkey AS BIGINT) AS encounter_id, CAST(o_custkey AS BIGINT) AS patient_nbr,
      d AS encounter_date,
      {case_map('c_mktsegment', RACE_BY_SEGMENT, '?')} AS race,
      CASE WHEN o_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
      '[' || CAST(o_custkey % 10 * 10 AS VARCHAR) || '-' || CAST(o_custkey % 10 * 10 + 10 AS VARCHAR) || ')' AS age,
      CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS admission_type_id,
      CAST(c_nationkey + 1 AS INTEGER) AS discharge_disposition_id,
      CAST(o_orderkey % 26 + 1 AS INTEGER) AS admission_source_id,
      CAST(CAST(floor(o_totalprice) AS BIGINT) % 14 + 1 AS INTEGER) AS time_in_hospital,
      {case_map('o_orderkey % 9', SPECIALTY_BY_MOD9, '?')} AS medical_specialty,
      CAST(qty % 132 + 1 AS INTEGER) AS num_lab_procedures,
      CAST(n_lines % 7 AS INTEGER) AS num_procedures,
      CAST(n_parts + 1 + o_orderkey % 40 AS INTEGER) AS num_medications,
      CAST(n_out AS INTEGER) AS number_outpatient,
      CAST(n_emg AS INTEGER) AS number_emergency,
      CAST(n_inp AS INTEGER) AS number_inpatient,
      {_diag('d1')} AS diag_1, {_diag('d2')} AS diag_2, {_diag('d3')} AS diag_3,
      CAST((n_parts + o_custkey) % 16 + 1 AS INTEGER) AS number_diagnoses,
      {case_map('o_orderkey % 20', GLUCOSE_BY_MOD20, 'None')} AS max_glu_serum,
      {case_map('o_orderkey % 12', A1C_BY_MOD12, 'None')} AS "A1Cresult",
      {meds},
      CASE WHEN o_orderkey % 2 = 0 THEN 'Ch' ELSE 'No' END AS change,
      CASE WHEN o_orderkey % 4 = 0 THEN 'No' ELSE 'Yes' END AS "diabetesMed",
      CASE WHEN nd IS NULL THEN 'NO'
           WHEN nd - d < 30 THEN '<30'
           WHEN nd - d <= 365 THEN '>30'
           ELSE 'NO' END AS readmitted
  FROM enc_base)"""


RAW_STRING_COLUMNS = (["race", "gender", "age", "medical_specialty", *DIAG_COLUMNS,
                       "max_glu_serum", "A1Cresult", *MEDICATIONS, "change",
                       "diabetesMed", "readmitted"])
RAW_INT_COLUMNS = ["admission_type_id", "discharge_disposition_id", "admission_source_id",
                   *NUMERIC_COLUMNS]


def codes_cte() -> str:
    rows = []
    for cat, lst in CODE_LISTS.items():
        for i, d in lst:
            rows.append(f"({lit(cat)}, {i}, {lit(None if d == 'NULL' else d)})")
    return "codes(category, id, description) AS (VALUES " + ", ".join(rows) + ")"


NUM_RE = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
NONFINITE_RE = r"(?i)^[+-]?(nan|inf|infinity)$"


def chapter_sql(d: str) -> str:
    s = f"regexp_replace({d}, '^\\s+|\\s+$', '', 'g')"
    num = f"TRY_CAST(CASE WHEN regexp_matches({s}, '{NUM_RE}') THEN {s} END AS DOUBLE)"
    ranges = " ".join(f"WHEN {num} >= {lo} AND {num} < {hi} THEN '{name}'"
                      for lo, hi, name in ICD9_CHAPTERS)
    return (f"CASE WHEN {d} IS NULL OR {d} = '?' THEN 'Unknown' "
            f"WHEN starts_with({s}, 'V') THEN 'V_codes' "
            f"WHEN starts_with({s}, 'E') THEN 'E_codes' "
            f"WHEN regexp_matches({s}, '{NONFINITE_RE}') THEN 'Other' "
            f"WHEN {num} IS NULL THEN 'Unknown' {ranges} ELSE 'Other' END")


def clean_cte() -> str:
    """C1-C13 over ``enc`` -> ``cln`` (same column order as the Spark step)."""
    base_cols = ["encounter_id", "patient_nbr", "encounter_date"]
    sel = [f"e.{c}" for c in base_cols]
    for c in RAW_STRING_COLUMNS[:0]:
        pass
    order = ["race", "gender", "age", "time_in_hospital", "medical_specialty",
             "num_lab_procedures", "num_procedures", "num_medications",
             "number_outpatient", "number_emergency", "number_inpatient",
             *DIAG_COLUMNS, "number_diagnoses", "max_glu_serum", "A1Cresult",
             *MEDICATIONS, "change", "diabetesMed", "readmitted"]
    for c in order:
        if c in RAW_STRING_COLUMNS:
            sel.append(f"NULLIF(e.{q(c)}, '?') AS {q(c)}")
        else:
            sel.append(f"e.{q(c)}")
    sel += ["c_at.description AS admission_type", "dd.description AS discharge_disposition",
            "src.description AS admission_source"]
    stage1 = (f"cln0 AS (SELECT {', '.join(sel)} FROM enc e "
              f"LEFT JOIN codes c_at ON c_at.category = 'admission_type' AND c_at.id = e.admission_type_id "
              f"LEFT JOIN codes dd ON dd.category = 'discharge_disposition' AND dd.id = e.discharge_disposition_id "
              f"LEFT JOIN codes src ON src.category = 'admission_source' AND src.id = e.admission_source_id)")
    new = []
    for m in MEDICATIONS:
        new.append(f"CASE WHEN {q(m)} = 'No' THEN 0 ELSE 1 END AS {q(m + '_used')}")
        new.append(f"{case_map(q(m), DOSAGE)} AS {q(m + '_dosage')}")
    for d in DIAG_COLUMNS:
        ch = chapter_sql(d)
        new.append(f"{ch} AS {d}_category")
        new.append(f"CAST(COALESCE(starts_with({d}, '250'), false) AS INTEGER) AS {d}_is_diabetes")
        new.append(f"CAST(({ch}) = 'Circulatory' AS INTEGER) AS {d}_is_circulatory")
        new.append(f"CAST(({ch}) = 'Respiratory' AS INTEGER) AS {d}_is_respiratory")
    new.append(f"{case_map(q('A1Cresult'), A1C_LEVEL)} AS \"A1C_value\"")
    new.append(f"{case_map('max_glu_serum', GLUCOSE_LEVEL)} AS glucose_value")
    new.append("CASE WHEN readmitted = '<30' THEN 1 ELSE 0 END AS readmitted_30d")
    new.append(f"{case_map('readmitted', READMIT_CLASS)} AS readmitted_class")
    stage2 = f"cln AS (SELECT *, {', '.join(new)} FROM cln0)"
    return f"{codes_cte()},\n{stage1},\n{stage2}"


def features_cte() -> str:
    age_num = f"COALESCE({case_map('age', AGE_MIDPOINT)}, 50)"
    used = " + ".join(q(m + "_used") for m in MEDICATIONS)
    changes = " + ".join(
        f"CASE WHEN {q(m + '_dosage')} IN (0, 1) THEN 0 ELSE 1 END" for m in MEDICATIONS)
    circ = "GREATEST(diag_1_is_circulatory, diag_2_is_circulatory, diag_3_is_circulatory)"
    resp = "GREATEST(diag_1_is_respiratory, diag_2_is_respiratory, diag_3_is_respiratory)"
    return f"""fea AS (SELECT *,
    {age_num} AS age_numeric,
    {right_closed(age_num, *AGE_GROUP_BINS)} AS age_group,
    COALESCE(number_outpatient, 0) + COALESCE(number_emergency, 0) + COALESCE(number_inpatient, 0) AS total_visits,
    {used} AS total_meds_used,
    ({used}) / {float(len(MEDICATIONS))} AS med_diversity_ratio,
    {right_closed('number_diagnoses', *DIAGNOSIS_COMPLEXITY_BINS)} AS diagnosis_complexity,
    {right_closed('time_in_hospital', *STAY_LENGTH_BINS)} AS stay_length_cat,
    {right_closed('num_lab_procedures', *LAB_INTENSITY_BINS)} AS lab_intensity,
    diag_1_is_diabetes AS primary_diabetes,
    GREATEST(diag_1_is_diabetes, diag_2_is_diabetes, diag_3_is_diabetes) AS any_diabetes_diag,
    {circ} AS has_circulatory_disease,
    {resp} AS has_respiratory_disease,
    CAST({circ} = 1 AND {resp} = 1 AS INTEGER) AS circulatory_respiratory_comorbidity,
    CAST(COALESCE(insulin_used = 1 AND "A1C_value" >= 2, false) AS INTEGER) AS "insulin_with_high_A1C",
    {changes} AS med_changes_count
  FROM cln)"""


def with_tables(select: str, level: str = "fea", extra: list[str] | None = None) -> str:
    """``WITH`` the encounter CTEs up to ``level`` (enc / cln / fea), then ``select``."""
    ctes = [encounters_cte().strip()]
    if level in ("cln", "fea"):
        ctes.append(clean_cte())
    if level == "fea":
        ctes.append(features_cte())
    ctes += extra or []
    return "WITH " + ",\n".join(ctes) + "\n" + select
