"""DuckDB oracle SQL per registered query (same names, same column aliases)."""

from __future__ import annotations

from ..operators import profile as P
from ..schema import DIAG_COLUMNS, MEDICATIONS, NUMERIC_COLUMNS
from .catalog import CLINICAL_NUMERIC, FEATURE_COLUMNS
from .oracle_base import lit, q, with_tables
from .oracle_base import RAW_STRING_COLUMNS

ORACLE: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    ORACLE[name] = sql


def _cols(cols) -> str:
    return ", ".join(q(c) for c in cols)


ENC1 = ("enc1 AS (SELECT " + ", ".join(
    [f"NULLIF({q(c)}, '?') AS {q(c)}" if c in RAW_STRING_COLUMNS else q(c)
     for c in ["encounter_id", "patient_nbr", "encounter_date", "race", "gender", "age",
               "admission_type_id", "discharge_disposition_id", "admission_source_id",
               "time_in_hospital", "medical_specialty", "num_lab_procedures", "num_procedures",
               "num_medications", "number_outpatient", "number_emergency", "number_inpatient",
               *DIAG_COLUMNS, "number_diagnoses", "max_glu_serum", "A1Cresult", *MEDICATIONS,
               "change", "diabetesMed", "readmitted"]]) + " FROM enc)")
RAW_COLUMN_ORDER = ["encounter_id", "patient_nbr", "encounter_date", "race", "gender", "age",
                    "admission_type_id", "discharge_disposition_id", "admission_source_id",
                    "time_in_hospital", "medical_specialty", "num_lab_procedures",
                    "num_procedures", "num_medications", "number_outpatient",
                    "number_emergency", "number_inpatient", *DIAG_COLUMNS, "number_diagnoses",
                    "max_glu_serum", "A1Cresult", *MEDICATIONS, "change", "diabetesMed",
                    "readmitted"]
CLX = ("clx AS (SELECT cln.*, enc.admission_type_id, enc.discharge_disposition_id, "
       "enc.admission_source_id FROM cln JOIN enc USING (encounter_id))")


def _rate_union(src: str, cols, *, scale: float = 1.0, rate: str = "readmission_rate_30d") -> str:
    parts = [f"SELECT '{c}' AS variable, CAST({q(c)} AS VARCHAR) AS category, "
             f"ROUND(AVG(readmitted_30d) * {scale}, 6) AS {rate}, COUNT(*) AS count "
             f"FROM {src} WHERE {q(c)} IS NOT NULL GROUP BY {q(c)}" for c in cols]
    return "\nUNION ALL ".join(parts)


def _corr(x: str, y: str) -> str:
    mx = f"CASE WHEN {y} IS NOT NULL THEN CAST({x} AS DOUBLE) END"
    my = f"CASE WHEN {x} IS NOT NULL THEN CAST({y} AS DOUBLE) END"
    return (f"ROUND(COVAR_POP({mx}, {my}) / NULLIF(SQRT(VAR_POP({mx}) * VAR_POP({my})), 0), 6)")


def _corr_union(src: str, cols, target: str = "readmitted_30d") -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS feature, {_corr(q(c), target)} AS correlation FROM {src}" for c in cols)


# ------------------------------------------------------------- sources ----
oracle("s1_encounter_view", with_tables("SELECT * FROM enc", "enc"))
oracle("s7_target_distribution", with_tables(
    "SELECT readmitted AS value, COUNT(*) AS count, "
    "ROUND(COUNT(*) / SUM(COUNT(*)) OVER (), 6) AS share "
    "FROM enc1 WHERE readmitted IS NOT NULL GROUP BY readmitted", "enc", [ENC1]))

# ------------------------------------------------------------- cleaning ---
oracle("c1_sentinel_nulls", with_tables(
    f"SELECT {_cols(['encounter_id', 'race', 'medical_specialty', *DIAG_COLUMNS])} FROM cln", "cln"))
oracle("c2_decoded_codes", with_tables(
    "SELECT encounter_id, admission_type, discharge_disposition, admission_source FROM cln", "cln"))
oracle("c3_numeric_columns", with_tables(
    f"SELECT {_cols(['encounter_id', *NUMERIC_COLUMNS])} FROM cln", "cln"))
oracle("c4_c5_medication_flags", with_tables(
    "SELECT " + _cols(["encounter_id"] + [c for m in MEDICATIONS
                                          for c in (f"{m}_used", f"{m}_dosage")]) + " FROM cln", "cln"))
oracle("c6_c8_diagnosis_columns", with_tables(
    "SELECT " + _cols(["encounter_id"] + [f"{d}_{s}" for d in DIAG_COLUMNS for s in (
        "category", "is_diabetes", "is_circulatory", "is_respiratory")]) + " FROM cln", "cln"))
oracle("c9_c12_lab_and_targets", with_tables(
    'SELECT encounter_id, "A1C_value", glucose_value, readmitted_30d, readmitted_class FROM cln',
    "cln"))
oracle("c13_cleaned_table", with_tables("SELECT * FROM cln", "cln"))

# ------------------------------------------------------------- features ---
oracle("f1_f14_features", with_tables(
    f"SELECT {_cols(['encounter_id', *FEATURE_COLUMNS])} FROM fea", "fea"))

# ------------------------------------------------------------- profiling --
oracle("p1_shape", with_tables(
    f"SELECT COUNT(*) AS n_rows, CAST({len(RAW_COLUMN_ORDER)} AS BIGINT) AS n_columns FROM enc",
    "enc"))

_miss = ", ".join(f"COUNT(*) FILTER (WHERE {q(c)} IS NULL) AS {q(c)}" for c in RAW_COLUMN_ORDER)
oracle("p2_missing_profile", with_tables(
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({q(c)} AS BIGINT) AS missing_count, "
        f"ROUND({q(c)} * 100.0 / n, 6) AS missing_pct FROM m WHERE {q(c)} > 0"
        for c in RAW_COLUMN_ORDER),
    "enc", [ENC1, f"m AS (SELECT COUNT(*) AS n, {_miss} FROM enc1)"]))


def _dist(c: str) -> str:
    return (f"SELECT CAST({q(c)} AS VARCHAR) AS value, COUNT(*) AS count, "
            f"ROUND(COUNT(*) / SUM(COUNT(*)) OVER (), 6) AS share "
            f"FROM enc1 WHERE {q(c)} IS NOT NULL GROUP BY {q(c)}")


oracle("p3_race_distribution", with_tables(_dist("race"), "enc", [ENC1]))
oracle("p4_age_distribution", with_tables(_dist("age"), "enc", [ENC1]))
oracle("p5_rate_by_age", with_tables(
    "SELECT age, ROUND(AVG(readmitted_30d), 6) AS readmission_rate_30d, COUNT(*) AS count "
    "FROM clx WHERE age IS NOT NULL GROUP BY age", "cln", [CLX]))
oracle("p5_rates_by_category", with_tables(_rate_union("clx", P.RATE_COLUMNS), "cln", [CLX]))
oracle("p5_rate_by_diagnosis_join", with_tables(
    "SELECT r.diag_1_category, r.readmission_rate_30d, c.count FROM "
    "(SELECT diag_1_category, ROUND(AVG(readmitted_30d), 6) AS readmission_rate_30d FROM cln "
    " WHERE diag_1_category IS NOT NULL GROUP BY diag_1_category) r "
    "JOIN (SELECT diag_1_category, COUNT(*) AS count FROM cln WHERE diag_1_category IS NOT NULL "
    " GROUP BY diag_1_category) c ON r.diag_1_category = c.diag_1_category", "cln"))
oracle("p6_rate_pct_by_group", with_tables(_rate_union(
    "fea", [*P.DEMOGRAPHIC_COLUMNS, *P.CLINICAL_CATEGORICAL_COLUMNS, *MEDICATIONS],
    scale=100.0, rate="readmission_rate"), "fea"))

_p7_cols = [*P.DEMOGRAPHIC_COLUMNS, *P.CLINICAL_CATEGORICAL_COLUMNS]
oracle("p7_extreme_groups", with_tables(
    "SELECT variable, "
    "MAX(CASE WHEN hi = 1 THEN category END) AS highest_category, "
    "MAX(CASE WHEN hi = 1 THEN rate END) AS highest_rate, "
    "MAX(CASE WHEN lo = 1 THEN category END) AS lowest_category, "
    "MAX(CASE WHEN lo = 1 THEN rate END) AS lowest_rate, "
    "ROUND(MAX(CASE WHEN hi = 1 THEN rate END) / NULLIF(MAX(CASE WHEN lo = 1 THEN rate END), 0), 6)"
    " AS rate_ratio, "
    "(SELECT ROUND(AVG(readmitted_30d) * 100.0, 6) FROM fea) AS overall_rate "
    "FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY variable ORDER BY rate DESC, category) AS hi, "
    "ROW_NUMBER() OVER (PARTITION BY variable ORDER BY rate ASC, category) AS lo FROM rates) t "
    "GROUP BY variable", "fea",
    [f"rates AS ({_rate_union('fea', _p7_cols, scale=100.0, rate='rate')})"]))


def _bin_case(v: str, edges) -> str:
    whens = []
    for i, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
        cond = f"{q(v)} >= {lo}" + ("" if hi == float("inf") else f" AND {q(v)} < {hi}")
        whens.append(f"WHEN {cond} THEN {i}")
    return "CASE " + " ".join(whens) + " END"


_bins_values = ", ".join(f"({lit(v)}, {i}, {lit(lab)})" for v, _, labels in P.CLINICAL_BINS
                         for i, lab in enumerate(labels))
_bins_agg = "\nUNION ALL ".join(
    f"SELECT '{v}' AS variable, {_bin_case(v, edges)} AS bin_order, "
    f"ROUND(AVG(readmitted_30d) * 100.0, 6) AS readmission_rate, COUNT(*) AS n "
    f"FROM fea WHERE ({_bin_case(v, edges)}) IS NOT NULL GROUP BY 2"
    for v, edges, _ in P.CLINICAL_BINS)
oracle("p8_binned_rates", with_tables(
    "SELECT d.variable, d.bin_order, d.bin, a.readmission_rate, "
    "CAST(COALESCE(a.n, 0) AS BIGINT) AS count FROM bins d "
    "LEFT JOIN agg a ON a.variable = d.variable AND a.bin_order = d.bin_order", "fea",
    [f"bins(variable, bin_order, bin) AS (VALUES {_bins_values})", f"agg AS ({_bins_agg})"]))

oracle("p9_numeric_correlations", with_tables(
    _corr_union("fea", [*NUMERIC_COLUMNS, "readmitted_30d"]), "fea"))
oracle("p10_medication_correlations", with_tables(
    _corr_union("fea", [f"{m}_used" for m in MEDICATIONS]), "fea"))
oracle("p11_correlation_trend", with_tables(
    "SELECT feature, correlation, CASE WHEN correlation > 0.05 THEN 'Positive' "
    "WHEN correlation < -0.05 THEN 'Negative' ELSE 'No strong correlation' END AS trend "
    f"FROM ({_corr_union('fea', CLINICAL_NUMERIC)}) t", "fea"))
oracle("p12_medication_usage", with_tables("\nUNION ALL ".join(
    f"SELECT '{m}' AS medication, ROUND(COUNT(*) FILTER (WHERE {q(m)} IN ('Steady', 'Up', 'Down'))"
    f" * 1.0 / COUNT(*) * 100.0, 6) AS usage_pct FROM fea" for m in MEDICATIONS), "fea"))
oracle("p13_medication_rate_difference", with_tables(
    "SELECT variable AS medication, MAX(CASE WHEN category = 'No' THEN rate END) AS no_rate, "
    "ROUND(AVG(CASE WHEN category <> 'No' THEN rate END), 6) AS used_rate, "
    "ROUND(AVG(CASE WHEN category <> 'No' THEN rate END) - MAX(CASE WHEN category = 'No' THEN rate END), 6)"
    " AS rate_diff, "
    "CASE WHEN AVG(CASE WHEN category <> 'No' THEN rate END) - MAX(CASE WHEN category = 'No' THEN rate END) > 0"
    " THEN 'positive' WHEN AVG(CASE WHEN category <> 'No' THEN rate END) - "
    "MAX(CASE WHEN category = 'No' THEN rate END) IS NOT NULL THEN 'negative' END AS direction "
    "FROM rates GROUP BY variable", "fea",
    [f"rates AS ({_rate_union('fea', MEDICATIONS, scale=100.0, rate='rate')})"]))

_box_long = "\nUNION ALL ".join(
    f"SELECT '{c}' AS variable, readmitted AS \"group\", CAST({q(c)} AS DOUBLE) AS x FROM fea "
    f"WHERE {q(c)} IS NOT NULL AND readmitted IS NOT NULL" for c in P.BOX_COLUMNS)
oracle("p14_box_summary", with_tables(
    "SELECT s.variable, s.\"group\", CAST(s.n AS BIGINT) AS n, ROUND(s.q1, 6) AS q1, "
    "ROUND(s.median, 6) AS median, ROUND(s.q3, 6) AS q3, "
    "ROUND(MIN(CASE WHEN l.x >= s.q1 - 1.5 * (s.q3 - s.q1) AND l.x <= s.q3 + 1.5 * (s.q3 - s.q1) THEN l.x END), 6) AS whisker_low, "
    "ROUND(MAX(CASE WHEN l.x >= s.q1 - 1.5 * (s.q3 - s.q1) AND l.x <= s.q3 + 1.5 * (s.q3 - s.q1) THEN l.x END), 6) AS whisker_high, "
    "CAST(COUNT(*) FILTER (WHERE NOT (l.x >= s.q1 - 1.5 * (s.q3 - s.q1) AND l.x <= s.q3 + 1.5 * (s.q3 - s.q1))) AS BIGINT) AS n_outliers "
    "FROM stats s JOIN long l ON l.variable = s.variable AND l.\"group\" = s.\"group\" "
    "GROUP BY s.variable, s.\"group\", s.n, s.q1, s.median, s.q3", "fea",
    [f"long AS ({_box_long})",
     "stats AS (SELECT variable, \"group\", COUNT(*) AS n, QUANTILE_CONT(x, 0.25) AS q1, "
     "QUANTILE_CONT(x, 0.5) AS median, QUANTILE_CONT(x, 0.75) AS q3 FROM long "
     "GROUP BY variable, \"group\")"]))


def _top(src: str, value: str, key: str, k: int, readout: str) -> str:
    return (f"SELECT '{readout}' AS readout, rank, CAST({key} AS VARCHAR) AS key, "
            f"CAST({value} AS DOUBLE) AS value FROM (SELECT *, ROW_NUMBER() OVER "
            f"(ORDER BY {value} DESC NULLS LAST, {key}) AS rank FROM ({src}) s) t WHERE rank <= {k}")


_age_rates = ("SELECT age, ROUND(AVG(readmitted_30d), 6) AS readmission_rate_30d FROM fea "
              "WHERE age IS NOT NULL GROUP BY age")
_diag_rates = ("SELECT diag_1_category, ROUND(AVG(readmitted_30d), 6) AS readmission_rate_30d "
               "FROM fea WHERE diag_1_category IS NOT NULL GROUP BY diag_1_category")
oracle("p15_top_readouts", with_tables(
    "\nUNION ALL ".join([
        _top(_corr_union("fea", NUMERIC_COLUMNS), "correlation", "feature", 5, "numeric_correlation"),
        _top(_corr_union("fea", [f"{m}_used" for m in MEDICATIONS]), "correlation", "feature", 5,
             "medication_correlation"),
        _top(_age_rates, "readmission_rate_30d", "age", 3, "age_rate"),
        _top(_diag_rates, "readmission_rate_30d", "diag_1_category", 3, "diagnosis_rate"),
    ]), "fea"))
oracle("p16_pick_lists", with_tables(
    "SELECT DISTINCT 'age' AS variable, age AS value FROM fea WHERE age IS NOT NULL "
    "UNION ALL SELECT DISTINCT 'gender' AS variable, gender AS value FROM fea WHERE gender IS NOT NULL",
    "fea"))

_bands = {
    "stay_gt7": "time_in_hospital > 7", "stay_lt3": "time_in_hospital < 3",
    "meds_gt15": "num_medications > 15", "meds_lt5": "num_medications < 5",
    "dx_8plus": "number_diagnoses >= 8", "dx_1to2": "number_diagnoses BETWEEN 1 AND 2",
    "age_70to80": "age = '[70-80)'",
    "age_lt40": "age IN ('[0-10)', '[10-20)', '[20-30)', '[30-40)')",
}
oracle("p18_band_rates", with_tables("\nUNION ALL ".join(
    f"SELECT '{b}' AS band, CAST(COUNT(*) FILTER (WHERE {c}) AS BIGINT) AS count, "
    f"ROUND(SUM(CASE WHEN {c} THEN readmitted_30d END) * 100.0 / "
    f"NULLIF(COUNT(*) FILTER (WHERE {c}), 0), 6) AS readmission_rate FROM fea"
    for b, c in _bands.items()), "fea"))
oracle("p19_comorbidity_lift", with_tables(
    "SELECT CAST(COUNT(*) FILTER (WHERE circulatory_respiratory_comorbidity = 1) AS BIGINT) AS n_comorbid, "
    "ROUND(AVG(CASE WHEN circulatory_respiratory_comorbidity = 1 THEN readmitted_30d END), 6) AS comorbid_rate, "
    "ROUND(AVG(readmitted_30d), 6) AS overall_rate, "
    "ROUND(AVG(CASE WHEN circulatory_respiratory_comorbidity = 1 THEN readmitted_30d END) / "
    "NULLIF(AVG(readmitted_30d), 0) - 1.0, 6) AS lift FROM fea", "fea"))

from . import oracle_eval  # noqa: E402,F401  (registers the evaluation oracles)
from . import oracle_model  # noqa: E402,F401
