"""DuckDB oracle SQL for the split-dependent queries."""

from __future__ import annotations

from .oracle import oracle
from .oracle_base import with_tables

SPLIT = (
    "sp0 AS (SELECT encounter_id, readmitted_30d, md5('42-' || CAST(encounter_id AS VARCHAR)) AS h FROM fea), "
    "cnt AS (SELECT readmitted_30d AS c, COUNT(*) AS n_c FROM sp0 GROUP BY 1), "
    "tot AS (SELECT SUM(n_c) AS n, CAST(CEIL(CAST(0.2 AS DOUBLE) * SUM(n_c)) AS BIGINT) AS n_test FROM cnt), "
    "tq0 AS (SELECT c, n_c, n - n_test AS n_train, n_c * (n - n_test) / CAST(n AS DOUBLE) AS cont, "
    "FLOOR(n_c * (n - n_test) / CAST(n AS DOUBLE)) AS fl FROM cnt, tot), "
    "tq1 AS (SELECT *, ROW_NUMBER() OVER (ORDER BY cont - fl DESC, c) AS rr, "
    "n_train - SUM(fl) OVER () AS need FROM tq0), "
    "quota AS (SELECT c, n_c - (fl + CASE WHEN rr <= need THEN 1 ELSE 0 END) AS q FROM tq1), "
    "ranked AS (SELECT sp0.*, ROW_NUMBER() OVER (PARTITION BY readmitted_30d ORDER BY h, encounter_id) AS rn FROM sp0), "
    "split AS (SELECT encounter_id, readmitted_30d, CASE WHEN rn <= q THEN 'test' ELSE 'train' END AS split "
    "FROM ranked JOIN quota ON quota.c = ranked.readmitted_30d)")

oracle("m3_stratified_split", with_tables("SELECT * FROM split", "fea", [SPLIT]))
oracle("p17_class_counts", with_tables(
    "SELECT split, readmitted_30d AS label, COUNT(*) AS count FROM split GROUP BY 1, 2", "fea", [SPLIT]))
oracle("t1_class_weights", with_tables(
    "SELECT label, n_c, ROUND(SUM(n_c) OVER () / (2.0 * n_c), 6) AS balanced_weight, "
    "ROUND(CAST(MAX(CASE WHEN label = 0 THEN n_c END) OVER () AS DOUBLE) / "
    "MAX(CASE WHEN label = 1 THEN n_c END) OVER (), 6) AS neg_pos_ratio "
    "FROM (SELECT readmitted_30d AS label, COUNT(*) AS n_c FROM split WHERE split = 'train' GROUP BY 1) t",
    "fea", [SPLIT]))

# Vector slot names -- numeric features, then each categorical column's
# distinct training values in sorted order, then the passthrough flags.
from ..schema import BINARY_FEATURES, CATEGORICAL_FEATURES, MED_USED_FEATURES, NUMERIC_FEATURES  # noqa: E402
from .oracle_base import lit, q  # noqa: E402

TRAIN = "tr AS (SELECT fea.* FROM fea JOIN split USING (encounter_id) WHERE split.split = 'train')"
_TEXT_BINARY = ["diabetesMed", "change"]
_CATS = CATEGORICAL_FEATURES + _TEXT_BINARY
_PASS = [c for c in BINARY_FEATURES if c not in _TEXT_BINARY] + MED_USED_FEATURES
_cat_rows = "\nUNION ALL ".join(
    f"SELECT {g} AS g, {lit(c)} AS c, CAST({q(c)} AS VARCHAR) AS v FROM tr WHERE {q(c)} IS NOT NULL GROUP BY {q(c)}"
    for g, c in enumerate(_CATS))
_num_values = ", ".join(f"({i}, {lit(c)})" for i, c in enumerate(NUMERIC_FEATURES))
_pass_values = ", ".join(f"({i}, {lit(c)})" for i, c in enumerate(_PASS))
oracle("m10_feature_names", with_tables(
    "SELECT CAST(idx AS INTEGER) AS idx, feature FROM ("
    "SELECT i AS idx, name AS feature FROM nums "
    f"UNION ALL SELECT {len(NUMERIC_FEATURES)} + ROW_NUMBER() OVER (ORDER BY g, v) - 1, c || '_' || v FROM cats "
    f"UNION ALL SELECT {len(NUMERIC_FEATURES)} + (SELECT COUNT(*) FROM cats) + i, name FROM pass) t",
    "fea", [SPLIT, TRAIN,
            f"cats AS ({_cat_rows})",
            f"nums(i, name) AS (VALUES {_num_values})",
            f"pass(i, name) AS (VALUES {_pass_values})"]))

# M4, M5: train median; mean and population std of the imputed column.
# M6: most frequent training value, ties to the smallest text.
oracle("m4_m5_numeric_statistics", with_tables("\nUNION ALL ".join(
    f"SELECT {lit(c)} AS feature, ROUND(ANY_VALUE(m), 6) AS median, ROUND(AVG(COALESCE(x, m)), 6) AS mean, "
    "ROUND(STDDEV_POP(COALESCE(x, m)), 6) AS std "
    f"FROM (SELECT CAST({q(c)} AS DOUBLE) AS x, "
    f"COALESCE((SELECT MEDIAN(CAST({q(c)} AS DOUBLE)) FROM tr), 0.0) AS m FROM tr) t"
    for c in NUMERIC_FEATURES), "fea", [SPLIT, TRAIN]))
oracle("m6_categorical_modes", with_tables("\nUNION ALL ".join(
    f"SELECT {lit(c)} AS feature, COALESCE((SELECT CAST({q(c)} AS VARCHAR) FROM tr WHERE {q(c)} IS NOT NULL "
    f"GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1), '') AS mode"
    for c in _CATS), "fea", [SPLIT, TRAIN]))


# ------------------------------------------------ files and saved models ---
from ..operators.prepare import NUMBER_TEXT  # noqa: E402
from ..operators.train import MODEL_ORDER  # noqa: E402
from ..schema import CATEGORY_MARKERS, FALLBACK_CODE_LISTS  # noqa: E402
from .catalog import M11_TEXTS  # noqa: E402

oracle("s1_s8_csv_encounters", with_tables("SELECT * FROM enc", "enc"))
oracle("s1_malformed_lines", with_tables(
    "SELECT CAST(encounter_id AS VARCHAR) || ',' || CAST(patient_nbr AS VARCHAR) || ',' || race AS line, CAST(3 AS INTEGER) AS fields "
    "FROM enc WHERE encounter_id % 7 = 0", "enc"))
oracle("s8_table_round_trip", with_tables(
    "SELECT encounter_id, readmitted, readmitted_30d, time_in_hospital, race FROM cln", "cln"))
oracle("s6_missing_columns", "SELECT * FROM (VALUES ('race'), ('insulin'), ('readmitted')) t(missing_column)")
_NATIONS = "nation JOIN region ON n_regionkey = r_regionkey"
oracle("s2_s4_codes_with_category",
       "SELECT r_name AS category, CAST(n_nationkey AS INTEGER) AS id, CASE WHEN n_nationkey % 4 <> 0 THEN n_name END AS description "
       f"FROM {_NATIONS} WHERE n_nationkey % 6 <> 5")
_marks = list(CATEGORY_MARKERS.items())
oracle("s2_s4_codes_by_description", "\nUNION ALL ".join(
    f"SELECT {lit(cat)} AS category, CAST(n_nationkey AS INTEGER) AS id, {lit(mark.title())} || ' ' || n_name AS description "
    f"FROM nation WHERE n_nationkey % 4 = {i}" for i, (cat, mark) in enumerate(_marks)))
oracle("s2_s5_codes_fallback", "SELECT * FROM (VALUES " + ", ".join(
    f"({i}, {lit(d)})" for i, d in FALLBACK_CODE_LISTS["discharge_disposition"]) + ") t(id, description)")

# Text columns of numbers (everywhere, in the training rows only) and of codes
_TEXTS = ("tx AS (SELECT split.split AS split, ' ' || CAST(time_in_hospital AS VARCHAR) || '.50 ' AS stay_text, "
          "CASE WHEN split.split = 'test' AND num_lab_procedures > 60 THEN 'many' ELSE CAST(num_lab_procedures AS VARCHAR) END AS lab_text, "
          "diag_1, diag_2, age FROM fea JOIN split USING (encounter_id))")
_BAD = ("kinds AS (" + "\nUNION ALL ".join(
    f"SELECT {lit(c)} AS feature, COUNT(*) FILTER (WHERE split = 'train' AND NOT regexp_matches({q(c)}, {lit(NUMBER_TEXT)})) AS a, "
    f"COUNT(*) FILTER (WHERE split = 'test' AND NOT regexp_matches({q(c)}, {lit(NUMBER_TEXT)})) AS b FROM tx" for c in M11_TEXTS) + ")")
oracle("m11_residual_text_kinds", with_tables(
    "SELECT feature, CASE WHEN a = 0 AND b = 0 THEN 'numeric' ELSE 'category' END AS kind, a AS not_numbers_train, b AS not_numbers_test FROM kinds",
    "fea", [SPLIT, _TEXTS, _BAD]))
oracle("m11_resolved_text", with_tables("\nUNION ALL ".join(
    f"SELECT {lit(c)} AS feature, split, CASE WHEN (SELECT a + b FROM kinds WHERE feature = {lit(c)}) = 0 "
    f"THEN ROUND(SUM(TRY_CAST(TRIM({q(c)}) AS DOUBLE)), 6) END AS total, "
    f"CASE WHEN (SELECT a + b FROM kinds WHERE feature = {lit(c)}) = 0 THEN 0 ELSE COUNT(DISTINCT {q(c)}) END AS categories FROM tx GROUP BY split"
    for c in M11_TEXTS), "fea", [SPLIT, _TEXTS, _BAD]))

# M7, M9: standardised numbers by the train statistics; one-hot slots by the train categories
_num_cols = ", ".join(
    f"ROUND((COALESCE(CAST({q(c)} AS DOUBLE), st.m{i}) - st.a{i}) / CASE WHEN st.s{i} = 0 THEN 1 ELSE st.s{i} END, 6) AS {q(c)}"
    for i, c in enumerate(NUMERIC_FEATURES))
_MED = "med AS (SELECT " + ", ".join(f"COALESCE(MEDIAN(CAST({q(c)} AS DOUBLE)), 0.0) AS m{i}" for i, c in enumerate(NUMERIC_FEATURES)) + " FROM tr)"
_STATS = "st AS (SELECT " + ", ".join(
    f"ANY_VALUE(med.m{i}) AS m{i}, AVG(COALESCE(CAST({q(c)} AS DOUBLE), med.m{i})) AS a{i}, STDDEV_POP(COALESCE(CAST({q(c)} AS DOUBLE), med.m{i})) AS s{i}"
    for i, c in enumerate(NUMERIC_FEATURES)) + " FROM tr, med)"
_modes = [f"COALESCE((SELECT CAST({q(c)} AS VARCHAR) FROM tr WHERE {q(c)} IS NOT NULL GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1), '')" for c in _CATS]
_values = "\nUNION ALL ".join(
    [f"SELECT encounter_id, {g} AS g, COALESCE(CAST({q(c)} AS VARCHAR), {m}) AS v FROM fea" for g, (c, m) in enumerate(zip(_CATS, _modes))])
_flags = "\nUNION ALL ".join(
    f"SELECT encounter_id, {len(NUMERIC_FEATURES)} + (SELECT COUNT(*) FROM cats) + {i} AS idx, CAST({q(c)} AS BIGINT) AS n FROM fea WHERE {q(c)} <> 0"
    for i, c in enumerate(_PASS))
oracle("m7_m9_matrix_rows", with_tables(
    f"SELECT fea.encounter_id, split.split AS split, COALESCE(sl.slots, '') AS slots, {_num_cols} "
    "FROM fea JOIN split USING (encounter_id) LEFT JOIN sl USING (encounter_id) CROSS JOIN st",
    "fea", [SPLIT, TRAIN, f"cats AS ({_cat_rows})",
            f"named AS (SELECT g, v, {len(NUMERIC_FEATURES)} + ROW_NUMBER() OVER (ORDER BY g, v) - 1 AS idx FROM cats)",
            _MED, _STATS, f"vals AS ({_values})", f"flags AS ({_flags})",
            "hot AS (SELECT encounter_id, idx, 1 AS n FROM vals JOIN named USING (g, v) UNION ALL SELECT encounter_id, idx, n FROM flags)",
            "sl AS (SELECT encounter_id, string_agg(CAST(idx AS VARCHAR) || '=' || CAST(n AS VARCHAR), ',' ORDER BY idx) AS slots FROM hot GROUP BY 1)"]))

# what must hold of fitted models: every test row scored alike, coefficients at the optimum, figures that follow
oracle("s9_s10_saved_scores", with_tables(
    "SELECT encounter_id, CAST(readmitted_30d AS INTEGER) AS label, TRUE AS same FROM split WHERE split = 'test'", "fea", [SPLIT]))
oracle("t2_logistic_optimality", with_tables(
    "SELECT name AS feature, TRUE AS at_optimum FROM nums UNION ALL SELECT c || '_' || v, TRUE FROM cats "
    "UNION ALL SELECT name, TRUE FROM pass UNION ALL SELECT '(intercept)', TRUE",
    "fea", [SPLIT, TRAIN, f"cats AS ({_cat_rows})", f"nums(i, name) AS (VALUES {_num_values})", f"pass(i, name) AS (VALUES {_pass_values})"]))
oracle("t3_t8_e1_prediction_checks", with_tables(
    "SELECT m.model, t.n AS rows, t.p AS positives, CAST(0 AS BIGINT) AS outside, TRUE AS agrees FROM (VALUES "
    + ", ".join(f"({lit(m)})" for m in MODEL_ORDER) + ") m(model), "
    "(SELECT COUNT(*) AS n, CAST(SUM(readmitted_30d) AS BIGINT) AS p FROM split WHERE split = 'test') t", "fea", [SPLIT]))
