"""DuckDB oracle SQL for the scoring, evaluation and impact queries."""

from __future__ import annotations

from ..operators import impact as B
from ..operators import score as R
from .oracle import oracle
from .oracle_base import case_map, lit, with_tables


def _factor(x: str, scale: float) -> str:
    return f"CASE WHEN {x} IS NULL THEN NULL ELSE LEAST(CAST({x} AS DOUBLE) / CAST({scale} AS DOUBLE), CAST(1.0 AS DOUBLE)) END"


RULE = (
    "CASE WHEN f IS NULL THEN NULL ELSE LEAST(CAST(0.15 AS DOUBLE) * f, CAST(0.95 AS DOUBLE)) END")
RULE_FACTORS = (
    # decimals would multiply exactly: every factor is a double, as in the operator
    f"CAST(COALESCE({case_map('age', R.AGE_WEIGHT)}, 0.3) AS DOUBLE) * "
    f"CAST(CASE WHEN gender = 'Male' THEN 1.0 ELSE 0.9 END AS DOUBLE) * "
    f"{_factor('time_in_hospital', 10.0)} * {_factor('num_medications', 20.0)} * "
    f"{_factor('number_diagnoses', 5.0)} * "
    f"CAST(COALESCE({case_map('\"A1Cresult\"', R.A1C_WEIGHT)}, 1.0) AS DOUBLE) * "
    f"CAST(COALESCE({case_map('insulin', R.INSULIN_WEIGHT)}, 1.0) AS DOUBLE)")

RS = (f"rs0 AS (SELECT *, {RULE_FACTORS} AS f FROM fea), "
      f"rs1 AS (SELECT *, {RULE} AS rule_score FROM rs0), "
      f"rs AS (SELECT *, ROUND(rule_score / {R.RULE_SCORE_MAX}, 6) AS scaled_rule_score, "
      "CASE WHEN rule_score < 0.1 THEN 'Low' WHEN rule_score < 0.25 THEN 'Moderate' "
      "WHEN rule_score IS NOT NULL THEN 'High' END AS risk_tier FROM rs1), "
      "sc AS (SELECT encounter_id, CAST(readmitted_30d AS INTEGER) AS label, "
      f"rule_score / CAST({R.RULE_SCORE_MAX} AS DOUBLE) AS score FROM rs)")


def W(select: str, extra: list[str] | None = None) -> str:
    return with_tables(select, "fea", [RS, *(extra or [])])


CM = ("cm AS (SELECT COUNT(*) FILTER (WHERE score >= {t} AND label = 1) AS tp, "
      "COUNT(*) FILTER (WHERE score >= {t} AND label <> 1) AS fp, "
      "COUNT(*) FILTER (WHERE NOT (score >= {t}) AND label = 1) AS fn, "
      "COUNT(*) FILTER (WHERE NOT (score >= {t}) AND label <> 1) AS tn FROM sc)")


def zdiv(a: str, b: str) -> str:
    return f"COALESCE(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0), 0.0)"


def sdiv(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


PREC, REC = zdiv("tp", "tp + fp"), zdiv("tp", "tp + fn")
F1 = zdiv(f"2 * {PREC} * {REC}", f"{PREC} + {REC}")

GROUPS = ("g0 AS (SELECT score, COUNT(*) AS n, CAST(SUM(label) AS BIGINT) AS pos FROM sc GROUP BY score), "
          "g AS (SELECT score, n, pos, n - pos AS neg, "
          "SUM(n) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cum_n, "
          "SUM(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cum_pos, "
          "SUM(n - pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cum_neg, "
          "SUM(pos) OVER () AS pos_total, SUM(n - pos) OVER () AS neg_total FROM g0)")
AUC = ("ROUND(SUM(neg * ((cum_pos - pos) + pos / 2.0)) / NULLIF(CAST(MAX(pos_total) AS DOUBLE) * MAX(neg_total), 0), 6)")
AP = ("ROUND(SUM(pos * (CAST(cum_pos AS DOUBLE) / NULLIF(cum_n, 0))) / NULLIF(CAST(MAX(pos_total) AS DOUBLE), 0), 6)")

# ---------------------------------------------------------------- R -------
oracle("r2_rule_score", W("SELECT encounter_id, ROUND(rule_score, 9) AS rule_score, scaled_rule_score FROM rs"))
oracle("r3_r4_risk_tiers", W(
    "SELECT encounter_id, risk_tier, CASE WHEN scaled_rule_score > 0.32 THEN 'High' "
    "WHEN scaled_rule_score >= 0.2 THEN 'Moderate' WHEN scaled_rule_score IS NOT NULL THEN 'Low' END "
    "AS report_tier FROM rs"))
_actions = ", ".join(f"({lit(t)}, {i + 1}, {lit(a)})" for t, acts in R.TIER_ACTIONS.items()
                     for i, a in enumerate(acts))
oracle("r5_recommended_actions", W(
    "SELECT rs.encounter_id, rs.risk_tier, a.action_no, a.action FROM rs "
    "JOIN acts a ON a.risk_tier = rs.risk_tier",
    [f"acts(risk_tier, action_no, action) AS (VALUES {_actions})"]))
oracle("r6_tier_population", W(
    "SELECT risk_tier, COUNT(*) AS count, ROUND(COUNT(*) / SUM(COUNT(*)) OVER (), 6) AS share, "
    "ROUND(AVG(readmitted_30d), 6) AS actual_rate, ROUND(AVG(rule_score), 6) AS mean_score "
    "FROM rs GROUP BY risk_tier"))

# ---------------------------------------------------------------- E -------
oracle("e2_confusion_matrix", W("SELECT * FROM cm", [CM.format(t=0.5)]))
oracle("e3_threshold_metrics", W(
    f"SELECT tp, fp, fn, tn, ROUND({sdiv('tp + tn', 'tp + fp + fn + tn')}, 6) AS accuracy, "
    f"ROUND({PREC}, 6) AS precision, ROUND({REC}, 6) AS recall, ROUND({F1}, 6) AS f1 FROM cm",
    [CM.format(t=0.5)]))


def _prf(t, fp, fn):
    p, r = zdiv(t, f"{t} + {fp}"), zdiv(t, f"{t} + {fn}")
    return p, r, zdiv(f"2 * {p} * {r}", f"{p} + {r}")


_p1, _r1, _f1 = _prf("tp", "fp", "fn")
_p0, _r0, _f0 = _prf("tn", "fn", "fp")
oracle("e4_class_report", W(
    f"SELECT '0' AS class, ROUND({_p0}, 6) AS precision, ROUND({_r0}, 6) AS recall, ROUND({_f0}, 6) AS f1, "
    f"CAST(tn + fp AS BIGINT) AS support FROM cm UNION ALL "
    f"SELECT '1', ROUND({_p1}, 6), ROUND({_r1}, 6), ROUND({_f1}, 6), CAST(tp + fn AS BIGINT) FROM cm UNION ALL "
    f"SELECT 'macro avg', ROUND(({_p0} + {_p1}) / 2, 6), ROUND(({_r0} + {_r1}) / 2, 6), "
    f"ROUND(({_f0} + {_f1}) / 2, 6), CAST(tp + fp + fn + tn AS BIGINT) FROM cm UNION ALL "
    f"SELECT 'weighted avg', ROUND({sdiv(f'{_p0} * (tn + fp) + {_p1} * (tp + fn)', 'tp + fp + fn + tn')}, 6), "
    f"ROUND({sdiv(f'{_r0} * (tn + fp) + {_r1} * (tp + fn)', 'tp + fp + fn + tn')}, 6), "
    f"ROUND({sdiv(f'{_f0} * (tn + fp) + {_f1} * (tp + fn)', 'tp + fp + fn + tn')}, 6), "
    f"CAST(tp + fp + fn + tn AS BIGINT) FROM cm", [CM.format(t=0.5)]))
oracle("e5_e6_ranking_metrics", W(f"SELECT {AUC} AS roc_auc, {AP} AS average_precision FROM g", [GROUPS]))
oracle("e7_roc_points", W(
    "SELECT score AS threshold, ROUND(CAST(cum_neg AS DOUBLE) / NULLIF(neg_total, 0), 6) AS fpr, "
    "ROUND(CAST(cum_pos AS DOUBLE) / NULLIF(pos_total, 0), 6) AS tpr FROM g", [GROUPS]))
oracle("e8_pr_points", W(
    "SELECT score AS threshold, ROUND(CAST(cum_pos AS DOUBLE) / NULLIF(cum_n, 0), 6) AS precision, "
    "ROUND(CAST(cum_pos AS DOUBLE) / NULLIF(pos_total, 0), 6) AS recall FROM g", [GROUPS]))
oracle("e9_prevalence", W("SELECT ROUND(AVG(label), 6) AS no_skill_precision FROM sc"))
oracle("e10_normalized_confusion", W(
    "SELECT actual, predicted, count, ROUND(COALESCE(CAST(count AS DOUBLE) / "
    "NULLIF(SUM(count) OVER (PARTITION BY actual), 0), 0.0), 6) AS share FROM ("
    "SELECT 0 AS actual, 0 AS predicted, tn AS count FROM cm UNION ALL SELECT 0, 1, fp FROM cm "
    "UNION ALL SELECT 1, 0, fn FROM cm UNION ALL SELECT 1, 1, tp FROM cm) t", [CM.format(t=0.5)]))


def _model_row(name: str, t: float) -> str:
    tp = f"SUM(CASE WHEN score >= {t} THEN pos ELSE 0 END)"
    fp = f"SUM(CASE WHEN score >= {t} THEN neg ELSE 0 END)"
    fn = f"SUM(CASE WHEN NOT (score >= {t}) THEN pos ELSE 0 END)"
    tn = f"SUM(CASE WHEN NOT (score >= {t}) THEN neg ELSE 0 END)"
    inner = (f"SELECT {tp} AS tp, {fp} AS fp, {fn} AS fn, {tn} AS tn, {AUC} AS roc_auc, "
             f"{AP} AS average_precision FROM g")
    return (f"SELECT '{name}' AS model, ROUND({sdiv('tp + tn', 'tp + fp + fn + tn')}, 6) AS accuracy, "
            f"ROUND({PREC}, 6) AS precision, ROUND({REC}, 6) AS recall, ROUND({F1}, 6) AS f1, "
            f"roc_auc, average_precision FROM ({inner}) m")


def _pct(c: str) -> str:
    return f"printf('%.2f%%', ROUND({c} * 100.0, 2))"


oracle("e11_comparison_table", W(
    f"SELECT model, {_pct('accuracy')} AS \"Accuracy\", {_pct('precision')} AS \"Precision\", "
    f"{_pct('recall')} AS \"Recall\", {_pct('f1')} AS \"F1 Score\", {_pct('roc_auc')} AS \"ROC AUC\", "
    f"{_pct('average_precision')} AS \"Avg Precision\" FROM ("
    f"{_model_row('Rule Score', 0.5)} UNION ALL {_model_row('Rule Score (threshold 0.3)', 0.3)}) t",
    [GROUPS]))
oracle("e14_score_histogram", W(
    "SELECT label, bucket, ROUND(bucket / 20.0, 6) AS bin_low, count, "
    "ROUND(count / (SUM(count) OVER (PARTITION BY label) * (1.0 / 20)), 6) AS density FROM ("
    "SELECT label, CAST(LEAST(FLOOR(score * 20), 19) AS INTEGER) AS bucket, COUNT(*) AS count "
    "FROM sc GROUP BY 1, 2) t"))

# ---------------------------------------------------------------- B -------
_RC, _IC, _EF = (f"CAST({float(B.READMISSION_COST)} AS DOUBLE)", f"CAST({float(B.INTERVENTION_COST)} AS DOUBLE)",
                  f"CAST({B.EFFECTIVENESS} AS DOUBLE)")
COSTS = (
    "costs AS (SELECT tp + fp + fn + tn AS total_patients, tp + fn AS actual_readmissions, "
    f"ROUND({sdiv('tp + fn', 'tp + fp + fn + tn')}, 6) AS readmission_rate, "
    "tp + fp AS predicted_readmissions, tp AS true_positives, fp AS false_positives, "
    f"fn AS false_negatives, {_RC} AS base_readmission_cost, {_IC} AS intervention_cost, "
    f"{_EF} AS intervention_effectiveness, ROUND(tp * {_EF}, 6) AS prevented_readmissions, "
    f"ROUND((tp + fn) * {_RC}, 6) AS scenario_1_cost, "
    f"ROUND((tp + fp + fn + tn) * {_IC} + (tp + fn) * (1 - {_EF}) * {_RC}, 6) AS scenario_2_total_cost, "
    f"ROUND((tp + fn) * {_RC} - ((tp + fp + fn + tn) * {_IC} + (tp + fn) * (1 - {_EF}) * {_RC}), 6) AS scenario_2_savings, "
    f"ROUND((tp + fp) * {_IC} + ((tp + fn) - tp * {_EF}) * {_RC}, 6) AS scenario_3_total_cost, "
    f"ROUND((tp + fn) * {_RC} - ((tp + fp) * {_IC} + ((tp + fn) - tp * {_EF}) * {_RC}), 6) AS scenario_3_savings, "
    f"ROUND((tp + fn) * {_IC} + (tp + fn) * (1 - {_EF}) * {_RC}, 6) AS scenario_4_total_cost, "
    f"ROUND((tp + fn) * {_RC} - ((tp + fn) * {_IC} + (tp + fn) * (1 - {_EF}) * {_RC}), 6) AS scenario_4_savings, "
    f"ROUND(COALESCE(((tp + fn) * {_RC} - ((tp + fp) * {_IC} + ((tp + fn) - tp * {_EF}) * {_RC})) * 100.0 / "
    f"NULLIF((tp + fp) * {_IC}, 0), 0.0), 6) AS roi, "
    f"ROUND((tp + fp) * {_IC} / NULLIF(tp * {_EF}, 0), 6) AS cost_per_prevented_readmission, "
    f"ROUND(((tp + fn) * {_RC} - ((tp + fp) * {_IC} + ((tp + fn) - tp * {_EF}) * {_RC})) / "
    "NULLIF(CAST(tp + fp + fn + tn AS DOUBLE), 0), 6) AS net_savings_per_patient FROM cm)")
oracle("b1_b3_cost_analysis", W("SELECT * FROM costs", [CM.format(t=0.5), COSTS]))

SCEN = (
    "scen AS (SELECT 'No Intervention' AS strategy, 0.0 AS intervention, "
    "actual_readmissions * base_readmission_cost AS readmission, "
    "actual_readmissions * base_readmission_cost AS base FROM costs UNION ALL "
    "SELECT 'Universal Intervention', total_patients * intervention_cost, "
    "actual_readmissions * (1 - intervention_effectiveness) * base_readmission_cost, "
    "actual_readmissions * base_readmission_cost FROM costs UNION ALL "
    "SELECT 'Model-Based Intervention', predicted_readmissions * intervention_cost, "
    "(actual_readmissions - prevented_readmissions) * base_readmission_cost, "
    "actual_readmissions * base_readmission_cost FROM costs UNION ALL "
    "SELECT 'Perfect Prediction', actual_readmissions * intervention_cost, "
    "actual_readmissions * (1 - intervention_effectiveness) * base_readmission_cost, "
    "actual_readmissions * base_readmission_cost FROM costs), "
    "scen2 AS (SELECT strategy, ROUND(intervention, 6) AS intervention_cost, "
    "ROUND(readmission, 6) AS readmission_cost, ROUND(intervention + readmission, 6) AS total_cost, "
    "ROUND(base - (intervention + readmission), 6) AS savings_vs_nothing FROM scen)")
oracle("b2_scenarios", W("SELECT * FROM scen2", [CM.format(t=0.5), COSTS, SCEN]))
_cols4 = ("intervention_cost", "readmission_cost", "total_cost", "savings_vs_nothing")
oracle("b11_strategy_comparison", W(
    "SELECT * FROM scen2 UNION ALL SELECT 'Model minus Universal', " + ", ".join(
        f"ROUND(MAX(CASE WHEN strategy = 'Model-Based Intervention' THEN {c} END) - "
        f"MAX(CASE WHEN strategy = 'Universal Intervention' THEN {c} END), 6)" for c in _cols4)
    + " FROM scen2", [CM.format(t=0.5), COSTS, SCEN]))
oracle("b4_high_risk_summary", W(
    "SELECT CAST(0.7 AS DOUBLE) AS threshold, COUNT(*) FILTER (WHERE score >= 0.7) AS high_risk_count, "
    "COUNT(*) FILTER (WHERE score >= 0.7 AND label = 1) AS high_risk_readmissions, "
    f"ROUND({zdiv('COUNT(*) FILTER (WHERE score >= 0.7 AND label = 1)', 'COUNT(*) FILTER (WHERE score >= 0.7)')}, 6)"
    " AS precision FROM sc"))

_th = ", ".join(f"(CAST({t} AS DOUBLE))" for t in B.THRESHOLDS)
SWEEP = (f"th(threshold) AS (VALUES {_th}), "
         "sweep AS (SELECT th.threshold, CAST(COUNT(sc.score) AS BIGINT) AS patients_flagged, "
         "CAST(COALESCE(SUM(sc.label), 0) AS BIGINT) AS true_readmissions, "
         "(SELECT SUM(label) FROM sc) AS p_total "
         "FROM th LEFT JOIN sc ON sc.score >= th.threshold GROUP BY th.threshold)")
oracle("b5_threshold_sweep", W(
    "SELECT threshold, patients_flagged, true_readmissions, "
    f"ROUND({zdiv('true_readmissions', 'patients_flagged')}, 6) AS precision, "
    f"ROUND({zdiv('true_readmissions', 'p_total')}, 6) AS recall FROM sweep", [SWEEP]))
OPT = ("opt AS (SELECT threshold, patients_flagged, true_readmissions, "
       f"ROUND(patients_flagged * {_IC}, 6) AS intervention_cost_total, "
       f"ROUND(true_readmissions * {_EF}, 6) AS prevented_readmissions, "
       f"ROUND(true_readmissions * {_EF} * {_RC}, 6) AS savings_from_prevention, "
       f"ROUND(true_readmissions * {_EF} * {_RC} - patients_flagged * {_IC}, 6) AS net_benefit, "
       f"ROUND((true_readmissions * {_EF} * {_RC} - patients_flagged * {_IC}) * 100.0 / "
       f"NULLIF(patients_flagged * {_IC}, 0), 6) AS roi FROM sweep)")
oracle("b7_intervention_optimization", W("SELECT * FROM opt", [SWEEP, OPT]))
BEST = "best AS (SELECT * FROM opt ORDER BY net_benefit DESC, threshold ASC LIMIT 1)"
oracle("b8_optimal_threshold", W("SELECT * FROM best", [SWEEP, OPT, BEST]))
_sizes = ", ".join(f"({lit(n)}, {s})" for n, s in B.HOSPITAL_SIZES)
oracle("b9_hospital_sizes", W(
    "SELECT s.size_name, CAST(s.annual_patients AS BIGINT) AS annual_patients, "
    "CAST(FLOOR(b.patients_flagged * (s.annual_patients / CAST(t.n AS DOUBLE))) AS BIGINT) AS intervention_patients, "
    "ROUND(b.prevented_readmissions * (s.annual_patients / CAST(t.n AS DOUBLE)), 6) AS prevented_readmissions, "
    "ROUND(b.net_benefit * (s.annual_patients / CAST(t.n AS DOUBLE)), 6) AS net_annual_benefit "
    "FROM best b, sizes s, (SELECT COUNT(*) AS n FROM sc) t",
    [SWEEP, OPT, BEST, f"sizes(size_name, annual_patients) AS (VALUES {_sizes})"]))
_grid = ", ".join(f"(CAST({float(r)} AS DOUBLE), CAST({float(i)} AS DOUBLE), CAST({float(e)} AS DOUBLE))" for r in B.GRID_READMISSION_COST
                  for i in B.GRID_INTERVENTION_COST for e in B.GRID_EFFECTIVENESS)
oracle("b10_what_if_grid", W(
    "SELECT readmission_cost, intervention_cost, effectiveness, threshold AS optimal_threshold, "
    "ROUND(net, 6) AS net_benefit, ROUND(net * 100.0 / NULLIF(cost, 0), 6) AS roi FROM ("
    "SELECT *, ROW_NUMBER() OVER (PARTITION BY readmission_cost, intervention_cost, effectiveness "
    "ORDER BY net DESC, threshold ASC) AS rn FROM ("
    "SELECT g.*, s.threshold, s.patients_flagged * g.intervention_cost AS cost, "
    "s.true_readmissions * g.effectiveness * g.readmission_cost - s.patients_flagged * g.intervention_cost AS net "
    "FROM sweep s, grid g) x) y WHERE rn = 1",
    [SWEEP, f"grid(readmission_cost, intervention_cost, effectiveness) AS (VALUES {_grid})"]))
_pcts = ", ".join(f"({p})" for p in B.TOP_PERCENTS)
CAPTURE = (f"pcts(p) AS (VALUES {_pcts}), "
           "cap AS (SELECT p AS top_percent, "
           "(SELECT MIN(cum_n) FROM g WHERE cum_n >= CAST(CEIL(p * (g2.pos_total + g2.neg_total) / 100.0) AS BIGINT)) AS flagged, "
           "g2.pos_total AS p_total, g2.pos_total + g2.neg_total AS n_total "
           "FROM pcts, (SELECT MAX(pos_total) AS pos_total, MAX(neg_total) AS neg_total FROM g) g2)")
oracle("b12_top_fraction_capture", W(
    "SELECT CAST(top_percent AS INTEGER) AS top_percent, CAST(g.cum_n AS BIGINT) AS patients_flagged, "
    "CAST(g.cum_pos AS BIGINT) AS readmissions_captured, "
    "ROUND(CAST(g.cum_pos AS DOUBLE) / NULLIF(p_total, 0), 6) AS capture_rate, "
    "ROUND((CAST(g.cum_pos AS DOUBLE) / NULLIF(p_total, 0)) / NULLIF(CAST(g.cum_n AS DOUBLE) / n_total, 0), 6) AS lift "
    "FROM cap JOIN g ON g.cum_n = cap.flagged", [GROUPS, CAPTURE]))
_dsizes = ", ".join(f"({lit(n)}, {s})" for n, s in B.DASHBOARD_SIZES)
oracle("b13_size_benefits", W(
    "SELECT hospital, CAST(annual_patients AS BIGINT) AS annual_patients, "
    "ROUND(fl, 6) AS intervention_patients, ROUND(tp * 0.4, 6) AS prevented_readmissions, "
    "ROUND(tp * 0.4 * 15000.0 - fl * 500.0, 6) AS net_annual_benefit, "
    "ROUND((tp * 0.4 * 15000.0 - fl * 500.0) * 100.0 / NULLIF(fl * 500.0, 0), 6) AS roi FROM ("
    "SELECT s.hospital, s.annual_patients, s.annual_patients * g.cum_n / CAST(cap.n_total AS DOUBLE) AS fl, "
    "s.annual_patients * g.cum_pos / CAST(cap.n_total AS DOUBLE) AS tp "
    "FROM cap JOIN g ON g.cum_n = cap.flagged, sizes s WHERE cap.top_percent = 20) t",
    [GROUPS, CAPTURE.replace(_pcts, "(20)"), f"sizes(hospital, annual_patients) AS (VALUES {_dsizes})"]))
oracle("s11_kpi_table", W(
    "SELECT 'problem' AS section, 'readmission_rate_pct' AS metric, ROUND(readmission_rate * 100, 6) AS value FROM costs "
    "UNION ALL SELECT 'problem', 'actual_readmissions', actual_readmissions FROM costs "
    "UNION ALL SELECT 'problem', 'total_patients', total_patients FROM costs "
    "UNION ALL SELECT 'problem', 'total_readmission_cost', scenario_1_cost FROM costs "
    "UNION ALL SELECT 'financial', 'model_savings', scenario_3_savings FROM costs "
    "UNION ALL SELECT 'financial', 'model_roi_pct', roi FROM costs "
    "UNION ALL SELECT 'financial', 'net_savings_per_patient', net_savings_per_patient FROM costs "
    "UNION ALL SELECT 'clinical', 'prevented_readmissions', prevented_readmissions FROM costs "
    "UNION ALL SELECT 'clinical', 'cost_per_prevented_readmission', cost_per_prevented_readmission FROM costs "
    "UNION ALL SELECT 'threshold', 'optimal_threshold', threshold FROM best "
    "UNION ALL SELECT 'threshold', 'optimal_net_benefit', net_benefit FROM best "
    "UNION ALL SELECT 'threshold', 'optimal_roi_pct', roi FROM best",
    [CM.format(t=0.5), COSTS, SWEEP, OPT, BEST]))
oracle("b6_high_risk_profile", W(
    "SELECT profile, category, ROUND(value, 6) AS value FROM ("
    "SELECT 'age' AS profile, age AS category, CAST(COUNT(*) AS DOUBLE) AS value FROM hr WHERE age IS NOT NULL GROUP BY age "
    "UNION ALL SELECT 'gender', gender, COUNT(*) FROM hr WHERE gender IS NOT NULL GROUP BY gender "
    "UNION ALL SELECT 'diag_1_category', diag_1_category, COUNT(*) FROM hr WHERE diag_1_category IS NOT NULL GROUP BY diag_1_category "
    "UNION ALL SELECT 'mean', 'avg_time_in_hospital', AVG(time_in_hospital) FROM hr "
    "UNION ALL SELECT 'mean', 'avg_num_medications', AVG(num_medications) FROM hr "
    "UNION ALL SELECT 'mean', 'avg_num_procedures', AVG(num_procedures) FROM hr) t",
    ["hr AS (SELECT * FROM fea WHERE encounter_id IN (SELECT encounter_id FROM sc WHERE score >= 0.7))"]))
