"""Edge cases and golden values on small literal tables."""
import math

import pytest
from pyspark.sql import functions as F

from carestat.functions.columns import bin_left_closed, icd9_chapter
from carestat.operators import clean as C
from carestat.operators import features as FE
from carestat.operators import impact as B
from carestat.operators import metrics as E
from carestat.operators import profile as P
from carestat.sources.codes import code_dimension, normalize_code_list


def test_icd_edges(spark):
    codes = ["?", None, "V57", "E909", " 250 ", "250.83", "0.5", "1", "139.9", "140", "999.9",
             "1000", "abc"]
    want = ["Unknown", "Unknown", "V_codes", "E_codes", "Endocrine", "Endocrine", "Other",
            "Infectious", "Infectious", "Neoplasms", "Injury", "Other", "Unknown"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(codes)], "i int, code string")
    got = [r[0] for r in df.orderBy("i").select(icd9_chapter(F.col("code"))).collect()]
    assert got == want


def test_right_closed_feature_bins(spark):
    xs = [0, 1, 3, 4, 7, 8, 14, 15, 25, 26, 50, 75, 100, 101, 1000, 1001, None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)],
                               "i int, time_in_hospital int")
    from carestat.functions.columns import cut_right_closed
    got = [r[0] for r in df.orderBy("i").select(
        cut_right_closed(F.col("time_in_hospital"), *FE.STAY_LENGTH_BINS)).collect()]
    assert got == [None, "Short", "Short", "Medium", "Medium", "Long", "Long", "Very Long",
                   "Very Long", "Very Long", "Very Long", "Very Long", "Very Long", None, None,
                   None, None]


def test_left_closed_bins_keep_empty(spark):
    df = spark.createDataFrame([(1, 1, 0), (2, 2, 1), (3, 6, 1), (4, 99, 0)],
                               "encounter_id int, num_procedures int, readmitted_30d int")
    out = {r["bin"]: (r["count"], r["readmission_rate"]) for r in P.binned_rates(
        df, [s for s in P.CLINICAL_BINS if s[0] == "num_procedures"]).collect()}
    assert out["0"] == (0, None)
    assert out["1"] == (1, 0.0)
    assert out["6+"] == (2, 50.0)
    idx = [r[0] for r in df.select(bin_left_closed(F.col("num_procedures"), [0, 3, 6])).collect()]
    assert idx == [0, 0, None, None]  # 6 lies outside [0, 3), [3, 6)


def test_corr_edges(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, None, 5.0), (3.0, 5.0, 5.0),
                                (4.0, 9.0, 5.0), (None, 1.0, 5.0)], "a double, b double, k double")
    out = {r["feature"]: r["correlation"] for r in P.correlations(df, ["b", "k"], target="a").collect()}
    assert out["b"] == pytest.approx(0.963123, abs=1e-6)
    assert out["k"] is None
    order = [r["feature"] for r in P.correlations(df, ["k", "b"], target="a").collect()]
    assert order == ["b", "k"]  # NULL sorts last


def test_drug_edges(spark):
    df = spark.createDataFrame([(s,) for s in ["No", "Steady", "Up", "Down", None, "other"]],
                               "insulin string")
    cols = C.medication_columns(df)
    got = df.select(cols["insulin_used"].alias("u"), cols["insulin_dosage"].alias("d")).collect()
    assert [r.u for r in got] == [0, 1, 1, 1, 1, 1]
    assert [r.d for r in got] == [0, 1, 2, -1, None, None]


def test_missing_dosage_counts_as_change(spark):
    df = spark.createDataFrame([("No", "Up"), (None, "Steady")], "insulin string, metformin string")
    df = df.withColumns(C.medication_columns(df))
    out = FE.features(df).select("med_changes_count", "total_meds_used").collect()
    assert [tuple(r) for r in out] == [(1, 1), (1, 2)]


def test_code_list_shapes(spark):
    nocat = spark.createDataFrame(
        [("1", "Emergency admission type"), ("2", "DISCHARGED home"), ("7", "Admission Source ER"),
         ("9", "unrelated")], "id string, description string")
    got = sorted(tuple(r) for r in normalize_code_list(spark, nocat).collect())
    assert got == [("admission_source", 7, "Admission Source ER"),
                   ("admission_type", 1, "Emergency admission type"),
                   ("discharge_disposition", 2, "DISCHARGED home")]
    bare = spark.createDataFrame([("x",)], "foo string")
    assert normalize_code_list(spark, bare).count() == 10
    dim = code_dimension(spark)
    assert dim.count() == 63
    assert dim.filter("category = 'admission_type' AND id = 6").first()["description"] is None


def _scored(spark, rows):
    return spark.createDataFrame(rows, "label int, score double")


def test_scored_small_ranking(spark):
    sc = _scored(spark, [(1, .9), (0, .8), (1, .7), (0, .7), (1, .4), (0, .2), (0, .1)])
    r = E.ranking_metrics(sc).first()
    assert r.roc_auc == pytest.approx(0.708333, abs=1e-6)
    assert r.average_precision == pytest.approx(0.7, abs=1e-6)
    roc = E.roc_points(sc).orderBy("threshold").collect()
    assert (roc[0].fpr, roc[0].tpr) == (1.0, 1.0)
    fprs = [r.fpr for r in sorted(roc, key=lambda r: -r.threshold)]
    assert fprs == sorted(fprs)


def _golden(spark):
    # TP 24, FP 23, FN 2247, TN 18060 at threshold 0.5
    rows = [(1, 0.9)] * 24 + [(0, 0.9)] * 23 + [(1, 0.1)] * 2247 + [(0, 0.1)] * 18060
    return _scored(spark, rows)


def test_golden_confusion_and_costs(spark):
    sc = _golden(spark)
    m = E.threshold_metrics(sc).first()
    assert round(m.accuracy * 100, 2) == 88.85
    assert round(m.precision * 100, 2) == 51.06
    assert round(m.recall * 100, 2) == 1.06
    assert round(m.f1 * 100, 2) == 2.07
    c = B.cost_analysis(sc).first()
    assert c.scenario_1_cost == 34065000
    assert c.prevented_readmissions == pytest.approx(9.6)
    assert c.scenario_3_savings == pytest.approx(120500)
    assert round(c.roi, 1) == 512.8
    assert round(c.cost_per_prevented_readmission, 2) == 2447.92
    assert round(c.net_savings_per_patient, 2) == 5.92


def test_golden_threshold_and_sizes(spark):
    sweep = spark.createDataFrame([(0.1, 15702, 2000), (0.2, 5000, 900)],
                                  "threshold double, patients_flagged bigint, true_readmissions bigint")
    opt = B.intervention_optimization(sweep)
    best = B.optimal_threshold(opt).first()
    assert best.threshold == 0.1 and best.net_benefit == 4149000
    assert round(best.roi, 1) == 52.8
    total = spark.createDataFrame([(20354,)], "total_patients bigint")
    sizes = {r.size_name: r for r in B.scale_to_sizes(B.optimal_threshold(opt), total).collect()}
    assert [sizes[k].intervention_patients for k in ("small", "medium", "large", "system")] == \
        [77, 385, 1542, 7714]
    assert [round(sizes[k].prevented_readmissions, 1) for k in ("small", "medium", "large", "system")] == \
        [3.9, 19.7, 78.6, 393.0]
    assert round(sizes["small"].net_annual_benefit, 2) == 20384.20
    assert round(sizes["system"].net_annual_benefit, 2) == 2038419.97


def test_sweep_thresholds_inclusive_and_empty(spark):
    sc = _scored(spark, [(1, 0.3), (0, 0.3), (1, 0.95)])
    s = {r.threshold: r for r in B.threshold_sweep(sc).collect()}
    assert len(s) == 9
    assert s[0.3].patients_flagged == 3 and s[0.4].patients_flagged == 1
    assert s[0.9].true_readmissions == 1
    assert s[0.1].recall == 1.0


def test_top_fraction_tie_inclusive(spark):
    sc = _scored(spark, [(1, .9), (0, .5), (1, .5), (0, .5), (0, .1)])
    r = {x.top_percent: x for x in B.top_fraction_capture(sc, [20, 40, 100]).collect()}
    assert r[20].patients_flagged == 1 and r[20].readmissions_captured == 1
    assert r[40].patients_flagged == 4 and r[40].capture_rate == 1.0
    assert r[100].patients_flagged == 5
    assert math.isclose(r[100].lift, 1.0)


def test_duplicate_names_and_feature_groups(spark):
    from carestat.operators import prepare as M
    assert M.unique_names(["a", "b", "a", "a"]) == ["a", "b", "a_1", "a_2"]
    df = spark.createDataFrame([(1, "x", 0)], "time_in_hospital int, gender string, readmitted_30d int")
    g = M.feature_groups(df)
    assert g["categorical"] == ["gender"] and g["numeric"] == ["time_in_hospital"]
    with pytest.raises(ValueError):
        M.feature_groups(df.drop("readmitted_30d"))


def test_code_list_csv_scan(spark, tmp_path):
    from carestat.sources.codes import read_code_list
    p = tmp_path / "codes.csv"
    p.write_text("category,id,description\nadmission_type,1,Emergency\nadmission_type,6,NULL\n"
                 "admission_type,1,Emergency again\n")
    rows = {(r.category, r.id): r.description for r in read_code_list(spark, str(p)).collect()}
    assert rows[("admission_type", 6)] is None
    assert rows[("admission_type", 1)] == "Emergency again"  # last row wins


def test_column_counts(spark):
    from carestat.plans import tables
    from conftest import SF_SMALL
    raw = tables.raw(spark, SF_SMALL)
    cleaned = tables.cleaned(spark, SF_SMALL)
    featured = tables.featured(spark, SF_SMALL)
    assert len(cleaned.columns) == len(raw.columns) + 65 - 3
    assert len(featured.columns) == len(cleaned.columns) + 15
    assert len(set(featured.columns)) == len(featured.columns)


def test_band_and_lift_with_empty_groups(spark):
    df = spark.createDataFrame(
        [(2, 3, 1, "[70-80)", 0, 1), (9, 20, 9, "[20-30)", 0, 0)],
        "time_in_hospital int, num_medications int, number_diagnoses int, age string, "
        "circulatory_respiratory_comorbidity int, readmitted_30d int")
    bands = {r.band: (r["count"], r.readmission_rate) for r in P.band_comparisons(df).collect()}
    assert bands["stay_gt7"] == (1, 0.0) and bands["stay_lt3"] == (1, 100.0)
    assert bands["meds_lt5"] == (1, 100.0) and bands["dx_8plus"] == (1, 0.0)
    lift = P.comorbidity_lift(df).first()
    assert lift.n_comorbid == 0 and lift.comorbid_rate is None and lift.lift is None
    assert lift.overall_rate == 0.5


def test_class_report_on_golden_confusion(spark):
    rep = {r["class"]: r for r in E.class_report(_golden(spark)).collect()}
    tp, fp, fn, tn = 24, 23, 2247, 18060
    p0, r0 = tn / (tn + fn), tn / (tn + fp)
    p1, r1 = tp / (tp + fp), tp / (tp + fn)
    f0, f1 = 2 * p0 * r0 / (p0 + r0), 2 * p1 * r1 / (p1 + r1)
    assert rep["0"].precision == pytest.approx(p0, abs=1e-6) and rep["0"].support == tn + fp
    assert rep["1"].recall == pytest.approx(r1, abs=1e-6) and rep["1"].support == tp + fn
    assert rep["macro avg"].f1 == pytest.approx((f0 + f1) / 2, abs=1e-6)
    n = tp + fp + fn + tn
    assert rep["weighted avg"].precision == pytest.approx((p0 * (tn + fp) + p1 * (tp + fn)) / n, abs=1e-6)


def test_medication_rate_difference_undefined_cases(spark):
    df = spark.createDataFrame(
        [("No", "Up", 1), ("No", "Down", 0), ("No", "Up", 0), ("No", "Steady", 1)],
        "metformin string, insulin string, readmitted_30d int")
    out = {r.medication: r for r in P.medication_rate_difference(df, ["metformin", "insulin"]).collect()}
    assert out["metformin"].used_rate is None and out["metformin"].direction is None
    assert out["insulin"].no_rate is None and out["insulin"].rate_diff is None
    # unweighted mean of the used groups: Up 50 %, Down 0 %, Steady 100 % -> 50 %
    assert out["insulin"].used_rate == 50.0


def test_extreme_groups_ties_take_first_category(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("c", 0)], "race string, readmitted_30d int")
    r = P.extreme_groups(df, ["race"]).first()
    assert (r.highest_category, r.lowest_category) == ("a", "c")
    assert r.rate_ratio is None and r.overall_rate == pytest.approx(66.666667, abs=1e-6)


def test_box_summary_matches_numpy(spark):
    import numpy as np
    xs = {"<30": [1, 2, 2, 3, 4, 5, 40], "NO": [10, 11, 12, 13]}
    rows = [(g, float(x)) for g, v in xs.items() for x in v] + [("NO", None)]
    df = spark.createDataFrame(rows, "readmitted string, num_procedures double")
    out = {r.group: r for r in P.box_summary(df, ["num_procedures"]).collect()}
    for g, v in xs.items():
        a = np.array(v, dtype=float)
        q1, med, q3 = np.percentile(a, [25, 50, 75])
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = a[(a >= lo) & (a <= hi)]
        r = out[g]
        assert (r.q1, r.median, r.q3) == pytest.approx((q1, med, q3))
        assert (r.whisker_low, r.whisker_high) == (inside.min(), inside.max())
        assert r.n_outliers == int(((a < lo) | (a > hi)).sum()) and r.n == len(a)


def test_hot_customer_history_is_day_bounded_and_exact(spark):
    import datetime as dt

    import pandas as pd
    from carestat.sources.fixture import customer_days
    base = dt.date(1995, 1, 1)
    rows = []
    for o in range(1, 301):
        cust = 1 if o % 3 == 0 else 2 + o % 40           # customer 1 holds a third
        day = base + dt.timedelta(days=(o * 7) % 400)
        rows.append((o, cust, "OPF"[o % 3], day))
    orders = spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string, day date")
    customer = spark.createDataFrame([(c, 0, "BUILDING") for c in range(1, 50)],
                                     "c_custkey long, c_nationkey int, c_mktsegment string")
    days = customer_days(orders, customer)
    hot = days.filter("o_custkey = 1").count()
    assert hot == len({r[3] for r in rows if r[1] == 1})   # one row per day, not per order
    got = {(r.o_custkey, r.day): r for r in days.collect()}
    pdf = pd.DataFrame(rows, columns=["o", "c", "s", "d"])
    for (c, d), r in got.items():
        prev = pdf[(pdf.c == c) & (pdf.d < d) & (pdf.d >= d - dt.timedelta(days=365))]
        assert r.number_outpatient == int((prev.s == "O").sum())
        assert r.number_inpatient == int((prev.s == "F").sum())
        later = pdf[(pdf.c == c) & (pdf.d > d)].d
        assert r.next_day == (later.min() if len(later) else None)
