"""Cost, threshold and benefit analysis of a scored population.

Input: ``label`` (0/1) and ``score`` columns, as in ``metrics``.

Scale notes: every row-level step is a single global aggregate. The
threshold sweep is one pass of conditional sums per threshold (no theta
join);
top-fraction capture accumulates over the distinct-score table and emits
the boundary rows with a generator, so no join against a parameter table
is ever needed. Parameter grids and population sizes are expanded with
``explode`` over literal arrays on already-aggregated rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import col, r6, rows_of, safe_div, zero_div
from .metrics import LABEL, SCORE, confusion, score_groups

# --- fixed values: cost parameters and analysis grids ----------------------
READMISSION_COST = 15000
INTERVENTION_COST = 500
EFFECTIVENESS = 0.40
HIGH_RISK_THRESHOLD = 0.7
THRESHOLDS = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]
HOSPITAL_SIZES = [("small", 100), ("medium", 500), ("large", 2000), ("system", 10000)]
DASHBOARD_SIZES = [("Small Community", 100), ("Medium Community", 500),
                   ("Large Community", 2000), ("Regional Center", 5000),
                   ("Major Medical Center", 10000)]
GRID_READMISSION_COST = [5000, 10000, 15000, 25000, 50000]
GRID_INTERVENTION_COST = [100, 250, 500, 1000, 5000]
GRID_EFFECTIVENESS = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7]
TOP_PERCENTS = [10, 20, 30, 40, 50, 60, 70, 80, 90, 100]
FLAG_PERCENT = 20


# ------------------------------------------------------------- B1-B3 ------
def cost_analysis(scored: DataFrame, threshold: float = 0.5, *,
                  readmission_cost: float = READMISSION_COST,
                  intervention_cost: float = INTERVENTION_COST,
                  effectiveness: float = EFFECTIVENESS) -> DataFrame:
    """One row with counts, the four scenario costs and the ratios."""
    cm = confusion(scored, threshold)
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    actual = tp + fn
    predicted = tp + fp
    rc, ic, eff = F.lit(float(readmission_cost)), F.lit(float(intervention_cost)), F.lit(effectiveness)
    s1 = actual * rc
    s2 = n * ic + actual * (1 - eff) * rc
    prevented = tp * eff
    s3_int = predicted * ic
    s3 = s3_int + (actual - prevented) * rc
    s4 = actual * ic + actual * (1 - eff) * rc
    out = cm.select(
        n.alias("total_patients"), actual.alias("actual_readmissions"),
        r6(safe_div(actual, n)).alias("readmission_rate"),
        predicted.alias("predicted_readmissions"),
        tp.alias("true_positives"), fp.alias("false_positives"), fn.alias("false_negatives"),
        rc.alias("base_readmission_cost"), ic.alias("intervention_cost"),
        eff.alias("intervention_effectiveness"),
        r6(prevented).alias("prevented_readmissions"),
        r6(s1).alias("scenario_1_cost"),
        r6(s2).alias("scenario_2_total_cost"), r6(s1 - s2).alias("scenario_2_savings"),
        r6(s3).alias("scenario_3_total_cost"), r6(s1 - s3).alias("scenario_3_savings"),
        r6(s4).alias("scenario_4_total_cost"), r6(s1 - s4).alias("scenario_4_savings"),
        r6(F.coalesce(safe_div((s1 - s3) * 100.0, s3_int), F.lit(0.0))).alias("roi"),
        r6(safe_div(s3_int, prevented)).alias("cost_per_prevented_readmission"),
        r6(safe_div(s1 - s3, n)).alias("net_savings_per_patient"),
    )
    return out


def scenarios(costs: DataFrame, with_difference: bool = False) -> DataFrame:
    """B2/B11 long form: per strategy the intervention, readmission and total
    cost and the saving against doing nothing."""
    ic, rc = F.col("intervention_cost"), F.col("base_readmission_cost")
    eff = F.col("intervention_effectiveness")
    n, actual = F.col("total_patients"), F.col("actual_readmissions")
    pred, prevented = F.col("predicted_readmissions"), F.col("prevented_readmissions")
    names = ("strategy", "intervention", "readmission", "total", "savings")
    base = actual * rc

    def r(label, inter, readm):
        return (label, r6(inter), r6(readm), r6(inter + readm), r6(base - (inter + readm)))

    univ = r("Universal Intervention", n * ic, actual * (1 - eff) * rc)
    model = r("Model-Based Intervention", pred * ic, (actual - prevented) * rc)
    rows = [r("No Intervention", F.lit(0.0), base), univ, model,
            r("Perfect Prediction", actual * ic, actual * (1 - eff) * rc)]
    if with_difference:
        rows.append(("Model minus Universal", *[r6(m - u) for m, u in zip(model[1:], univ[1:])]))
    long = costs.select(F.inline(rows_of(names, *rows)))
    return long.select("strategy", F.col("intervention").alias("intervention_cost"),
                       F.col("readmission").alias("readmission_cost"),
                       F.col("total").alias("total_cost"),
                       F.col("savings").alias("savings_vs_nothing"))


def strategy_comparison(costs: DataFrame) -> DataFrame:
    """The strategies plus the model-minus-universal difference row,
    all from the one cost row (no second pass)."""
    return scenarios(costs, with_difference=True)


# ------------------------------------------------------------------ B4 ----
def high_risk_summary(scored: DataFrame, threshold: float = HIGH_RISK_THRESHOLD) -> DataFrame:
    """Flagged rows at ``score >= threshold``, their positives, precision."""
    flag = F.col(SCORE) >= F.lit(threshold)
    one = scored.agg(F.count_if(flag).alias("high_risk_count"),
                     F.count_if(flag & (F.col(LABEL) == 1)).alias("high_risk_readmissions"))
    return one.select(F.lit(threshold).alias("threshold"), "high_risk_count", "high_risk_readmissions",
                      r6(zero_div(F.col("high_risk_readmissions"), F.col("high_risk_count")))
                      .alias("precision"))


# ------------------------------------------------------------------ B5 ----
def threshold_sweep(scored: DataFrame, thresholds: Sequence[float] = THRESHOLDS) -> DataFrame:
    """Per threshold t, rows with score >= t, positives among them,
    precision and recall (0 when undefined).

    One pass: a conditional count and sum per threshold (the list is short
    and fixed), then a ``stack`` unpivot of the single result row.
    """
    ts = sorted(thresholds)
    s, y = F.col(SCORE), F.col(LABEL)
    aggs = [F.sum(y).cast("bigint").alias("pos_total")]
    for i, t in enumerate(ts):
        aggs.append(F.count_if(s >= F.lit(t)).alias(f"n{i}"))
        aggs.append(F.coalesce(F.sum(F.when(s >= F.lit(t), y)), F.lit(0)).cast("bigint").alias(f"p{i}"))
    one = scored.agg(*aggs)
    stack = ", ".join(f"CAST({t!r} AS DOUBLE), n{i}, p{i}" for i, t in enumerate(ts))
    long = one.selectExpr("pos_total", f"stack({len(ts)}, {stack}) AS (threshold, flagged, tp)")
    return long.select("threshold", F.col("flagged").cast("bigint").alias("patients_flagged"),
                       F.col("tp").cast("bigint").alias("true_readmissions"),
                       r6(zero_div(F.col("tp"), F.col("flagged"))).alias("precision"),
                       r6(zero_div(F.col("tp"), F.col("pos_total"))).alias("recall"))


# ------------------------------------------------------------------ B6 ----
def high_risk_profile(featured: DataFrame, scored: DataFrame, *, key: str = "encounter_id",
                      threshold: float = HIGH_RISK_THRESHOLD) -> DataFrame:
    """Profile of flagged encounters: age / gender / primary-diagnosis
    counts and mean stay, medications and procedures.

    Flagged rows are matched by key (left semi join), never by position.
    """
    flagged = scored.filter(F.col(SCORE) >= F.lit(threshold)).select(key)
    rows = featured.join(flagged, key, "left_semi")
    # one pass: each flagged stay becomes six (profile, category, x) rows
    long = rows.select(F.inline(rows_of(
        ("profile", "category", "x"),
        ("age", col("age").cast("string"), F.lit(None).cast("double")),
        ("gender", col("gender").cast("string"), F.lit(None).cast("double")),
        ("diag_1_category", col("diag_1_category").cast("string"), F.lit(None).cast("double")),
        ("mean", F.lit("avg_time_in_hospital"), col("time_in_hospital").cast("double")),
        ("mean", F.lit("avg_num_medications"), col("num_medications").cast("double")),
        ("mean", F.lit("avg_num_procedures"), col("num_procedures").cast("double")))))
    agg = (long.filter(F.col("category").isNotNull()).groupBy("profile", "category")
           .agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("m")))
    value = F.when(F.col("profile") == "mean", F.col("m")).otherwise(F.col("n").cast("double"))
    return agg.select("profile", "category", r6(value).alias("value"))


# ------------------------------------------------------------- B7-B9 ------
def intervention_optimization(sweep: DataFrame, *, readmission_cost: float = READMISSION_COST,
                              intervention_cost: float = INTERVENTION_COST,
                              effectiveness: float = EFFECTIVENESS) -> DataFrame:
    """Cost, prevented, savings, net benefit and ROI per threshold."""
    cost = F.col("patients_flagged") * F.lit(float(intervention_cost))
    prevented = F.col("true_readmissions") * F.lit(effectiveness)
    savings = prevented * F.lit(float(readmission_cost))
    net = savings - cost
    return sweep.select("threshold", "patients_flagged", "true_readmissions",
                        r6(cost).alias("intervention_cost_total"),
                        r6(prevented).alias("prevented_readmissions"),
                        r6(savings).alias("savings_from_prevention"), r6(net).alias("net_benefit"),
                        r6(safe_div(net * 100.0, cost)).alias("roi"))


def optimal_threshold(opt: DataFrame) -> DataFrame:
    """The row with the largest net benefit; lowest threshold on ties."""
    return opt.orderBy(F.desc("net_benefit"), F.asc("threshold")).limit(1)


def scale_to_sizes(optimum: DataFrame, total_patients: DataFrame,
                   sizes: Sequence[tuple[str, int]] = HOSPITAL_SIZES) -> DataFrame:
    """The optimum scaled to hospital sizes; flagged count truncated.

    ``total_patients`` is a one-row DataFrame; both inputs are single rows,
    combined by a one-row union-aggregate instead of a join.
    """
    one = (optimum.select("patients_flagged", "prevented_readmissions", "net_benefit",
                          F.lit(None).cast("bigint").alias("total_patients"))
           .unionByName(total_patients.select(
               F.lit(None).cast("bigint").alias("patients_flagged"),
               F.lit(None).cast("double").alias("prevented_readmissions"),
               F.lit(None).cast("double").alias("net_benefit"), "total_patients"))
           .agg(*[F.max(c).alias(c) for c in ("patients_flagged", "prevented_readmissions",
                                              "net_benefit", "total_patients")]))
    arr = F.array(*[F.struct(F.lit(n).alias("size_name"), F.lit(s).alias("annual_patients"))
                    for n, s in sizes])
    scale = F.col("annual_patients") / F.col("total_patients").cast("double")
    return (one.select("*", F.inline(arr))
            .select("size_name", F.col("annual_patients").cast("bigint").alias("annual_patients"),
                    F.floor(F.col("patients_flagged") * scale).cast("bigint").alias("intervention_patients"),
                    r6(F.col("prevented_readmissions") * scale).alias("prevented_readmissions"),
                    r6(F.col("net_benefit") * scale).alias("net_annual_benefit")))


# ------------------------------------------------------------------ B10 ---
def what_if_grid(sweep: DataFrame, readmission_costs=GRID_READMISSION_COST,
                 intervention_costs=GRID_INTERVENTION_COST,
                 effectiveness=GRID_EFFECTIVENESS) -> DataFrame:
    """Best threshold and its net benefit/ROI for every point of a
    readmission-cost x intervention-cost x effectiveness grid."""
    # three small literal axes, exploded in turn (keeps generated code small)
    rows = (sweep.select("threshold", "patients_flagged", "true_readmissions")
            .withColumn("readmission_cost",
                        F.explode(F.array(*[F.lit(float(r)) for r in readmission_costs])))
            .withColumn("intervention_cost",
                        F.explode(F.array(*[F.lit(float(i)) for i in intervention_costs])))
            .withColumn("effectiveness",
                        F.explode(F.array(*[F.lit(float(e)) for e in effectiveness]))))
    cost = F.col("patients_flagged") * F.col("intervention_cost")
    net = F.col("true_readmissions") * F.col("effectiveness") * F.col("readmission_cost") - cost
    rows = rows.select("*", net.alias("net"), cost.alias("cost"))
    w = Window.partitionBy("readmission_cost", "intervention_cost", "effectiveness").orderBy(
        F.desc("net"), F.asc("threshold"))  # one partition per grid point, len(thresholds) rows
    best = rows.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") == 1)
    return best.select("readmission_cost", "intervention_cost", "effectiveness",
                       F.col("threshold").alias("optimal_threshold"),
                       r6(F.col("net")).alias("net_benefit"),
                       r6(safe_div(F.col("net") * 100.0, F.col("cost"))).alias("roi"))


# ------------------------------------------------------------- B12, B13 ---
def top_fraction_capture(scored: DataFrame, percents: Sequence[int] = TOP_PERCENTS,
                         with_total: bool = False) -> DataFrame:
    """Flag the top p % by score and report the share of positives caught.

    The boundary is the score of the ceil(p% * n)-th ranked row; every row
    tied with it is flagged too (tie-inclusive, deterministic, no row-level
    global sort). Lift = capture rate / flagged share.
    """
    g = score_groups(scored)
    before = F.col("cum_n") - F.col("n")
    total = F.col("pos_total") + F.col("neg_total")
    def rank_of(p):  # ceil(p % of n), in integers
        return F.floor((p.cast("bigint") * total + 99) / 100)

    # the row whose cumulative range (before, cum_n] holds that rank, one per p
    hits = F.filter(F.array(*[F.lit(int(p)) for p in percents]),
                    lambda p: (rank_of(p) > before) & (rank_of(p) <= F.col("cum_n")))
    rows = g.select("*", F.explode(hits).alias("top_percent"))
    return rows.select(
        F.col("top_percent").cast("int").alias("top_percent"),
        F.col("cum_n").cast("bigint").alias("patients_flagged"),
        F.col("cum_pos").cast("bigint").alias("readmissions_captured"),
        r6(safe_div(F.col("cum_pos"), F.col("pos_total"))).alias("capture_rate"),
        r6(safe_div(safe_div(F.col("cum_pos"), F.col("pos_total")), safe_div(F.col("cum_n"), total)))
        .alias("lift"),
        *([total.cast("bigint").alias("n_total")] if with_total else []))


def size_benefits(scored: DataFrame, percent: int = FLAG_PERCENT,
                  sizes: Sequence[tuple[str, int]] = DASHBOARD_SIZES, *,
                  readmission_cost: float = READMISSION_COST,
                  intervention_cost: float = INTERVENTION_COST,
                  effectiveness: float = EFFECTIVENESS) -> DataFrame:
    """Benefit by population size when the top ``percent`` % are flagged,
    using the observed flagged share and captured positives per patient."""
    cap = top_fraction_capture(scored, [percent], with_total=True)
    one = cap.select("patients_flagged", "readmissions_captured", F.col("n_total").alias("n"))
    arr = F.array(*[F.struct(F.lit(n).alias("hospital"), F.lit(s).alias("annual_patients"))
                    for n, s in sizes])
    flagged = F.col("annual_patients") * F.col("patients_flagged") / F.col("n")
    tp = F.col("annual_patients") * F.col("readmissions_captured") / F.col("n")
    cost = flagged * F.lit(float(intervention_cost))
    prevented = tp * F.lit(effectiveness)
    net = prevented * F.lit(float(readmission_cost)) - cost
    return (one.select("*", F.inline(arr))
            .select("hospital", F.col("annual_patients").cast("bigint").alias("annual_patients"),
                    r6(flagged).alias("intervention_patients"),
                    r6(prevented).alias("prevented_readmissions"),
                    r6(net).alias("net_annual_benefit"), r6(safe_div(net * 100.0, cost)).alias("roi")))


# ------------------------------------------------------------------ S11 ---
def kpi_table(costs: DataFrame, optimum: DataFrame) -> DataFrame:
    """Executive-summary KPIs as (section, metric, value) rows."""
    c = costs.select(
        F.lit("problem").alias("s1"), (F.col("readmission_rate") * 100).alias("readmission_rate_pct"),
        F.col("actual_readmissions").cast("double").alias("actual_readmissions"),
        F.col("total_patients").cast("double").alias("total_patients"),
        F.col("scenario_1_cost").alias("total_readmission_cost"),
        F.col("scenario_3_savings").alias("model_savings"), F.col("roi").alias("model_roi_pct"),
        F.col("net_savings_per_patient"), F.col("prevented_readmissions"),
        F.col("cost_per_prevented_readmission"))
    o = optimum.select(F.col("threshold").alias("optimal_threshold"),
                       F.col("net_benefit").alias("optimal_net_benefit"),
                       F.col("roi").alias("optimal_roi_pct"))
    names = ("section", "metric", "value")
    rows_c = c.select(F.inline(rows_of(
        names,
        ("problem", "readmission_rate_pct", F.col("readmission_rate_pct")),
        ("problem", "actual_readmissions", F.col("actual_readmissions")),
        ("problem", "total_patients", F.col("total_patients")),
        ("problem", "total_readmission_cost", F.col("total_readmission_cost")),
        ("financial", "model_savings", F.col("model_savings")),
        ("financial", "model_roi_pct", F.col("model_roi_pct")),
        ("financial", "net_savings_per_patient", F.col("net_savings_per_patient")),
        ("clinical", "prevented_readmissions", F.col("prevented_readmissions")),
        ("clinical", "cost_per_prevented_readmission", F.col("cost_per_prevented_readmission")))))
    rows_o = o.select(F.inline(rows_of(
        names,
        ("threshold", "optimal_threshold", F.col("optimal_threshold")),
        ("threshold", "optimal_net_benefit", F.col("optimal_net_benefit")),
        ("threshold", "optimal_roi_pct", F.col("optimal_roi_pct")))))
    return rows_c.unionByName(rows_o).select("section", "metric", r6(F.col("value")).alias("value"))
