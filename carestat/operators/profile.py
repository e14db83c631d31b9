"""Profiling and exploratory aggregation.

Every operator is one or two aggregations. Multi-column profiles unpivot
first and aggregate once (Expand + partial aggregation), so one scan serves
all columns and only per-group partial states are shuffled. Windows used
here run over aggregated groups (bounded by the number of distinct
categories), never over encounter rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import (bin_left_closed, col, corr_from_parts, corr_parts, r6, safe_div,
                                 values_table)
from .ranks import quantiles, value_counts
from ..schema import MEDICATIONS

LABEL = "readmitted_30d"

# --- fixed values: exploratory column choices ------------------------------
RATE_COLUMNS = ["gender", "age", "race", "time_in_hospital", "admission_type_id",
                "discharge_disposition_id", "admission_source_id", "diag_1_category",
                "insulin", "A1Cresult", "max_glu_serum"]
DEMOGRAPHIC_COLUMNS = ["age", "gender", "race"]
CLINICAL_CATEGORICAL_COLUMNS = ["A1Cresult", "max_glu_serum"]
BOX_COLUMNS = ["num_lab_procedures", "num_procedures", "num_medications", "number_diagnoses"]
USED_STATUSES = ["Steady", "Up", "Down"]
TREND_CUTOFF = 0.05

# Lower edges of the left-closed bins of the clinical numeric columns; the last bin is open.
CLINICAL_EDGES = {
    "time_in_hospital": [0, 3, 6, 9, 12, 15, 18, 21, 24, 27],
    "num_lab_procedures": [0, 20, 40, 60, 80, 100],
    "num_procedures": [0, 1, 2, 3, 4, 5, 6],
    "num_medications": [0, 5, 10, 15, 20, 25],
    "number_diagnoses": [0, 1, 2, 3, 4, 5, 6, 7, 8, 9],
}
INF = float("inf")


def _bin_label(low: int, high: float) -> str:
    if high == INF:
        return f"{low}+"
    return str(low) if high == low + 1 else f"{low}-{high - 1}"


# (variable, edges, labels)
CLINICAL_BINS = [(name, [*low, INF], [_bin_label(a, b) for a, b in zip(low, [*low[1:], INF])])
                 for name, low in CLINICAL_EDGES.items()]


def _present(df: DataFrame, cols: Sequence[str]) -> list[str]:
    return [c for c in cols if c in df.columns]


# ---------------------------------------------------------------- P1, P2 --
def shape(df: DataFrame) -> DataFrame:
    """Row and column count."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns)).cast("bigint"))


def missing_profile(df: DataFrame) -> DataFrame:
    """NULL count and share per column (only columns with any), desc.

    One pass: one ``count_if`` per column, then an unpivot of the single
    result row.
    """
    cols = [c for c in df.columns]
    one = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(col(c).isNull()).alias(c) for c in cols])
    long = one.unpivot(["__n"], [col(c) for c in cols], "column_name", "missing_count")
    return (long.filter(F.col("missing_count") > 0)
            .select("column_name", F.col("missing_count").cast("bigint").alias("missing_count"),
                    r6(safe_div(F.col("missing_count") * 100, F.col("__n"))).alias("missing_pct"))
            .orderBy(F.desc("missing_count"), "column_name"))


# ---------------------------------------------------------------- P3, P4 --
def value_distribution(df: DataFrame, column: str, *, order_by_key: bool = False) -> DataFrame:
    """Count per non-NULL value and its share of the non-NULL rows."""
    counts = (df.filter(col(column).isNotNull()).groupBy(col(column).alias("value"))
              .agg(F.count(F.lit(1)).alias("count")))
    total = F.sum("count").over(Window.partitionBy())  # over distinct values only
    out = counts.select(F.col("value").cast("string").alias("value"), "count",
                        r6(F.col("count") / total).alias("share"))
    return out.orderBy("value") if order_by_key else out.orderBy(F.desc("count"), "value")


# ---------------------------------------------------------------- P5, P6 --
def rate_by_category(df: DataFrame, column: str, *, label: str = LABEL,
                     percent: bool = False, rate_name: str = "readmission_rate_30d") -> DataFrame:
    """Return rate and size per category (NULL category dropped), rate desc."""
    scale = 100.0 if percent else 1.0
    return (df.filter(col(column).isNotNull())
            .groupBy(col(column).alias(column))
            .agg(r6(F.avg(col(label)) * scale).alias(rate_name),
                 F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc(rate_name), column))


def rate_by_category_join(df: DataFrame, column: str, *, label: str = LABEL) -> DataFrame:
    """P5 in its join form: rates and value counts computed apart, inner equi-join."""
    base = df.filter(col(column).isNotNull())
    rates = base.groupBy(col(column).alias(column)).agg(
        r6(F.avg(col(label))).alias("readmission_rate_30d"))
    counts = base.groupBy(col(column).alias(column)).agg(F.count(F.lit(1)).alias("count"))
    return rates.join(counts, column, "inner").orderBy(F.desc("readmission_rate_30d"), column)


def rates_by_categories(df: DataFrame, columns: Sequence[str], *, label: str = LABEL,
                        percent: bool = False, rate_name: str = "readmission_rate_30d") -> DataFrame:
    """Long form of P5/P6 for many columns: one scan, one aggregation.

    (variable, category, rate, count); values are compared as text.
    """
    cols = _present(df, columns)
    scale = 100.0 if percent else 1.0
    narrow = df.select(col(label).alias("__y"), *[col(c).cast("string").alias(c) for c in cols])
    long = narrow.unpivot(["__y"], cols, "variable", "category")
    return (long.filter(F.col("category").isNotNull())
            .groupBy("variable", "category")
            .agg(r6(F.avg("__y") * scale).alias(rate_name), F.count(F.lit(1)).alias("count")))


# -------------------------------------------------------------------- P7 --
def extreme_groups(df: DataFrame, columns: Sequence[str], *, label: str = LABEL) -> DataFrame:
    """Highest and lowest rate group per variable, their ratio, overall rate.

    Ties: the alphabetically first category wins on both ends.
    """
    cols = _present(df, columns)
    with_all = df.withColumn("__overall", F.lit("all"))
    rates = rates_by_categories(with_all, [*cols, "__overall"], label=label, percent=True,
                                rate_name="rate")
    # the rates table has one row per category: windows over it are tiny
    overall = F.max(F.when(F.col("variable") == "__overall", F.col("rate"))).over(Window.partitionBy())
    w = Window.partitionBy("variable")
    hi = F.row_number().over(w.orderBy(F.desc("rate"), "category"))
    lo = F.row_number().over(w.orderBy(F.asc("rate"), "category"))
    ranked = rates.select("*", hi.alias("hi"), lo.alias("lo"), overall.alias("overall_rate"))
    ext = ranked.filter(F.col("variable") != "__overall").groupBy("variable").agg(
        F.max(F.when(F.col("hi") == 1, F.col("category"))).alias("highest_category"),
        F.max(F.when(F.col("hi") == 1, F.col("rate"))).alias("highest_rate"),
        F.max(F.when(F.col("lo") == 1, F.col("category"))).alias("lowest_category"),
        F.max(F.when(F.col("lo") == 1, F.col("rate"))).alias("lowest_rate"),
        F.max("overall_rate").alias("overall_rate"))
    return ext.select("variable", "highest_category", "highest_rate", "lowest_category",
                      "lowest_rate",
                      r6(safe_div(F.col("highest_rate"), F.col("lowest_rate"))).alias("rate_ratio"),
                      "overall_rate")


# -------------------------------------------------------------------- P8 --
def bin_dimension(spark: SparkSession, spec=CLINICAL_BINS) -> DataFrame:
    rows = [(v, i, lab) for v, _, labels in spec for i, lab in enumerate(labels)]
    return values_table(spark, [("variable", "string"), ("bin_order", "int"), ("bin", "string")], rows)


def binned_rates(df: DataFrame, spec=CLINICAL_BINS, *, label: str = LABEL) -> DataFrame:
    """Rate (percent) per left-closed bin; empty bins kept with count 0."""
    spark = df.sparkSession
    spec = [s for s in spec if s[0] in df.columns]
    names = [v for v, _, _ in spec]
    narrow = df.select(col(label).alias("__y"),
                       *[bin_left_closed(col(v), edges).alias(v) for v, edges, _ in spec])
    agg = (narrow.unpivot(["__y"], names, "variable", "bin_order")
           .filter(F.col("bin_order").isNotNull())
           .groupBy("variable", "bin_order")
           .agg(r6(F.avg("__y") * 100.0).alias("readmission_rate"),
                F.count(F.lit(1)).alias("n")))
    # agg has at most one row per declared bin: a proven, tiny size
    out = bin_dimension(spark, spec).join(F.broadcast(agg), ["variable", "bin_order"], "left")
    return out.select("variable", "bin_order", "bin", "readmission_rate",
                      F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("count"))


# ---------------------------------------------------------- P9-P11 corr --
def correlations(df: DataFrame, columns: Sequence[str], *, target: str = LABEL,
                 include_target: bool = False) -> DataFrame:
    """Pearson correlation of each column with the target, desc,
    NULL (constant column) last. One aggregation pass for all columns."""
    cols = _present(df, columns)
    if include_target and target not in cols:
        cols = cols + [target]
    parts = []
    for i, c in enumerate(cols):
        parts += corr_parts(col(c), col(target), f"c{i}")
    one = df.agg(*parts)
    vals = one.select(*[corr_from_parts(f"c{i}").alias(f"c{i}") for i in range(len(cols))])
    stack = ", ".join(f"'{c}', c{i}" for i, c in enumerate(cols))
    long = vals.selectExpr(f"stack({len(cols)}, {stack}) AS (feature, correlation)")
    return (long.select("feature", r6(F.col("correlation")).alias("correlation"))
            .orderBy(F.desc_nulls_last("correlation"), "feature"))


def correlation_trend(df: DataFrame, columns: Sequence[str], *, target: str = LABEL) -> DataFrame:
    """Correlation plus trend label (Positive > .05, Negative < -.05)."""
    c = correlations(df, columns, target=target)
    trend = (F.when(F.col("correlation") > TREND_CUTOFF, F.lit("Positive"))
             .when(F.col("correlation") < -TREND_CUTOFF, F.lit("Negative"))
             .otherwise(F.lit("No strong correlation")))
    return c.withColumn("trend", trend)


# --------------------------------------------------------------- P12, P13 --
def medication_usage(df: DataFrame, meds: Sequence[str] = MEDICATIONS) -> DataFrame:
    """Share (percent) of all rows with status Steady/Up/Down, desc."""
    meds = _present(df, meds)
    one = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(col(m).isin(*USED_STATUSES)).alias(m) for m in meds])
    long = one.unpivot(["__n"], [col(m) for m in meds], "medication", "n_used")
    return (long.select("medication",
                        r6(safe_div(F.col("n_used"), F.col("__n")) * 100.0).alias("usage_pct"))
            .orderBy(F.desc("usage_pct"), "medication"))


def medication_rate_difference(df: DataFrame, meds: Sequence[str] = MEDICATIONS,
                               *, label: str = LABEL) -> DataFrame:
    """Unweighted mean rate of the used statuses minus the 'No' rate.

    NULL when a medication has no 'No' group or no used group.
    """
    rates = rates_by_categories(df, meds, label=label, percent=True, rate_name="rate")
    agg = rates.groupBy(F.col("variable").alias("medication")).agg(
        F.max(F.when(F.col("category") == "No", F.col("rate"))).alias("no_rate"),
        F.avg(F.when(F.col("category") != "No", F.col("rate"))).alias("used_rate"))
    diff = F.col("used_rate") - F.col("no_rate")
    return agg.select(
        "medication", "no_rate", r6(F.col("used_rate")).alias("used_rate"),
        r6(diff).alias("rate_diff"),
        F.when(diff > 0, F.lit("positive")).when(diff.isNotNull(), F.lit("negative"))
        .alias("direction"))


# -------------------------------------------------------------------- P14 --
def box_summary(df: DataFrame, columns: Sequence[str] = BOX_COLUMNS,
                by: str = "readmitted") -> DataFrame:
    """Quartiles (linear interpolation), 1.5 IQR whiskers and outlier count
    per (variable, group). One pass over the rows counts the distinct values, which
    are ranked in range partitions; quartiles, whiskers and outliers come from
    the counts."""
    cols = _present(df, columns)
    narrow = df.select(col(by).alias("group"), *[col(c).cast("double").alias(c) for c in cols])
    long = narrow.unpivot(["group"], cols, "variable", "x").filter(F.col("group").isNotNull())
    keys = ["variable", "group"]
    counts = value_counts(long, "x", keys)
    q = quantiles(counts, "x", keys, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    iqr = F.col("q3") - F.col("q1")
    q = q.withColumns({"lo_fence": F.col("q1") - 1.5 * iqr, "hi_fence": F.col("q3") + 1.5 * iqr}).drop("n")
    joined = counts.join(q, keys)
    inside = (F.col("x") >= F.col("lo_fence")) & (F.col("x") <= F.col("hi_fence"))
    # the quartiles are constant per group: carried through the aggregation
    w = joined.groupBy("variable", "group").agg(
        F.max("total_n").alias("n"), F.max("q1").alias("q1"), F.max("median").alias("median"),
        F.max("q3").alias("q3"),
        F.min(F.when(inside, F.col("x"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("x"))).alias("whisker_high"),
        F.sum(F.when(inside, 0).otherwise(F.col("n"))).alias("n_outliers"))
    return w.select("variable", "group", F.col("n").cast("bigint").alias("n"),
                    r6(F.col("q1")).alias("q1"), r6(F.col("median")).alias("median"),
                    r6(F.col("q3")).alias("q3"), r6(F.col("whisker_low")).alias("whisker_low"),
                    r6(F.col("whisker_high")).alias("whisker_high"),
                    F.col("n_outliers").cast("bigint").alias("n_outliers"))


# -------------------------------------------------------------------- P15 --
def top_k(df: DataFrame, value: str, key: str, k: int, readout: str) -> DataFrame:
    """The k largest ``value`` rows (NULL last, ties by key) as
    (readout, rank, key, value)."""
    top = df.orderBy(F.desc_nulls_last(value), F.asc(key)).limit(k)
    w = Window.orderBy(F.desc_nulls_last(value), F.asc(key))  # over k rows only
    return top.select(F.lit(readout).alias("readout"), F.row_number().over(w).alias("rank"),
                      F.col(key).cast("string").alias("key"), F.col(value).cast("double").alias("value"))


# -------------------------------------------------------------------- P16 --
def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-NULL values per column (pick lists)."""
    cols = _present(df, columns)
    narrow = df.select(*[col(c).cast("string").alias(c) for c in cols])
    return (narrow.unpivot([], cols, "variable", "value")
            .filter(F.col("value").isNotNull()).distinct())


# -------------------------------------------------------------------- P17 --
def class_counts(df: DataFrame, *, split: str = "split", label: str = LABEL) -> DataFrame:
    """Rows per (split, class)."""
    return df.groupBy(split, col(label).alias("label")).agg(F.count(F.lit(1)).alias("count"))


# --------------------------------------------------------------- P18, P19 --
def band_comparisons(df: DataFrame, *, label: str = LABEL) -> DataFrame:
    """Rate (percent) in contrasting bands: long vs short stay, many vs
    few medications, many vs few diagnoses, age 70-80 vs under 40."""
    bands = {
        "stay_gt7": col("time_in_hospital") > 7,
        "stay_lt3": col("time_in_hospital") < 3,
        "meds_gt15": col("num_medications") > 15,
        "meds_lt5": col("num_medications") < 5,
        "dx_8plus": col("number_diagnoses") >= 8,
        "dx_1to2": col("number_diagnoses").between(1, 2),
        "age_70to80": col("age") == "[70-80)",
        "age_lt40": col("age").isin("[0-10)", "[10-20)", "[20-30)", "[30-40)"),
    }
    aggs = []
    for name, cond in bands.items():
        aggs.append(F.count_if(cond).alias(f"{name}__n"))
        aggs.append(F.sum(F.when(cond, col(label))).alias(f"{name}__y"))
    one = df.agg(*aggs)
    stack = ", ".join(f"'{b}', {b}__n, {b}__y" for b in bands)
    long = one.selectExpr(f"stack({len(bands)}, {stack}) AS (band, n, y)")
    return long.select("band", F.col("n").cast("bigint").alias("count"),
                       r6(safe_div(F.col("y") * 100.0, F.col("n"))).alias("readmission_rate"))


def comorbidity_lift(df: DataFrame, *, label: str = LABEL,
                     flag: str = "circulatory_respiratory_comorbidity") -> DataFrame:
    """Rate among circulatory+respiratory stays / overall rate - 1."""
    one = df.agg(F.count_if(col(flag) == 1).alias("n_comorbid"),
                 F.avg(F.when(col(flag) == 1, col(label))).alias("comorbid_rate"),
                 F.avg(col(label)).alias("overall_rate"))
    return one.select(F.col("n_comorbid").cast("bigint").alias("n_comorbid"),
                      r6(F.col("comorbid_rate")).alias("comorbid_rate"),
                      r6(F.col("overall_rate")).alias("overall_rate"),
                      r6(safe_div(F.col("comorbid_rate"), F.col("overall_rate")) - 1.0).alias("lift"))
