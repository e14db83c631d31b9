"""Table sinks (S8), model-ready data (S9) and the executive summary.

All writers go through the DataFrame writer to a path the caller chooses
(on a cluster: a shared folder); nothing is written to a machine-local
temporary folder here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, fmt: str = "parquet", *, partition_by=None) -> str:
    """Overwrite a table (parquet by default, csv with a header)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)
    return path


def save_model_ready(matrix: DataFrame, path: str) -> str:
    """(key, label, split, features) persisted as parquet, split-partitioned."""
    return write_table(matrix, path, partition_by=["split"])


def load_model_ready(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def summary_lines(kpis: DataFrame, sizes: DataFrame) -> DataFrame:
    """The executive summary as text lines (one ``value`` column), built
    from the KPI rows and the hospital-size table; write with ``write.text``."""
    k = kpis.select(F.concat_ws(" | ", F.col("section"), F.col("metric"),
                                F.format_number(F.col("value"), 2)).alias("value"))
    s = sizes.select(F.concat_ws(" | ", F.lit("size"), F.col("size_name"),
                                 F.format_number(F.col("annual_patients"), 0),
                                 F.format_number(F.col("intervention_patients"), 0),
                                 F.format_number(F.col("prevented_readmissions"), 1),
                                 F.format_number(F.col("net_annual_benefit"), 2)).alias("value"))
    return k.unionByName(s)


def write_summary(lines: DataFrame, path: str) -> str:
    lines.coalesce(1).write.mode("overwrite").text(path)  # a handful of summary lines
    return path
