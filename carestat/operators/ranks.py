"""Running totals and exact quantiles over ordered values, without one task that sees them all.

The rows are range-partitioned by the order and written (checkpoint), each
partition's totals are added up, and the offset of a partition is joined back to
the running totals inside it. What meets in one place is a row per partition and
key, never the values. So nothing has to be rounded to make it fit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import col
from ..session import ensure_checkpoint_dir


def running_totals(df: DataFrame, order: str, sums: Sequence[str], keys: Sequence[str] = (), descending: bool = False) -> DataFrame:
    """``df`` with cum_<c> (up to and with the row, in the order within its key) and total_<c> (of the key)
    for each of ``sums``. One row per key and order value; a null value comes last."""
    ensure_checkpoint_dir(df.sparkSession)
    by = F.desc_nulls_last(order) if descending else F.asc_nulls_last(order)
    keys = list(keys)
    part = (df.repartitionByRange(*[col(k) for k in keys], by).withColumn("__part", F.spark_partition_id()).checkpoint())
    totals = part.groupBy("__part", *[col(k) for k in keys]).agg(*[F.sum(c).alias(f"__sum_{c}") for c in sums])
    same = [col(k) for k in keys] or [F.lit(0)]  # a row a partition meets under one key
    before = Window.partitionBy(*same).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("__part").alias("__at"), *[col(k).alias(f"__key_{i}") for i, k in enumerate(keys)],
                            *[F.coalesce(F.sum(f"__sum_{c}").over(before), F.lit(0)).alias(f"__off_{c}") for c in sums],
                            *[F.sum(f"__sum_{c}").over(Window.partitionBy(*same)).alias(f"total_{c}") for c in sums])
    met = F.col("__part") == F.col("__at")
    for i, k in enumerate(keys):
        met &= col(k).eqNullSafe(F.col(f"__key_{i}"))
    inside = Window.partitionBy("__part", *[col(k) for k in keys]).orderBy(by).rowsBetween(Window.unboundedPreceding, 0)
    out = part.join(offsets, met).withColumns({f"cum_{c}": F.col(f"__off_{c}") + F.sum(c).over(inside) for c in sums})
    return out.drop("__part", "__at", *[f"__key_{i}" for i in range(len(keys))], *[f"__off_{c}" for c in sums])


def value_counts(df: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    """(keys, value, n, cum_n, total_n) of the non-null values: combined map-side before they are ranked."""
    counts = df.where(col(value).isNotNull()).groupBy(*[col(k) for k in keys], col(value)).agg(F.count(F.lit(1)).alias("n"))
    return running_totals(counts, value, ["n"], keys)


def quantiles(counts: DataFrame, value: str, keys: Sequence[str], probabilities: dict[str, float]) -> DataFrame:
    """One row per key of ``value_counts``: a column per named probability, linear between the two
    neighbouring ranks, exact."""
    low, aggs = F.col("cum_n") - F.col("n"), []
    for name, p in probabilities.items():
        at = F.lit(float(p)) * (F.col("total_n") - 1)
        for side, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            aggs.append(F.max(F.when((low <= rank) & (rank < F.col("cum_n")), col(value))).alias(f"__{side}_{name}"))
        aggs.append(F.max(at - F.floor(at)).alias(f"__w_{name}"))
    found = counts.groupBy(*[col(k) for k in keys]).agg(*aggs, F.max("total_n").alias("n"))
    return found.select(*[col(k) for k in keys], "n", *[
        (F.col(f"__lo_{c}") * (1 - F.col(f"__w_{c}")) + F.col(f"__hi_{c}") * F.col(f"__w_{c}")).alias(c) for c in probabilities])
