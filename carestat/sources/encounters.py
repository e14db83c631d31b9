"""Encounter table scans (S1), expected-column check."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import values_table
from ..schema import EXPECTED_COLUMNS, encounter_schema


CORRUPT = "_corrupt_line"


def read_encounters_csv(spark: SparkSession, path: str, names: list[str] | None = None) -> DataFrame:
    """Encounter CSV with an explicit schema (no inference; diagnosis codes
    stay text so V/E codes survive). Extra file columns are ignored by name; a value that
    does not fit its type is null. ``names`` are the columns of a file without a header.
    Lines with too few or too many fields are left out; ``malformed_lines`` has them."""
    known = {f.name: f for f in encounter_schema().fields}
    raw = _csv_lines(spark, path, names)
    # Spark reads the aside column only together with another one, also where a query counts rows
    whole = F.col(CORRUPT).isNull() & (F.coalesce(F.length(F.col(f"`{raw.columns[0]}`")), F.lit(0)) >= 0)
    return raw.where(whole).select(*[F.col(f"`{c}`").try_cast(known[c].dataType).alias(c) for c in raw.columns if c in known])


def malformed_lines(spark: SparkSession, path: str, names: list[str] | None = None) -> DataFrame:
    """The lines (one column) that do not have the file's number of fields, kept aside as they are."""
    raw = _csv_lines(spark, path, names)
    return raw.where(F.col(CORRUPT).isNotNull()).select(F.coalesce(F.col(CORRUPT), F.col(f"`{raw.columns[0]}`")).alias("line"))


def _csv_lines(spark: SparkSession, path: str, names: list[str] | None) -> DataFrame:
    header = names is None
    names = names or spark.read.option("header", True).csv(path).columns
    schema = T.StructType([*[T.StructField(n, T.StringType()) for n in names], T.StructField(CORRUPT, T.StringType())])
    # without pruning: whether a line is malformed must not depend on the columns a query reads
    return (spark.read.option("header", header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
            .option("columnPruning", False).schema(schema).csv(path))


def read_encounters_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(encounter_schema()).parquet(path)


def missing_expected_columns(df: DataFrame) -> DataFrame:
    """Expected raw columns absent from ``df`` (plan-time set difference),
    as a one-column DataFrame; empty when all are present."""
    missing = [c for c in EXPECTED_COLUMNS if c not in df.columns]
    if not missing:
        return df.sparkSession.sql("SELECT CAST(NULL AS STRING) AS missing_column WHERE false")
    return values_table(df.sparkSession, [("missing_column", "string")], [(c,) for c in missing])
