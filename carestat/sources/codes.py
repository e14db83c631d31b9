"""Code dimension: built-in lists, code-list CSV scan and its shape handling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import values_table
from ..schema import CATEGORY_MARKERS, CODE_LISTS, CODE_SCHEMA, FALLBACK_CODE_LISTS

# A code dimension larger than this is not broadcast (see ``is_small``).
BROADCAST_ROW_LIMIT = 100_000


def _null_text(desc: str | None) -> str | None:
    return None if desc is None or desc == "NULL" else desc


def code_dimension(spark: SparkSession, lists: dict | None = None) -> DataFrame:
    """(category, id, description): the three built-in code lists, unioned.

    The literal text "NULL" is a missing description.
    """
    lists = lists or CODE_LISTS
    rows = [(cat, int(i), _null_text(d)) for cat, lst in lists.items() for i, d in lst]
    return values_table(spark, [("category", "string"), ("id", "int"), ("description", "string")],
                        rows)


def read_code_list(spark: SparkSession, path: str) -> DataFrame:
    """Code-list CSV scan; header decides the shape (see ``normalize_code_list``)."""
    raw = spark.read.option("header", True).option("nullValue", "NULL").csv(path)
    return normalize_code_list(spark, raw)


def normalize_code_list(spark: SparkSession, raw: DataFrame) -> DataFrame:
    """Bring any accepted code-list shape to (category, id, description).

    * with a ``category`` column: used as is;
    * with only ``id``/``description``: the category is derived from a
      case-insensitive marker inside the description;
    * with neither: the short fallback lists.
    Duplicate (category, id) pairs keep the last row of the file.
    """
    cols = set(raw.columns)
    if "category" in cols:
        df = raw.select("category", "id", "description")
    elif {"id", "description"} <= cols:
        desc = F.lower(F.col("description"))
        parts = [raw.filter(desc.contains(marker)).select(
                     F.lit(cat).alias("category"), "id", "description")
                 for cat, marker in CATEGORY_MARKERS.items()]
        df = parts[0].unionByName(parts[1]).unionByName(parts[2])
    else:
        return code_dimension(spark, FALLBACK_CODE_LISTS)
    df = df.select(
        F.col("category").cast("string").alias("category"),
        F.col("id").try_cast("int").alias("id"),
        F.when(F.col("description") != "NULL", F.col("description")).alias("description"),
        F.monotonically_increasing_id().alias("_row"),
    ).filter(F.col("id").isNotNull())
    return (df.groupBy("category", "id")
            .agg(F.max_by("description", "_row").alias("description"))
            .select(CODE_SCHEMA.fieldNames()))


def category_codes(codes: DataFrame, category: str) -> DataFrame:
    """Per-category split of the code list: (id, description)."""
    return codes.filter(F.col("category") == category).select("id", "description")


def is_small(df: DataFrame, limit: int = BROADCAST_ROW_LIMIT) -> bool:
    """Bounded-cost size proof: reads at most ``limit + 1`` rows."""
    return df.limit(limit + 1).count() <= limit
