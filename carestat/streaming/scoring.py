"""Structured Streaming: score encounter files as they arrive.

The batch operators are reused unchanged on a streaming DataFrame: cleaning
and features are projections, the code decode is a stream-static join with
the broadcast code dimension, and the tier counts are a streaming
aggregation whose state is one row per tier.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import clean
from ..operators.features import features
from ..operators.score import risk_tier, with_rule_score
from ..schema import encounter_schema
from ..sources.codes import code_dimension


def scored_stream(spark: SparkSession, source_dir: str, *, max_files: int = 16) -> DataFrame:
    """Streaming (encounter_id, encounter_date, rule_score, risk_tier) from parquet files."""
    src = (spark.readStream.schema(encounter_schema())
           .option("maxFilesPerTrigger", max_files).parquet(source_dir))
    fea = features(clean(src, code_dimension(spark), codes_bounded=True))
    scored = with_rule_score(fea)
    return scored.select("encounter_id", "encounter_date", F.round("rule_score", 9).alias("rule_score"),
                         risk_tier("rule_score").alias("risk_tier"))


def tier_counts(scored: DataFrame) -> DataFrame:
    """Running population per tier (complete-mode state: one row per tier)."""
    return scored.groupBy("risk_tier").agg(F.count(F.lit(1)).alias("count"),
                                           F.avg("rule_score").alias("mean_score"))


def start_scoring(spark: SparkSession, source_dir: str, out_dir: str, checkpoint_dir: str):
    """Append scored rows to parquet under ``out_dir`` (exactly-once via the
    checkpoint in the shared folder); returns the running query."""
    return (scored_stream(spark, source_dir).writeStream.format("parquet")
            .option("path", out_dir).option("checkpointLocation", checkpoint_dir)
            .outputMode("append").trigger(availableNow=True).start())


def daily_tier_counts(scored: DataFrame, *, watermark: str = "30 days") -> DataFrame:
    """Per admission day and tier: stays and mean score, emitted in append
    mode once the watermark passes the day (bounded state: open days only)."""
    ts = F.col("encounter_date").cast("timestamp")
    return (scored.withColumn("event_time", ts)
            .withWatermark("event_time", watermark)
            .groupBy(F.window("event_time", "1 day").alias("day"), "risk_tier")
            .agg(F.count(F.lit(1)).alias("count"), F.avg("rule_score").alias("mean_score"))
            .select(F.col("day.start").cast("date").alias("day"), "risk_tier", "count",
                    "mean_score"))
