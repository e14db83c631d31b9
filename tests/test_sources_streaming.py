"""CSV scan, column check, sinks, model-ready round trip, streaming scorer."""
import os

from pyspark.sql import functions as F

from carestat.plans import tables
from carestat.session import scratch_path
from carestat.sources import encounters as S
from carestat.sources import sinks
from carestat.streaming.scoring import scored_stream, tier_counts
from conftest import SF_SMALL


def test_csv_roundtrip_and_column_check(spark):
    raw = tables.raw(spark, SF_SMALL)
    path = scratch_path(spark, "test_csv_enc")
    sinks.write_table(raw, path, "csv")
    back = S.read_encounters_csv(spark, path)
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in raw.schema]
    assert back.exceptAll(raw).count() == 0 and raw.exceptAll(back).count() == 0
    assert S.missing_expected_columns(back).count() == 0
    assert [r[0] for r in S.missing_expected_columns(back.drop("insulin", "race")).collect()] == \
        ["race", "insulin"]


def test_model_ready_roundtrip(spark):
    from carestat.operators import prepare as M
    fea = tables.featured(spark, SF_SMALL)
    split = M.stratified_split(fea)
    prep = M.fit_preparation(split.filter("split = 'train'"))
    matrix = prep.transform(split).select("encounter_id", F.col("readmitted_30d").alias("label"),
                                          "split", "features")
    path = scratch_path(spark, "test_model_ready")
    sinks.save_model_ready(matrix, path)
    back = sinks.load_model_ready(spark, path)
    assert back.count() == matrix.count()
    assert back.filter("split = 'test'").count() == matrix.filter("split = 'test'").count()
    assert len(prep.feature_names) == matrix.first().features.size


def test_streaming_scores_match_batch(spark):
    src = scratch_path(spark, "test_stream_src")
    raw = tables.raw(spark, SF_SMALL)
    raw.repartition(3).write.mode("overwrite").parquet(src)
    stream = scored_stream(spark, src, max_files=1)
    q = (stream.writeStream.format("memory").queryName("scored_test").outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.table("scored_test")
    assert got.count() == raw.count()
    counts = (tier_counts(scored_stream(spark, src)).writeStream.format("memory")
              .queryName("tiers_test").outputMode("complete").trigger(availableNow=True).start())
    counts.awaitTermination()
    total = spark.table("tiers_test").agg(F.sum("count")).first()[0]
    assert total == raw.count()


def test_streaming_daily_counts_with_watermark(spark):
    from carestat.streaming.scoring import daily_tier_counts
    src = scratch_path(spark, "test_stream_src_daily")
    raw = tables.raw(spark, SF_SMALL)
    # files arrive in event-time order (a feed), so nothing is later than the watermark
    (raw.repartitionByRange(4, "encounter_date").sortWithinPartitions("encounter_date")
     .write.mode("overwrite").parquet(src))
    q = (daily_tier_counts(scored_stream(spark, src, max_files=1)).writeStream.format("memory")
         .queryName("daily_test").outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.table("daily_test")
    # every emitted (day, tier) count equals the batch count for that day
    from carestat.operators.score import risk_tier, with_rule_score
    from carestat.plans import tables as TB
    batch = (with_rule_score(TB.featured(spark, SF_SMALL))
             .groupBy(F.col("encounter_date").alias("day"), risk_tier("rule_score").alias("risk_tier"))
             .count())
    assert got.count() > 0
    assert got.select("day", "risk_tier", "count").exceptAll(batch).count() == 0


def test_csv_lines_with_other_field_counts_are_kept_aside(spark, tmp_path):
    from carestat.sources.encounters import malformed_lines, read_encounters_csv
    path = tmp_path / "enc.csv"
    path.write_text('encounter_id,patient_nbr,race,diag_1,other\n1,5,"a,b",250.83,x\n2,6,c\nbad,7,d,V45,y\n3,8,e,E900,z,more\n4,,,,\n')
    got = {r.encounter_id: r for r in read_encounters_csv(spark, str(path)).collect()}
    assert set(got) == {1, None, 4} and got[1].race == "a,b" and got[1].diag_1 == "250.83" and got[None].patient_nbr == 7
    assert "other" not in read_encounters_csv(spark, str(path)).columns
    assert sorted(r.line for r in malformed_lines(spark, str(path)).collect()) == ["2,6,c", "3,8,e,E900,z,more"]
    # the columns that a query reads do not change what is malformed
    assert read_encounters_csv(spark, str(path)).select("race").count() == 3
