"""Running totals, exact quantiles and unrounded ranking metrics."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from carestat.operators import metrics as E
from carestat.operators import profile as P
from carestat.operators import ranks as R
from carestat.operators import verify as V


@pytest.fixture
def many_parts(spark):
    """No merging of small partitions, so that totals really cross partitions."""
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_cross_partitions(many_parts, descending):
    rng = np.random.default_rng(1)
    rows = [(k, float(v), int(rng.integers(0, 9))) for k in ("a", "b", None) for v in range(300)] + [("a", None, 5), ("solo", 1.0, 2)]
    df = many_parts.createDataFrame(rows, "k string, v double, n long").repartition(7)
    got = {(r.k, r.v): (r.cum_n, r.total_n) for r in R.running_totals(df, "v", ["n"], ["k"], descending).collect()}
    assert len(got) == len(rows)
    for key in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is None, 0 if r[1] is None else -r[1] if descending else r[1]))
        total = sum(r[2] for r in own)
        for r, cum in zip(own, np.cumsum([r[2] for r in own])):
            assert got[key, r[1]] == (cum, total)


def test_running_totals_of_nothing(spark):
    assert R.running_totals(spark.createDataFrame([], "v double, n long"), "v", ["n"]).count() == 0


def test_quantiles_match_numpy(many_parts):
    rng = np.random.default_rng(2)
    data = {"normal": rng.normal(size=501), "ties": rng.integers(0, 4, 200).astype(float), "wide": 10.0 ** rng.integers(-200, 200, 77), "one": np.array([3.5])}
    df = many_parts.createDataFrame([(k, float(v)) for k, vs in data.items() for v in vs] + [("normal", None), ("none", None)], "k string, v double")
    probs = {"low": 0.0, "q1": 0.25, "mid": 0.5, "q9": 0.9, "top": 1.0}
    got = {r.k: r for r in R.quantiles(R.value_counts(df, "v", ["k"]), "v", ["k"], probs).collect()}
    assert set(got) == set(data)
    for k, vs in data.items():
        assert got[k].n == len(vs)
        for name, p in probs.items():
            assert got[k][name] == pytest.approx(np.quantile(vs, p), rel=1e-12)


def test_scores_apart_in_the_ninth_place_rank_apart(spark):
    rows = [(1, 0.5000000002), (0, 0.5000000001), (1, 0.25), (0, 0.1)]
    scored = E.scored_view(spark.createDataFrame(rows, "y int, s double"), "y", "s")
    assert E.roc_points(scored).count() == 4
    assert E.ranking_metrics(scored).first().roc_auc == 0.75
    swapped = E.scored_view(spark.createDataFrame([(1 - y if s > 0.4 else y, s) for y, s in rows], "y int, s double"), "y", "s")
    assert E.ranking_metrics(swapped).first().roc_auc == 0.5


def test_no_window_over_all_scores(spark):
    """No window of the scores runs in one partition, and the quantiles hold no map of values."""
    scored = E.scored_view(spark.range(1000).select((F.col("id") % 2).alias("y"), F.rand(1).alias("s")), "y", "s")
    for df in (E.roc_points(scored), P.box_summary(spark.range(99).selectExpr("cast(id % 3 as string) as readmitted", "id as time_in_hospital"), ["time_in_hospital"])):
        plan = df._jdf.queryExecution().toString()
        assert "percentile" not in plan
        lines = plan.split("== Physical Plan ==")[1].splitlines()
        # what meets in one partition is a row a partition
        assert all("keys=[__part" in after for line, after in zip(lines, lines[1:]) if "SinglePartition" in line)


def test_figures_of_predictions_agree(spark):
    rng = np.random.default_rng(3)
    rows = [(int(y), float(np.clip(rng.normal(0.4 + 0.2 * y, 0.2), 0, 1).round(2))) for y in rng.integers(0, 2, 800)]
    df = spark.createDataFrame(rows, "label int, score double").repartition(5)
    mine, theirs = V.prediction_figures(df).first(), E.model_metrics(E.scored_view(df, "label", "score"), "m").first()
    for c in ("accuracy", "precision", "recall", "f1", "roc_auc"):
        assert mine[c] == pytest.approx(theirs[c], abs=1e-6)
    assert (mine.rows, mine.positives, mine.outside) == (800, sum(y for y, _ in rows), 0)
