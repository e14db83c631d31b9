"""Split exactness, SMOTE properties, model smoke tests."""
import hashlib

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from carestat.operators import prepare as M
from carestat.operators import train as T
from carestat.operators.smote import smote


def test_quotas_match_published_split():
    # 101,766 rows with 11,357 positives -> 20,354 test rows, 2,271 positives
    q = M.split_quotas({0: 101766 - 11357, 1: 11357}, 0.2)
    assert q[1] == 2271 and q[0] + q[1] == 20354


def test_kth_smallest_multilevel_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(M, "FINAL_BUCKET_ROWS", 50)
    monkeypatch.setattr(M, "PREFIX_DIGITS", 1)
    ids = list(range(1, 3001))
    df = spark.createDataFrame([(i,) for i in ids], "id long").withColumn(
        "h", F.md5(F.concat(F.lit("42-"), F.col("id").cast("string"))))
    brute = sorted((hashlib.md5(f"42-{i}".encode()).hexdigest(), i) for i in ids)
    for k in (1, 17, 1500, 3000):
        assert M.kth_smallest(df, "h", "id", k, len(ids)) == brute[k - 1]


def test_split_exact_per_class(spark, monkeypatch):
    monkeypatch.setattr(M, "FINAL_BUCKET_ROWS", 40)
    rows = [(i, 1 if i % 7 == 0 else 0) for i in range(1, 1001)]
    df = spark.createDataFrame(rows, "encounter_id long, readmitted_30d int")
    out = M.stratified_split(df)
    counts = {(r.split, r.readmitted_30d): r["count"] for r in
              out.groupBy("split", "readmitted_30d").count().collect()}
    q = M.split_quotas({0: 858, 1: 142}, 0.2)
    assert counts[("test", 1)] == q[1] and counts[("test", 0)] == q[0]
    assert out.count() == 1000 and out.select("encounter_id").distinct().count() == 1000
    # brute force: first q rows of each class in md5 order are test
    for cls in (0, 1):
        ids = sorted((hashlib.md5(f"42-{i}".encode()).hexdigest(), i) for i, y in rows if y == cls)
        want = {i for _, i in ids[:q[cls]]}
        got = {r.encounter_id for r in out.filter(f"split = 'test' AND readmitted_30d = {cls}").collect()}
        assert got == want


def _toy_matrix(spark, n_pos=12, n_neg=40, dup=0):
    rows = []
    for i in range(n_neg):
        rows.append((i, 0, Vectors.dense([float(i % 5), float(i % 3)]), "train"))
    for j in range(n_pos):
        rows.append((1000 + j, 1, Vectors.dense([10.0 + (j % 4), 10.0 + (j % 3)]), "train"))
    for d in range(dup):
        rows.append((5000 + d, 1, Vectors.dense([10.0, 10.0]), "train"))
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql import types as Ty
    schema = Ty.StructType([Ty.StructField("encounter_id", Ty.LongType()),
                            Ty.StructField("label", Ty.IntegerType()),
                            Ty.StructField("features", VectorUDT()),
                            Ty.StructField("split", Ty.StringType())])
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("dup", [0, 9])
def test_smote_equalises_and_interpolates(spark, dup):
    m = _toy_matrix(spark, dup=dup)
    out = smote(m)
    counts = {r.label: r["count"] for r in out.groupBy("label").count().collect()}
    assert counts[0] == counts[1] == 40
    syn = out.filter(F.col("encounter_id").isNull()).collect()
    assert len(syn) == 40 - 12 - dup
    for r in syn:  # inside the minority bounding box
        x, y = r.features.toArray()
        assert 10.0 <= x <= 13.0 and 10.0 <= y <= 12.0
    again = smote(m).filter(F.col("encounter_id").isNull())
    assert sorted(tuple(r.features.toArray()) for r in again.collect()) == \
        sorted(tuple(r.features.toArray()) for r in syn)


def test_model_fit_save_load(spark, tmp_path):
    m = _toy_matrix(spark)
    factory, scheme, _ = T.model_suite({"trees": 5, "iters": 3, "max_iter": 50})["Logistic Regression"]
    model = T.fit(m, factory, scheme)
    pred = T.predict(model, m)
    probs = [r.score for r in pred.collect()]
    assert all(0.0 <= p <= 1.0 for p in probs)
    T.save_model(model, str(tmp_path / "lr"))
    again = T.load_first([str(tmp_path / "missing"), str(tmp_path / "lr")])
    assert [r.score for r in T.predict(again, m).collect()] == pytest.approx(probs)
    w = {r.label: r.balanced_weight for r in T.class_weights(m).collect()}
    assert w[1] == pytest.approx(52 / 24, abs=1e-6)


def test_linear_contributions_sum_to_margin(spark):
    from carestat.operators.explain import linear_contributions
    m = _toy_matrix(spark)
    factory, scheme, _ = T.model_suite({"max_iter": 50})["Logistic Regression"]
    model = T.fit(m, factory, scheme)
    c = linear_contributions(model, m).collect()
    beta = model.coefficients.toArray()
    mean = sum(r.features.toArray() for r in c) / len(c)
    for r in c[:5]:
        margin = float(beta @ r.features.toArray()) + model.intercept
        assert sum(r.contrib) + float(beta @ mean) + model.intercept == pytest.approx(margin)


def test_one_hot_unknown_is_all_zero(spark):
    from carestat.operators import prepare as M
    train = spark.createDataFrame([("a", 1.0, 0), ("b", 2.0, 1), ("b", None, 0)],
                                  "gender string, time_in_hospital double, readmitted_30d int")
    groups = {"categorical": ["gender"], "numeric": ["time_in_hospital"], "binary": [],
              "medication": []}
    prep = M.fit_preparation(train, groups)
    assert prep.feature_names == ["time_in_hospital", "gender_a", "gender_b"]
    test = spark.createDataFrame([("zzz", 3.0, 0), (None, None, 1)],
                                 "gender string, time_in_hospital double, readmitted_30d int")
    rows = prep.transform(test).select("features").collect()
    assert rows[0].features.size == 3
    assert list(rows[0].features.toArray()[1:]) == [0.0, 0.0]      # unseen -> all zeros
    assert list(rows[1].features.toArray()[1:]) == [0.0, 1.0]      # NULL -> mode 'b'
    # numeric: median 1.5 imputed, population std of the imputed train column
    assert rows[1].features.toArray()[0] == 0.0


def test_preparation_save_load_transforms_alike(spark, tmp_path):
    from carestat.operators import prepare as M
    train = spark.createDataFrame([("a'b", 1.0, 0), ("b", 2.1, 1), ("b", None, 0), (None, 0.3, 1)],
                                  "gender string, time_in_hospital double, readmitted_30d int")
    groups = {"categorical": ["gender"], "numeric": ["time_in_hospital"], "binary": [], "medication": []}
    prep = M.fit_preparation(train, groups)
    prep.save(spark, str(tmp_path / "prep"))
    again = M.Preparation.load(spark, str(tmp_path / "prep"))
    assert all(getattr(again, n) == getattr(prep, n) for n in M.STATISTICS)
    rows = [[r.features.toArray().tolist() for r in p.transform(train).collect()] for p in (prep, again)]
    assert rows[0] == rows[1]


def test_scoring_names_missing_required_columns(spark):
    from carestat.operators.score import score_patients
    with pytest.raises(ValueError, match="age, gender"):
        score_patients(spark.range(1), None, None, None)


def test_permutation_importance_finds_signal(spark):
    import numpy as np
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.linalg import Vectors
    from carestat.operators import explain as X
    rng = np.random.default_rng(1)
    rows = []
    for i in range(600):
        sig, noise = rng.normal(), rng.normal()
        rows.append((i, int(sig > 0), Vectors.dense([noise, sig])))
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql import types as Ty
    df = spark.createDataFrame(rows, Ty.StructType([
        Ty.StructField("encounter_id", Ty.LongType()), Ty.StructField("label", Ty.IntegerType()),
        Ty.StructField("features", VectorUDT())]))
    model = RandomForestClassifier(numTrees=10, maxDepth=4, seed=1).fit(df)
    imp = {r.feature: r.auc_drop for r in X.permutation_importance(model, df, ["noise", "signal"]).collect()}
    assert imp["signal"] > 0.2 and abs(imp["noise"]) < 0.05


def test_changed_rows_alone_are_scored_anew(spark):
    import numpy as np
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from carestat.operators import explain as X
    rng = np.random.default_rng(5)
    rows = [(int(a + b > 0), [float(a), float(b), 1.0]) for a, b in rng.normal(size=(400, 2)).round(1)]
    df = spark.createDataFrame([(y, x, x[1:2] + x[:1] + x[2:], [j for j in (0, 1) if x[0] != x[1]]) for y, x in rows],
                               "label int, x array<double>, px array<double>, changed array<int>")
    model = RandomForestClassifier(numTrees=5, maxDepth=4, seed=1).fit(df.select("label", array_to_vector("x").alias("features")))
    score = lambda vectors: [r.p for r in model.transform(spark.createDataFrame([(v,) for v in vectors], "x array<double>").select(
        array_to_vector("x").alias("features"))).select(vector_to_array("probability")[1].alias("p")).collect()]
    want = []
    for j in (0, 1):
        swapped = [x[:j] + [x[1 - j]] + x[j + 1:] for _, x in rows]
        want += [(j, y, a, b) for (y, x), a, b in zip(rows, score([x for _, x in rows]), score(swapped)) if x[0] != x[1]]
    assert sorted(map(tuple, X.changed_scores(model, df).collect())) == sorted(want)
    # counts less the old and plus the new scores are the counts of all rows with the feature swapped
    base = spark.createDataFrame([(0, 0.25, 3, 1), (0, 0.5, 2, 1), (0, 0.25, -1, 0), (0, 0.75, 1, 0)], "g int, s double, n long, pos long")
    plain = spark.createDataFrame([(0, 0.25, 2, 1), (0, 0.5, 2, 1), (0, 0.75, 1, 0)], "g int, s double, n long, pos long")
    assert X._auc_by_group(base, "g").first()["auc"] == X._auc_by_group(plain, "g").first()["auc"]


def test_encounters_are_derived_once_for_split_preparation_and_lines(spark, monkeypatch):
    from carestat.plans import catalog as C
    from carestat.plans import tables
    monkeypatch.setattr(tables, "_VIEWS", {})
    sf = "/root/testdata/sf0.001"
    split = C.split_view(spark, sf)
    assert split.inputFiles() and not any("lineitem" in f for f in split.inputFiles())
    plan = split.select("encounter_id", "split")._jdf.queryExecution().executedPlan().toString()
    assert "num_medications" not in plan  # a key and a label are read
    assert C.m10_feature_names(spark, sf).count() > 0
    assert not any(k[0] == "matrix" for k in tables._VIEWS)
    lines, names = C.encounter_lines(spark, sf)
    found = [r.value for r in spark.read.text(lines).collect()]
    ids = [r.encounter_id for r in tables.raw(spark, sf).select("encounter_id").collect()]
    assert len(found) == len(ids) + sum(i % 7 == 0 for i in ids)
    assert sum(v.count(",") == 2 for v in found) == sum(i % 7 == 0 for i in ids)


def test_split_query_derives_a_key_and_a_label_only(spark, monkeypatch):
    from carestat.plans import catalog as C
    from carestat.plans import tables
    monkeypatch.setattr(tables, "_VIEWS", {})
    sf = "/root/testdata/sf0.001"
    found = C.m3_stratified_split(spark, sf)
    written = [f.rpartition("/")[0] for f in found.inputFiles()]
    assert written and spark.read.parquet(written[0]).columns == ["encounter_id", "readmitted_30d"]
    assert not any(k[0] == "split" for k in tables._VIEWS)
    wide = C.split_view(spark, sf)
    assert {"insulin_used", "diag_1", "med_changes_count"} <= set(wide.columns) and "insulin_dosage" not in wide.columns
    wide = wide.select(found.columns)
    assert sorted(found.collect()) == sorted(wide.collect())
    C.p17_class_counts(spark, sf)
    C.t1_class_weights(spark, sf)


def test_score_patients_from_partial_inputs(spark):
    from carestat.operators import prepare as M
    from carestat.operators.score import score_patients
    from carestat.plans import tables
    from carestat.sources.codes import code_dimension
    from conftest import SF_SMALL
    fea = tables.featured(spark, SF_SMALL)
    split = M.stratified_split(fea)
    prep = M.fit_preparation(split.filter("split = 'train'"))
    matrix = prep.transform(split).select(F.col("readmitted_30d").alias("label"), "split", "features")
    factory, scheme, _ = T.model_suite({"max_iter": 20})["Logistic Regression"]
    model = T.fit(matrix.filter("split = 'train'"), factory, scheme)
    patients = spark.createDataFrame(
        [(1, "[70-80)", "Male", 5, 12, 1, 40, 7, ">8", "Up"),
         (2, "[20-30)", "Female", 1, 3, 0, 10, 2, "Norm", "No")],
        "encounter_id long, age string, gender string, time_in_hospital int, num_medications int, "
        "num_procedures int, num_lab_procedures int, number_diagnoses int, A1Cresult string, "
        "insulin string")
    out = score_patients(patients, prep, model, code_dimension(spark)).collect()
    assert len(out) == 2
    assert all(0.0 <= r.risk_score <= 1.0 and r.risk_tier in ("Low", "Moderate", "High") for r in out)


def test_residual_text_is_a_number_only_if_all_of_it_is(spark):
    from carestat.operators import prepare as M
    train = spark.createDataFrame([("7", "1", " 2.5 ", None, "1d", "0x1"), ("10", "x", "-1e3", None, "2", "3")], "a string, b string, c string, d string, e string, f string")
    test = spark.createDataFrame([("8", "2", ".5", None, "3", "4"), (None, "3", "+4.", None, "4", "5")], "a string, b string, c string, d string, e string, f string")
    kinds = {r.feature: (r.kind, r.not_numbers_train, r.not_numbers_test) for r in M.residual_text_kinds(train, test, list("abcdef")).collect()}
    assert kinds == {"a": ("numeric", 0, 0), "b": ("category", 1, 0), "c": ("numeric", 0, 0), "d": ("numeric", 0, 0), "e": ("category", 1, 0), "f": ("category", 1, 0)}
    a, b, left = M.resolve_residual_text(train, test, list("abcdef"))
    assert left == ["b", "e", "f"] and [r.c for r in a.collect()] == [2.5, -1000.0] and [r.a for r in b.collect()] == [8.0, None]
    assert M.residual_text_kinds(train, test, []).count() == 0
    prep = M.fit_preparation(train.selectExpr("a", "b", "c", "1 as y"), {"numeric": [], "categorical": [], "binary": ["a", "b", "c"], "medication": []})
    assert prep.categorical == ["b"] and prep.passthrough == ["a", "c"]
    rows = prep.transform(train.selectExpr("a", "b", "c")).select("features").collect()
    assert [list(r.features.toArray()) for r in rows] == [[1.0, 0.0, 7.0, 2.5], [0.0, 1.0, 10.0, -1000.0]]
    assert prep.feature_names == ["b_1", "b_x", "a", "c"]


def test_logistic_gradient_vanishes_at_the_fit_only(spark):
    from carestat.operators import verify as V
    m = _toy_matrix(spark)
    factory, scheme, _ = T.model_suite({"max_iter": 200})["Logistic Regression"]
    data = T.with_weights(m, scheme)
    n = data.agg(F.sum("weight")).first()[0]
    early, late = (factory(n).copy().setMaxIter(i).fit(data) for i in (1, 200))
    size = [max(abs(r.gradient) for r in V.logistic_gradient(x, data, ["x", "y"]).collect()) for x in (early, late)]
    assert size[1] < 1e-4 < size[0]


def test_damaged_model_raises_and_absent_one_is_passed_over(spark, tmp_path):
    m = _toy_matrix(spark)
    factory, scheme, _ = T.model_suite({"max_iter": 20})["Logistic Regression"]
    T.save_model(T.fit(m, factory, scheme), str(tmp_path / "lr"))
    for part in (tmp_path / "lr" / "data").glob("*.parquet"):
        part.write_bytes(b"not a table")
    with pytest.raises(Exception):
        T.load_first([str(tmp_path / "none"), str(tmp_path / "lr")])
    with pytest.raises(FileNotFoundError):
        T.load_first([str(tmp_path / "none")])
