import math

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Observation
from pyspark.sql import functions as F

from attrition.operators import ml
from attrition.plans import features as feat
from attrition.plans import training
from attrition.sources.files import shared_dir
from attrition.sources.testtables import TEST_REF, TEST_START, load_tables

SF = "/root/testdata/sf0.001"


def test_metrics_fixture(spark):
    pred = spark.createDataFrame([(1.0, 1.0), (1.0, 1.0), (1.0, 0.0), (0.0, 0.0), (0.0, 1.0)],
                                 "label double, prediction double")
    assert ml.accuracy(pred).first().accuracy == pytest.approx(0.6)
    conf = {(r.truth, r.predicted): r.n for r in ml.confusion_counts(pred).collect()}
    assert conf == {(0.0, 0.0): 1, (0.0, 1.0): 1, (1.0, 0.0): 1, (1.0, 1.0): 2}
    rep = {r.row_label: r for r in ml.classification_report(ml.confusion_counts(pred)).collect()}
    assert rep["1.0"].precision == pytest.approx(2 / 3) and rep["1.0"].recall == pytest.approx(2 / 3)
    assert rep["1.0"].f1_score == pytest.approx(2 / 3) and rep["1.0"].support == 3
    assert rep["0.0"].f1_score == pytest.approx(0.5) and rep["0.0"].support == 2
    assert rep["macro avg"].f1_score == pytest.approx(0.5833333333)
    assert rep["weighted avg"].f1_score == pytest.approx(0.6)
    assert rep["accuracy"].f1_score == pytest.approx(0.6)


def test_zero_division(spark):
    pred = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0)], "label double, prediction double")
    rep = {r.row_label: r for r in ml.classification_report(ml.confusion_counts(pred)).collect()}
    assert rep["1.0"].precision == 0.0 and rep["1.0"].f1_score == 0.0


def test_split_exact_sizes(spark):
    rows = [(i, 1.0 if i % 7 == 0 else 0.0) for i in range(2003)]
    df = spark.createDataFrame(rows, "client_id long, label double")
    s = ml.stratified_split(df)
    n = s.count()
    assert n == 2003
    counts = {(r.split, r.label): r["count"] for r in s.groupBy("split", "label").count().collect()}
    n_test = math.ceil(0.2 * 2003)
    assert counts[("test", 0.0)] + counts[("test", 1.0)] == n_test
    n1 = sum(1 for _, lab in rows if lab == 1.0)
    assert abs(counts[("test", 1.0)] - n1 * n_test / 2003) < 1
    assert s.select("client_id").distinct().count() == 2003


def test_split_matches_global_rank(spark):
    rows = [(i, float(i % 3 == 0)) for i in range(900)]
    df = spark.createDataFrame(rows, "client_id long, label double")
    got = {r.client_id for r in ml.stratified_split(df).filter("split = 'test'").collect()}
    import hashlib
    quotas = {r.label: r.n_test_c for r in ml.class_quotas(df).collect()}
    want = set()
    for lab in (0.0, 1.0):
        ids = sorted((hashlib.md5(f"{i}:42".encode()).hexdigest(), i) for i, lv in rows if lv == lab)
        want |= {i for _, i in ids[:quotas[lab]]}
    assert got == want


def test_weights_sum_to_n(spark):
    df = spark.createDataFrame([(0.0,)] * 30 + [(1.0,)] * 10, "label double")
    w = {r.label: r.weight for r in ml.class_weights(df).collect()}
    assert w[0.0] == pytest.approx(40 / 60) and w[1.0] == pytest.approx(40 / 20)


def test_unseen_category_scores_zero_block(spark):
    train = spark.createDataFrame([(1, 0.0, 1.0, "a"), (2, 1.0, 2.0, "b"), (3, 0.0, 3.0, "c")],
                                  "client_id long, label double, x double, cat string")
    roles = ml.FrameRoles(("x",), ("cat",))
    model = ml.feature_pipeline(roles).fit(train)
    test = spark.createDataFrame([(4, 0.0, 1.0, "zzz"), (5, 0.0, 1.0, None)],
                                 "client_id long, label double, x double, cat string")
    vecs = [r[0] for r in model.transform(test).select(vector_to_array("features")).collect()]
    assert vecs == [[1.0, 0.0, 0.0, 0.0], [1.0, 0.0, 0.0, 0.0]]


@pytest.fixture(scope="module")
def trained(spark):
    features = feat.build_features(load_tables(spark, SF), TEST_REF, TEST_START)
    return training.train_and_evaluate(features)


def test_train_split_disjoint_complete(trained):
    s = trained.split
    assert s.count() == s.select("client_id").distinct().count()
    assert trained.predictions.count() == s.filter("split = 'test'").count()


def test_gradient_near_zero(spark, trained):
    """At the optimum of 0.5|w|^2 + C*sum(weight*logloss), the gradient is ~0."""
    train = ml.with_weights(trained.split.filter("split = 'train'"))
    lr = trained.model.stages[-1]
    scored = trained.model.transform(train).select(
        "weight", ml.LABEL, vector_to_array("features").alias("x"),
        F.element_at(vector_to_array("probability"), 2).alias("p"))
    resid = F.col("weight") * (F.col("p") - F.col(ml.LABEL))
    k = len(lr.coefficients)
    sums = scored.select(resid.alias("r"), F.posexplode("x").alias("j", "xj")).groupBy("j").agg(
        F.sum(F.col("r") * F.col("xj")).alias("g"), F.max(F.abs("xj")).alias("scale")).collect()
    grad, scale = [0.0] * k, [1.0] * k
    for r in sums:
        grad[r.j], scale[r.j] = r.g, max(1.0, r.scale)
    coef = lr.coefficients.toArray()
    # gradient of the objective in each feature's own units (scale-invariant KKT check)
    full = [(ml.C * g + w) / s for g, w, s in zip(grad, coef, scale)]
    g0 = scored.agg(F.sum(resid)).first()[0] * ml.C
    assert max(abs(v) for v in full) < 1e-3
    assert abs(g0) < 1e-2


def test_optimality_tells_a_stopped_fit(trained):
    train = trained.split.filter("split = 'train'")
    done = ml.optimality(trained.model, trained.roles, train).collect()
    assert [r.slot for r in sorted(done, key=lambda r: r.slot)] == list(range(-1, len(done) - 1))
    assert max(abs(r.gradient) for r in done) < 1e-4
    stopped = ml.fit_model(train, trained.roles, max_iter=1)
    assert max(abs(r.gradient) for r in ml.optimality(stopped, trained.roles, train).collect()) > 1e-4


def test_linear_score_is_the_models(trained):
    test = trained.split.filter("split = 'test'")
    z = ml.linear_score(trained.model, trained.roles)
    rows = trained.model.transform(test).select(
        z.alias("z"), F.element_at(vector_to_array("rawPrediction"), 2).alias("raw")).collect()
    assert [r.z for r in rows] == pytest.approx([r.raw for r in rows])


def test_report_consistency(spark):
    pred = spark.createDataFrame([(1.0, 1.0), (1.0, 1.0), (1.0, 0.0), (0.0, 0.0), (0.0, 1.0)],
                                 "label double, prediction double")
    report = ml.classification_report(ml.confusion_counts(pred))
    assert all(r.consistent for r in ml.report_consistency(report).collect())
    wrong = report.withColumn("f1_score", F.col("f1_score") + F.when(F.col("row_label") == "accuracy", 0.1).otherwise(0.0))
    assert {r.row_label for r in ml.report_consistency(wrong).collect() if not r.consistent} == {"accuracy"}


def test_null_numeric_fails_with_its_name(spark):
    rows = [(i, float(i % 2), None if i == 3 else float(i), "a") for i in range(10)]
    train = spark.createDataFrame(rows, "client_id long, label double, x double, cat string")
    with pytest.raises(Exception, match="null in numeric feature x"):
        ml.fit_model(train, ml.FrameRoles(("x",), ("cat",)))


def test_predicts_in_a_session_that_observed_a_query(spark):
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 3}
    rows = [(i, float(i % 3 == 0), float(i), "ab"[i % 2]) for i in range(12)]
    train = spark.createDataFrame(rows, "client_id long, label double, x double, cat string")
    model = ml.fit_model(train, ml.FrameRoles(("x",), ("cat",)))
    assert model.transform(train).select("probability").distinct().count() == 12


def test_model_roundtrip_same_predictions(spark, trained):
    path = training.save_model(trained.model, shared_dir(spark, "models"))
    test = trained.split.filter("split = 'test'")
    a = sorted((r.client_id, r.prediction) for r in ml.predictions(trained.model, test).collect())
    b = sorted((r.client_id, r.prediction) for r in ml.predictions(training.load_model(path), test).collect())
    assert a == b


def test_coefficients_named(trained):
    coef = ml.coefficients(trained.model, trained.roles, trained.split)
    terms = [r.term for r in coef.collect()]
    assert terms[0] == "intercept" and "tenure_mois" in terms and any(t.startswith("genre_") for t in terms)


def test_export_then_train_from_csv(spark):
    from pyspark.sql import types as T

    from attrition.plans.dataset import export_dataset, read_dataset
    from attrition.sources.schema import EXPORT_COLUMNS
    path = shared_dir(spark, "dataset")
    summary = export_dataset(load_tables(spark, SF), path, TEST_REF, TEST_START).first()
    back = read_dataset(spark, path, T.LongType())
    assert back.columns == list(EXPORT_COLUMNS) and back.count() == summary.n_rows
    result = training.train_from_csv(spark, path, key_type=T.LongType())
    assert result.report.count() == 5


def test_weight_column_matches_joined_weights(spark):
    rows = [(i, float(i % 7 == 0)) for i in range(700)]
    train = spark.createDataFrame(rows, "client_id long, label double")
    weight, total = ml.weight_column(train)
    a = sorted(train.withColumn("weight", weight).select("client_id", "weight").collect())
    b = sorted(ml.with_weights(train).select("client_id", "weight").collect())
    assert a == b
    assert total == pytest.approx(700.0)         # balanced weights sum to n
    w = {r.label: r.weight for r in ml.class_weights(train).collect()}
    assert w[1.0] == pytest.approx(700 / (2 * 100)) and w[0.0] == pytest.approx(700 / (2 * 600))
