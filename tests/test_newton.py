"""Newton steps against a plain fit and Spark ML's own solver."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from attrition.operators import ml, newton
from attrition.plans import training
from attrition.plans.features import build_features
from attrition.sources.files import shared_dir
from attrition.sources.testtables import TEST_REF, TEST_START, load_tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def features(spark):
    return build_features(load_tables(spark, SF), TEST_REF, TEST_START)


@pytest.fixture(scope="module")
def fitted(features):
    return training.train_newton(features)


def _plain(x, y, w, penalty, steps=60):
    """Newton on one machine with the same objective, in extended precision sums."""
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ beta))
        gradient = x.T @ (w * (p - y)) + penalty * beta
        beta = beta - np.linalg.solve(x.T @ (x * (w * p * (1 - p))[:, None]) + np.diag(penalty), gradient)
    return beta


def test_equal_to_a_plain_fit(fitted):
    train = fitted.split.filter("split = 'train'")
    weight, _ = ml.weight_column(train)
    rows = ml.feature_pipeline(fitted.roles).fit(train).transform(train).select(
        vector_to_array("features").alias("x"), ml.LABEL, weight.alias("w")).collect()
    x = np.array([[1.0, *(np.array(r.x) / fitted.fit.scale)] for r in rows])
    y, w = np.array([r[ml.LABEL] for r in rows]), np.array([r.w for r in rows])
    beta = _plain(x, y, w, np.append(0.0, 1 / fitted.fit.scale**2))
    own = np.append(fitted.fit.intercept, fitted.fit.coefficients * fitted.fit.scale)
    names = ["intercept", *fitted.fit.names]
    both = [names.index("total_charges"), names.index("total_volume_go_12_mois")]      # equal columns: their sum counts
    keep = [k for k in range(len(names)) if k not in both]
    assert np.allclose(own[keep], beta[keep], atol=1e-7) and abs(own[both].sum() - beta[both].sum()) < 1e-7
    assert fitted.fit.steps < 30 and fitted.fit.gradient <= newton.TOLERANCE


def test_near_the_other_solver(features, fitted):
    other = training.train_and_evaluate(features)
    a = {r[ml.KEY]: (r.probability, r.prediction) for r in fitted.predictions.collect()}
    b = {r[ml.KEY]: (r.probability, r.prediction) for r in other.predictions.collect()}
    assert a.keys() == b.keys()
    assert max(abs(a[k][0] - b[k][0]) for k in a) < 1e-3 and all(a[k][1] == b[k][1] for k in a)


def test_saved_model_scores_frames_alone(spark, fitted):
    path = training.save_model(fitted.model, shared_dir(spark, "models"))
    test = fitted.split.filter("split = 'test'")
    again = training.load_model(path).transform(test.withColumn("region", F.lit("nowhere")))
    unseen = dict(zip(fitted.fit.names, fitted.fit.coefficients, strict=True))
    own = {r[ml.KEY]: r for r in fitted.model.transform(test).collect()}
    for r in again.collect():
        was = own[r[ml.KEY]]
        assert r.score == pytest.approx(was.score - unseen[f"region_{was.region}"], abs=1e-9)
    same = training.load_model(path).transform(test)
    assert same.exceptAll(fitted.predictions).count() == 0 and same.count() == fitted.predictions.count()


def test_names_with_quotes_and_nulls(spark):
    rows = [(k, float(k % 3 == 0), float(k), "it's" if k % 2 else None) for k in range(60)]
    frame = spark.createDataFrame(rows, "client_id bigint, label double, amount double, kind string")
    roles = ml.column_roles(frame, drop=(ml.KEY, ml.LABEL))
    found = newton.fit(frame, roles)
    assert found.names == ("amount", "kind_it's")
    scored = newton.as_pipeline(found, roles).transform(frame).collect()
    for r in scored:
        z = found.intercept + found.coefficients[0] * r.amount + (found.coefficients[1] if r.kind else 0)
        assert r.score == pytest.approx(z) and r.probability == pytest.approx(1 / (1 + np.exp(-z)))
    with pytest.raises(Exception, match="null in numeric feature amount"):
        newton.fit(frame.withColumn("amount", F.when(F.col("client_id") > 3, F.col("amount"))), roles)


def test_separable_classes_converge(spark):
    rows = [(k, float(k >= 50), float(k) * 1e6) for k in range(100)]
    frame = spark.createDataFrame(rows, "client_id bigint, label double, amount double")
    roles = ml.column_roles(frame, drop=(ml.KEY, ml.LABEL))
    found = newton.fit(frame, roles, c=1e-6)
    assert found.steps < newton.MAX_STEPS and found.coefficients[0] > 0


def test_vocabulary_of_many_categories(spark):
    """A column of 200,000 values: numbered by range partitions, the same places as one sort gives."""
    frame = spark.range(200_000).select(
        F.col("id").alias("client_id"), F.md5(F.col("id").cast("string")).alias("city"),
        F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b").alias("kind"))
    vocab = ml.category_vocab(frame, ("kind", "city"))
    assert "row_number" not in vocab._jdf.queryExecution().executedPlan().toString()
    city = vocab.filter("feature = 'city'").orderBy("idx").select("category", "idx").toPandas()
    assert city["idx"].tolist() == list(range(200_000)) and city["category"].is_monotonic_increasing
    slots = ml.one_hot_slots(frame, ml.FrameRoles((), ("kind", "city")))
    assert slots.count() == 200_000 + 133_334 and slots.agg(F.max("slot")).first()[0] == 200_001
