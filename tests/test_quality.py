import datetime as dt

from pyspark.sql import types as T

from attrition.operators import quality
from attrition.operators.subscriptions import last_nonnull
from attrition.sources.schema import contracts

D = dt.date.fromisoformat


def test_unique_and_nulls(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (3,), (3,), (3,)], "k long")
    r = quality.dq_unique(df, "t", "k").first()
    assert (r.n_rows, r.n_null_keys, r.n_duplicate_keys, r.n_duplicate_rows) == (7, 1, 2, 5)
    n = quality.dq_nulls(df, "t", ["k"]).first()
    assert n.n_nulls == 1


def test_orphans_exempt_null(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,), (9,)], "c long")
    parent = spark.createDataFrame([(1,), (2,)], "p long")
    r = quality.dq_orphans(child, "child", "c", parent, "parent", "p").first()
    assert (r.n_orphan_keys, r.n_orphan_rows) == (1, 1)


def test_domain_catches_seeded_bad_rows(spark):
    c = contracts()["interactions_support"]
    df = spark.createDataFrame(
        [("appel", "technique"), ("fax", "technique"), ("chat", "x" * 60), (None, None)],
        "type_interaction string, theme string")
    df = quality.conform(df, c)
    rows = {(r.column_name, r.rule): r.n_violations for r in quality.dq_domain(df, c).collect()}
    assert rows[("type_interaction", "domain")] == 1
    assert rows[("theme", "domain")] == 1
    assert rows[("theme", "length<=50")] == 1


def test_conform_defaults(spark):
    c = contracts()["usage_mensuel"]
    feed = spark.createDataFrame([(1, "a", D("2024-01-01"), None)], "usage_id long, client_id string, mois date, "
                                 "nb_connexions int")
    r = quality.conform(feed, c).first()
    assert r.volume_data_go == 0 and r.duree_appels_min == 0 and r.nb_connexions is None
    assert r.created_at is not None
    r2 = quality.conform(feed, c, null_as_default=True).first()
    assert r2.nb_connexions == 0
    assert quality.conform(feed, c).schema == c.schema or [f.dataType for f in quality.conform(feed, c).schema] == [
        f.dataType for f in c.schema]


def test_surrogate_key_dense(spark):
    rows = [(i % 97, i) for i in range(5000)]
    df = spark.createDataFrame(rows, "a long, b long").repartition(7)
    keyed = quality.surrogate_key(df, ["a", "b"])
    got = sorted((r.a, r.b, r.surrogate_id) for r in keyed.collect())
    assert [g[2] for g in got] == list(range(1, 5001))


def test_last_nonnull_per_column(spark):
    df = spark.createDataFrame(
        [("a", D("2024-01-01"), 1, D("2024-01-01"), "résilié"), ("a", D("2024-01-02"), 2, None, "actif")],
        "client_id string, date_debut date, abonnement_id long, date_fin date, statut string")
    r = last_nonnull(df, "client_id", ["date_debut", "abonnement_id"], ["date_fin", "statut"]).first()
    assert r.date_fin == D("2024-01-01") and r.statut == "actif"


def test_key_type_parameter():
    assert contracts(T.LongType())["clients"].schema["client_id"].dataType == T.LongType()


def test_csv_with_bom_and_roundtrip(spark, tmp_path):
    from attrition.sources import files
    p = tmp_path / "bom"
    p.mkdir()
    (p / "part-0.csv").write_text("client_id,date_inscription,montant\nC1,2024-01-31,12.50\nC2,,\n",
                                  encoding="utf-8-sig")
    schema = T.StructType([T.StructField("client_id", T.StringType()), T.StructField("date_inscription", T.DateType()),
                           T.StructField("montant", T.DecimalType(10, 2))])
    rows = files.read_csv(spark, str(p), schema).orderBy("client_id").collect()
    assert rows[0].client_id == "C1" and rows[0].date_inscription == D("2024-01-31")
    assert str(rows[0].montant) == "12.50" and rows[1].date_inscription is None and rows[1].montant is None
    out = files.write_csv(spark.createDataFrame(rows, schema), files.shared_dir(spark, "t"))
    assert sorted(files.read_csv(spark, out, schema).collect()) == sorted(rows)
