"""Model dataflow on Spark ML: model frame, vocabulary, one-hot, exact
stratified split, balanced class weights, logistic regression, metrics.

Everything is distributed.  The only things that reach the driver are
bounded by the model, not by the data: the class counts (one row per
class), the category vocabularies (one entry per category) and the fitted
coefficients.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrition.operators.ranking import ordered_position
from attrition.session import cut_lineage
from attrition.sources.files import shared_dir
from attrition.sources.schema import NON_FEATURE_COLUMNS, TARGET

KEY = "client_id"
LABEL = "label"

# --- fixed values: training settings of the reference ---------------------
TEST_SIZE = 0.2
SEED = 42
MAX_ITER = 1000
C = 1.0                      # inverse L2 strength of the reference solver


# ----------------------------------------------------------- K1 model frame
@dataclass(frozen=True)
class FrameRoles:
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]


def column_roles(df: DataFrame, drop=NON_FEATURE_COLUMNS) -> FrameRoles:
    """Split the feature columns by type: strings are categorical, numbers numeric.

    Dates and other types are neither (a date read from text is a string in
    the reference, but it is dropped there anyway).
    """
    numeric, categorical = [], []
    for f in df.schema.fields:
        if f.name in drop:
            continue
        if isinstance(f.dataType, T.StringType):
            categorical.append(f.name)
        elif isinstance(f.dataType, T.NumericType):
            numeric.append(f.name)
    return FrameRoles(tuple(numeric), tuple(categorical))


def model_frame(features: DataFrame) -> DataFrame:
    """Key, label (double), numeric features as double, categorical as is."""
    roles = column_roles(features)
    return features.select(
        F.col(KEY),
        F.col(TARGET).cast("double").alias(LABEL),
        *[F.col(c).cast("double").alias(c) for c in roles.numeric],
        *[F.col(c) for c in roles.categorical],
    )


# ---------------------------------------------------- K2 vocabulary / K3 one-hot
def _category_pairs(frame: DataFrame, categorical: tuple[str, ...]) -> DataFrame:
    """(key, feature, category) for every non-null categorical value, one scan."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("category")) for c in categorical
    ])).alias("fc")
    return frame.select(KEY, pairs).select(KEY, "fc.feature", "fc.category").where(F.col("category").isNotNull())


def category_vocab(frame: DataFrame, categorical: tuple[str, ...]) -> DataFrame:
    """Sorted distinct non-null values per categorical column with their index.

    One scan: every (column, value) pair is exploded, de-duplicated by a
    partial aggregate, then numbered inside each column's own vocabulary by
    range partitions (:mod:`attrition.operators.ranking`), so a column with millions
    of values is no single task either.
    """
    vocab = _category_pairs(frame, categorical).select("feature", "category").distinct()
    pos = F.create_map(*[x for i, c in enumerate(categorical) for x in (F.lit(c), F.lit(i))])
    numbered = ordered_position(vocab, ["category"], group=["feature"], name="idx")
    return numbered.select("feature", pos[F.col("feature")].alias("feature_pos"), "category", F.col("idx").cast("int").alias("idx"))


def one_hot_slots(frame: DataFrame, roles: FrameRoles) -> DataFrame:
    """Sparse one-hot: one row per (client, categorical column) with a known value.

    ``slot`` is the position in the assembled vector: numeric columns first,
    then each column's categories in vocabulary order.  Unknown or null
    values have no row (an all-zero block), as with ``handle_unknown='ignore'``.
    The frame is read twice (vocabulary, then values): pass a materialized one.
    """
    # one row per category, materialised once: the offsets and the lookup below
    # do not rescan the frame
    vocab = cut_lineage(category_vocab(frame, roles.categorical))
    sizes = vocab.groupBy("feature", "feature_pos").agg(F.count(F.lit(1)).alias("size"))
    offsets = sizes.select(
        "feature",
        (F.lit(len(roles.numeric)) + F.coalesce(
            F.sum("size").over(Window.orderBy("feature_pos").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        )).alias("offset"),
    )
    slots = vocab.join(offsets, "feature").select(
        "feature", "category", (F.col("offset") + F.col("idx")).alias("slot"),
        F.concat_ws("_", "feature", "category").alias("column_name"),
    )
    values = _category_pairs(frame, roles.categorical)
    # The optimizer's own size check chooses the join; in a shuffle join AQE splits hot categories.
    return values.join(slots, ["feature", "category"]).select(KEY, "column_name", "slot")


# ------------------------------------------------------- K5 stratified split
HASH_PREFIX = 4              # 16**4 hash buckets per class


def split_hash(key: Column, seed: int = SEED) -> Column:
    return F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))


def quotas_from_counts(counts: DataFrame, label: str = LABEL, test_size: float = TEST_SIZE) -> DataFrame:
    """Per class: ``n_c`` and its test quota, from a (label, n_c) table.

    ``n_test = ceil(test_size * n)`` (double arithmetic), shared out by
    largest remainder of ``n_c * n_test / n``; equal remainders go to the
    smaller class label first.  The class table has one row per class, so
    the global windows below run over a handful of rows.
    """
    everything = Window.partitionBy()
    n = F.sum("n_c").over(everything)
    q = counts.select(label, "n_c", n.alias("n"), F.ceil(F.lit(float(test_size)) * n).cast("long").alias("n_test"))
    cont = (F.col("n_c") * F.col("n_test")).cast("double") / F.col("n")
    q = q.withColumn("fl", F.floor(cont).cast("long")).withColumn("rem", cont - F.floor(cont))
    q = q.withColumn("need", F.col("n_test") - F.sum("fl").over(everything))
    q = q.withColumn("rank", F.row_number().over(Window.orderBy(F.col("rem").desc(), F.col(label).asc())))
    return q.select(
        label, "n_c",
        (F.col("fl") + F.when(F.col("rank") <= F.col("need"), 1).otherwise(0)).alias("n_test_c"),
    )


def class_quotas(frame: DataFrame, label: str = LABEL, test_size: float = TEST_SIZE) -> DataFrame:
    counts = frame.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    return quotas_from_counts(counts, label, test_size)


def stratified_split(frame: DataFrame, label: str = LABEL, key: str = KEY, seed: int = SEED,
                     test_size: float = TEST_SIZE) -> DataFrame:
    """Exact stratified hold-out: per class, the ``n_test_c`` rows first in
    ``md5(key || ':' || seed)`` order (ties by key) are the test rows.

    A per-class ``row_number`` would put a whole class in one task.  Instead
    the rank is computed in two levels: rows are bucketed by the first hex
    digits of the hash (uniform, so buckets are balanced whatever the key
    distribution), bucket sizes give each bucket's offset (a window over at
    most 16**4 rows per class), and ``row_number`` runs inside a bucket only.
    The bucket-size table (at most classes x 16**4 rows) is materialised
    once; class counts and quotas come from it, so the frame is scanned
    twice in all (sizes, then ranks).  Pass a materialized frame (a
    checkpoint or a written table) so that the plan behind it runs once.
    """
    h = split_hash(F.col(key), seed)
    tagged = frame.withColumn("_h", h).withColumn("_b", F.substring("_h", 1, HASH_PREFIX))
    sizes = cut_lineage(tagged.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_n")))
    before = Window.partitionBy(label).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(label, "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    counts = sizes.groupBy(label).agg(F.sum("_n").alias("n_c"))
    quotas = quotas_from_counts(counts, label, test_size).select(label, "n_test_c")
    inside = Window.partitionBy(label, "_b").orderBy("_h", key)
    ranked = (
        tagged.withColumn("_pos", F.row_number().over(inside))
        # offsets: at most (classes x 16**4) rows; quotas: one row per class
        .join(F.broadcast(offsets), [label, "_b"])
        .join(F.broadcast(quotas), label)
    )
    is_test = (F.col("_before") + F.col("_pos")) <= F.col("n_test_c")
    return ranked.withColumn("split", F.when(is_test, "test").otherwise("train")).drop(
        "_h", "_b", "_before", "_pos", "n_test_c"
    )


# ------------------------------------------------------------- K6 weights
def class_weights(train: DataFrame, label: str = LABEL) -> DataFrame:
    """Balanced weights ``n / (k * n_c)`` from the training rows."""
    counts = train.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    everything = Window.partitionBy()
    n = F.sum("n_c").over(everything)
    k = F.count(F.lit(1)).over(everything)
    return counts.select(label, "n_c", (n.cast("double") / (k * F.col("n_c"))).alias("weight"))


def with_weights(train: DataFrame, label: str = LABEL) -> DataFrame:
    # one row per class: bounded broadcast
    return train.join(F.broadcast(class_weights(train, label).select(label, "weight")), label)


def weight_column(train: DataFrame, label: str = LABEL) -> tuple[Column, float]:
    """The balanced weight as a column expression, plus the total weight.

    The class table (one row per class: bounded by the model, not the data)
    is collected once.  The weight then becomes a ``CASE`` on the label, so
    every later pass over the training rows (indexer fit, solver caching)
    reads them without recounting the classes.  Total weight = sum over
    classes of ``n_c * weight``.
    """
    rows = class_weights(train, label).collect()
    weight = None
    for r in rows:
        hit = F.col(label) == F.lit(r[label])
        weight = F.when(hit, F.lit(r["weight"])) if weight is None else weight.when(hit, F.lit(r["weight"]))
    total = sum(r["n_c"] * r["weight"] for r in rows)
    return weight, total


# --------------------------------------------------------- K2-K4, K7 pipeline
def build_pipeline(roles: FrameRoles, reg_param: float, max_iter: int = MAX_ITER,
                   tol: float = 1e-7) -> Pipeline:
    """Index -> one-hot -> assemble (numeric first) -> weighted L2 logistic regression.

    ``handleInvalid="keep"`` puts unseen and null categories in an extra
    last index that ``dropLast=True`` removes, so they encode as all zeros.
    ``standardization=False`` penalises on the original scale, and
    ``reg_param = 1 / (C * sum of weights)`` gives the same optimum as an
    objective ``0.5*|w|^2 + C * sum(weight_i * loss_i)``.
    """
    idx_cols = [f"{c}__idx" for c in roles.categorical]
    ohe_cols = [f"{c}__ohe" for c in roles.categorical]
    stages = [
        StringIndexer(inputCols=list(roles.categorical), outputCols=idx_cols,
                      handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=idx_cols, outputCols=ohe_cols, dropLast=True),
        VectorAssembler(inputCols=list(roles.numeric) + ohe_cols, outputCol="features",
                        handleInvalid="keep"),
        LogisticRegression(featuresCol="features", labelCol=LABEL, weightCol="weight",
                           maxIter=max_iter, regParam=reg_param, elasticNetParam=0.0,
                           standardization=False, fitIntercept=True, tol=tol, threshold=0.5),
    ]
    return Pipeline(stages=stages)


def feature_pipeline(roles: FrameRoles) -> Pipeline:
    """The encoding stages alone (index, one-hot, assemble)."""
    stages = build_pipeline(roles, reg_param=0.0).getStages()[:-1]
    return Pipeline(stages=stages)


def fit_model(train: DataFrame, roles: FrameRoles, c: float = C, max_iter: int = MAX_ITER) -> PipelineModel:
    """Fit the whole pipeline on the training rows only (no leakage).

    A null in a numeric feature fails the fit with the column's name.  The
    model is written and read again: a fitted one holds its session in its
    training summary, and tasks cannot take it along once the session has
    observed a query (``Observation``).
    """
    weight, total_weight = weight_column(train)
    weighted = train.withColumns({"weight": weight} | {
        name: F.coalesce(name, F.raise_error(F.lit(f"null in numeric feature {name}")).cast("double"))
        for name in roles.numeric})
    fitted = build_pipeline(roles, reg_param=1.0 / (c * total_weight), max_iter=max_iter).fit(weighted)
    path = shared_dir(train.sparkSession, "models")
    fitted.write().overwrite().save(path)
    return PipelineModel.load(path)


def coefficients(model: PipelineModel, roles: FrameRoles, frame: DataFrame) -> DataFrame:
    """Intercept and one coefficient per vector slot, with the slot's name."""
    lr = model.stages[-1]
    indexer = model.stages[0]
    names = list(roles.numeric)
    for col, labels in zip(roles.categorical, indexer.labelsArray):
        names += [f"{col}_{v}" for v in labels]
    rows = [("intercept", -1, float(lr.intercept))] + [
        (n, i, float(w)) for i, (n, w) in enumerate(zip(names, lr.coefficients.toArray()))
    ]
    return frame.sparkSession.createDataFrame(rows, "term string, slot int, coefficient double")


def optimality(model: PipelineModel, roles: FrameRoles, train: DataFrame, c: float = C) -> DataFrame:
    """Per term: the penalised gradient of the mean loss on the training rows.

    The objective is ``(0.5*|w|^2 / C + sum(weight * loss)) / sum(weight)``;
    each slot's gradient is divided by the feature's largest absolute value
    (1 at least), so it is about 0 at the optimum whatever the units.  One
    pass over the rows, summed per slot before the shuffle.
    """
    weight, total_weight = weight_column(train)
    scored = model.transform(train.withColumn("weight", weight)).select(
        (F.col("weight") * (F.element_at(vector_to_array("probability"), 2) - F.col(LABEL))).alias("r"),
        F.concat(F.array(F.lit(1.0)), vector_to_array("features")).alias("x"))
    sums = scored.select("r", F.posexplode("x").alias("j", "xj")).groupBy("j").agg(
        F.sum(F.col("r") * F.col("xj")).alias("g"), F.max(F.abs("xj")).alias("scale"))
    penalty = F.when(F.col("slot") < 0, 0.0).otherwise(F.col("coefficient") / c)
    # one row per slot on both sides
    return coefficients(model, roles, train).join(sums, F.col("slot") == F.col("j") - 1).select(
        "term", "slot", "coefficient",
        ((F.col("g") + penalty) / (F.lit(total_weight) * F.greatest(F.lit(1.0), "scale"))).alias("gradient"))


def linear_score(model: PipelineModel, roles: FrameRoles) -> Column:
    """``b + sum(w_j * x_j)`` on the model frame's own columns; a category without a slot adds 0."""
    lr = model.stages[-1]
    weights = iter(lr.coefficients.toArray().tolist())
    z = F.lit(float(lr.intercept))
    for name in roles.numeric:
        z = z + F.lit(next(weights)) * F.col(name)
    for name, labels in zip(roles.categorical, model.stages[0].labelsArray):
        for label in labels:
            z = z + F.when(F.col(name) == label, F.lit(next(weights))).otherwise(0.0)
    return z


def predictions(model: PipelineModel, frame: DataFrame) -> DataFrame:
    scored = model.transform(frame)
    return scored.select(
        KEY, LABEL, "prediction",
        F.element_at(vector_to_array(F.col("probability")), 2).alias("probability"),
    )


# -------------------------------------------------------------- K9-K11 metrics
def confusion_counts(pred: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """Dense k x k confusion counts over the labels seen in truth or prediction."""
    # the only pass over the data; the k x k result is materialised so the
    # grid, the report and the averages below never rescan the predictions
    counts = cut_lineage(pred.groupBy(F.col(label).alias("truth"), F.col(prediction).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")))
    seen = counts.select(F.col("truth").alias("v")).union(counts.select(F.col("predicted").alias("v")))
    grid = (
        seen.agg(F.sort_array(F.collect_set("v")).alias("vs"))   # at most k values
        .select(F.explode("vs").alias("truth"), "vs")
        .select("truth", F.explode("vs").alias("predicted"))
    )
    return grid.join(counts, ["truth", "predicted"], "left").select(
        "truth", "predicted", F.coalesce("n", F.lit(0)).alias("n"))


def accuracy(pred: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    return pred.agg(
        F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"),
        F.count(F.lit(1)).alias("n"),
    )


def classification_report(confusion: DataFrame) -> DataFrame:
    """Per-class precision / recall / F1 / support, then accuracy, macro and
    weighted averages -- computed on the k x k confusion counts.

    A zero denominator gives 0 (``zero_division`` default behaviour without
    the warning).  F1 = 2tp / (2tp + fp + fn).
    """
    tp = F.sum(F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(0))
    per_truth = confusion.groupBy(F.col("truth").alias("cls")).agg(
        tp.alias("tp"), F.sum("n").alias("support"))
    per_pred = confusion.groupBy(F.col("predicted").alias("cls")).agg(F.sum("n").alias("n_pred"))
    m = per_truth.join(per_pred, "cls")
    ratio = lambda a, b: F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b)
    fp = F.col("n_pred") - F.col("tp")
    fn = F.col("support") - F.col("tp")
    per_class = m.select(
        F.col("cls").cast("string").alias("row_label"),
        ratio(F.col("tp"), F.col("n_pred")).alias("precision"),
        ratio(F.col("tp"), F.col("support")).alias("recall"),
        ratio(2 * F.col("tp"), 2 * F.col("tp") + fp + fn).alias("f1_score"),
        F.col("support").cast("long").alias("support"),
        F.col("tp"),
    )
    tot = F.sum("support")
    summary = per_class.agg(
        (F.sum("tp").cast("double") / tot).alias("acc"),
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1_score").alias("mf"),
        (F.sum(F.col("precision") * F.col("support")) / tot).alias("wp"),
        (F.sum(F.col("recall") * F.col("support")) / tot).alias("wr"),
        (F.sum(F.col("f1_score") * F.col("support")) / tot).alias("wf"),
        tot.cast("long").alias("n"),
    )
    def row(label, p, r, f):
        return F.struct(F.lit(label).alias("row_label"), p.cast("double").alias("precision"),
                        r.cast("double").alias("recall"), f.alias("f1_score"), F.col("n").alias("support"))

    none = F.lit(None)
    rows = summary.select(F.explode(F.array(
        row("accuracy", none, none, F.col("acc")),
        row("macro avg", F.col("mp"), F.col("mr"), F.col("mf")),
        row("weighted avg", F.col("wp"), F.col("wr"), F.col("wf")),
    )).alias("r")).select("r.*")
    return per_class.drop("tp").unionByName(rows)


def report_consistency(report: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """Each report row with ``consistent``: F1 from precision and recall per class,
    accuracy as the support-weighted recall, averages from the class rows.
    The report has one row per class and three more, so the window is tiny."""
    everything = Window.partitionBy()
    is_class = ~F.col("row_label").isin("accuracy", "macro avg", "weighted avg")

    def mean(name: str) -> Column:
        return F.avg(F.when(is_class, F.col(name))).over(everything)

    def weighted(name: str) -> Column:
        return (F.sum(F.when(is_class, F.col(name) * F.col("support"))).over(everything)
                / F.sum(F.when(is_class, F.col("support"))).over(everything))

    def near(a: Column, b: Column) -> Column:
        return F.abs(a - b) <= tolerance

    p, r, f = F.col("precision"), F.col("recall"), F.col("f1_score")
    averages = {"macro avg": mean, "weighted avg": weighted}
    rule = F.when(is_class, near(f * (p + r), 2 * p * r)).when(F.col("row_label") == "accuracy", near(f, weighted("recall")))
    for label, of in averages.items():
        rule = rule.when(F.col("row_label") == label, near(p, of("precision")) & near(r, of("recall")) & near(f, of("f1_score")))
    return report.withColumn("consistent", rule)


# ------------------------------------------------------------ H10 fixed score
# --- fixed values: a fixed linear score used to test the metric queries ---
FIXED_SCORE = (
    ("intercept", 0.5),
    ("tenure_mois", -0.02),
    ("ratio_retards_paiement", 1.5),
    ("nb_contacts_resiliation", 0.3),
    ("connexions_moy_3derniers_mois", -0.001),
)


def score_linear(frame: DataFrame, terms=FIXED_SCORE) -> DataFrame:
    """``z = b + sum(w_j * x_j)``; prediction 1 when ``z > 0``; probability ``1/(1+e^-z)``."""
    z = F.lit(terms[0][1])
    for name, w in terms[1:]:
        z = z + F.lit(w) * F.col(name).cast("double")
    return frame.select(
        KEY, LABEL, z.alias("score"),
        F.when(z > 0, 1.0).otherwise(0.0).alias("prediction"),
        (F.lit(1.0) / (F.lit(1.0) + F.exp(-z))).alias("probability"),
    )

