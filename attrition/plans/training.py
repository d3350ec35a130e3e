"""Train, evaluate and save the attrition model (distributed Spark ML).

Order of work, and why it differs from a single-machine script:
1. the model frame is cut from its lineage (reliable checkpoint into the
   shared checkpoint folder) -- the fit below scans it once per optimiser
   iteration, and a lost executor must not replay the feature plan;
2. the exact stratified split comes *first*;
3. the whole pipeline (indexers, one-hot, assembler, classifier) is fitted
   on the training rows only, so no test category leaks into the encoder,
   and the saved model carries its encoder;
4. metrics are one ``groupBy`` over the test predictions.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from attrition.operators import ml, newton
from attrition.session import cut_lineage


@dataclass
class TrainingResult:
    model: PipelineModel
    roles: ml.FrameRoles
    split: DataFrame
    predictions: DataFrame

    @cached_property
    def confusion(self) -> DataFrame:
        return ml.confusion_counts(self.predictions)

    @property
    def report(self) -> DataFrame:
        return ml.classification_report(self.confusion)

    @property
    def accuracy(self) -> DataFrame:
        return ml.accuracy(self.predictions)


def prepare(features: DataFrame, checkpoint: bool = True) -> tuple[DataFrame, ml.FrameRoles]:
    """Model frame (checkpointed: the split reads it twice) and the split
    (checkpointed: the fit reads it once per iteration)."""
    frame = ml.model_frame(features)
    if checkpoint:
        frame = cut_lineage(frame)
    roles = ml.column_roles(frame, drop=(ml.KEY, ml.LABEL))
    split = ml.stratified_split(frame)
    return (cut_lineage(split) if checkpoint else split), roles


def train_and_evaluate(features: DataFrame, c: float = ml.C, max_iter: int = ml.MAX_ITER,
                       checkpoint: bool = True) -> TrainingResult:
    split, roles = prepare(features, checkpoint)
    train = split.filter("split = 'train'")
    test = split.filter("split = 'test'")
    model = ml.fit_model(train, roles, c=c, max_iter=max_iter)
    return TrainingResult(model=model, roles=roles, split=split, predictions=ml.predictions(model, test))


@dataclass
class NewtonResult:
    """What :func:`train_newton` gives; ``predictions`` hold score, probability and prediction of the held-out rows."""

    fit: newton.NewtonFit
    model: PipelineModel
    roles: ml.FrameRoles
    split: DataFrame
    predictions: DataFrame

    @property
    def terms(self) -> DataFrame:
        return newton.terms(self.fit, self.split)

    @property
    def report(self) -> DataFrame:
        return ml.classification_report(ml.confusion_counts(self.predictions))


def train_newton(features: DataFrame, c: float = ml.C) -> NewtonResult:
    """As :func:`train_and_evaluate`, fitted to the optimum by Newton steps."""
    split, roles = prepare(features)
    found = newton.fit(split.filter("split = 'train'"), roles, c=c)
    model = newton.as_pipeline(found, roles)
    return NewtonResult(found, model, roles, split, model.transform(split.filter("split = 'test'")))


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def train_from_csv(spark, path: str, key_type=None, **kwargs) -> TrainingResult:
    """Dataset file -> split, fit, predict, metrics (the training script's flow)."""
    from pyspark.sql import types as T

    from attrition.plans.dataset import read_dataset
    return train_and_evaluate(read_dataset(spark, path, key_type or T.StringType()), **kwargs)
