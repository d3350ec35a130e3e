"""Class-weighted, L2-penalised logistic regression by distributed Newton steps.

Each step is one aggregate over the training rows: every task adds up its part of the Hessian
``X' W X``, the gradient and the loss (an Arrow batch at a time), the parts are summed by
Spark, and the driver solves one system with as many unknowns as the model has terms.  Columns are scaled by their
largest absolute value first, so the system is well conditioned whatever the units; the penalty stays on the original
scale: ``0.5 * |w|^2 / C + sum(weight * loss)`` without the intercept, as in
:func:`attrition.operators.ml.fit_model`.  A step that raises the objective is halved.

The state is (terms + 1)^2 numbers, bounded by the model: beyond ``MOST_TERMS`` terms use
:func:`attrition.operators.ml.fit_model`, which needs gradients only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.operators import ml

MOST_TERMS = 4096
MAX_STEPS, TOLERANCE = 50, 1e-12


@dataclass(frozen=True)
class NewtonFit:
    names: tuple[str, ...]          # one per slot of the assembled vector
    intercept: float
    coefficients: np.ndarray
    scale: np.ndarray               # largest absolute value of each slot in training (1 where all are 0)
    steps: int
    gradient: float                 # largest entry of the scaled mean gradient at the end


def _parts(beta: np.ndarray, scale: np.ndarray):
    """One row per task: Hessian, gradient and loss of its rows at ``beta``, flattened."""
    d = len(beta)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(d * d + d + 1)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.ones((batch.num_rows, d))
            x[:, 1:] = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, d - 1) / scale
            y, w = (batch.column(k).to_numpy(zero_copy_only=False) for k in (1, 2))
            z = x @ beta
            p = 1 / (1 + np.exp(-z))
            total[:d * d] += (x.T @ (x * (w * p * (1 - p))[:, None])).ravel()
            total[d * d:-1] += x.T @ (w * (p - y))
            total[-1] += float((w * (np.logaddexp(0, z) - y * z)).sum())
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["cell", "value"])
    return run


def _sums(rows: DataFrame, beta: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    d = len(beta)
    cells = rows.mapInArrow(_parts(beta, scale), "cell bigint, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    out = np.zeros(d * d + d + 1)
    for r in cells.collect():       # (terms + 1)^2 numbers
        out[r["cell"]] = r["value"]
    return out[:d * d].reshape(d, d), out[d * d:-1], float(out[-1])


def fit(train: DataFrame, roles: ml.FrameRoles, c: float = ml.C, max_steps: int = MAX_STEPS) -> NewtonFit:
    """Encoder and coefficients from the training rows only (pass a materialized frame: one scan a step).

    A null in a numeric feature fails the fit with the column's name; no rows or one class only is an error of the caller.
    """
    weight, total_weight = ml.weight_column(train)
    checked = train.withColumns({
        name: F.coalesce(name, F.raise_error(F.lit(f"null in numeric feature {name}")).cast("double")) for name in roles.numeric})
    encoder = ml.feature_pipeline(roles).fit(checked)
    names = list(roles.numeric)
    for column, labels in zip(roles.categorical, encoder.stages[0].labelsArray, strict=True):
        names += [f"{column}_{v}" for v in labels]
    if len(names) > MOST_TERMS:
        raise ValueError(f"{len(names)} terms: Newton steps hold their square in memory, use fit_model")
    rows = encoder.transform(checked).select(vector_to_array("features").alias("x"), F.col(ml.LABEL).alias("y"), weight.alias("w"))
    tops = rows.select(F.posexplode("x").alias("slot", "v")).groupBy("slot").agg(F.max(F.abs("v")).alias("top")).collect()
    scale = np.ones(len(names))
    for r in tops:      # one row per slot
        scale[r["slot"]] = r["top"] or 1.0
    penalty = np.append(0.0, 1 / (c * scale**2))
    beta, accepted, step = np.zeros(len(names) + 1), None, None
    for number in range(1, max_steps + 1):
        hessian, gradient, loss = _sums(rows, beta, scale)
        objective = loss + 0.5 * float(penalty @ beta**2)
        if accepted is not None and objective > accepted[1] * (1 + 1e-12):
            step = step / 2
            beta = accepted[0] + step
            continue
        accepted = beta, objective
        gradient = gradient + penalty * beta
        if np.abs(gradient).max() <= TOLERANCE * total_weight:
            break
        step = -np.linalg.solve(hessian + np.diag(penalty), gradient)
        beta = beta + step
    beta = accepted[0]
    return NewtonFit(tuple(names), float(beta[0]), beta[1:] / scale, scale, number, float(np.abs(gradient).max() / total_weight))


def terms(found: NewtonFit, df: DataFrame) -> DataFrame:
    """term, slot (-1: intercept), coefficient, effect (the coefficient at the largest absolute value seen in training)."""
    rows = [("intercept", -1, found.intercept, found.intercept)] + [
        (n, k, float(w), float(w * s)) for k, (n, w, s) in enumerate(zip(found.names, found.coefficients, found.scale, strict=True))]
    return df.sparkSession.createDataFrame(rows, "term string, slot int, coefficient double, effect double")


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def as_pipeline(found: NewtonFit, roles: ml.FrameRoles) -> PipelineModel:
    """The fitted model as one SQL stage over the model frame's own columns, which saves and loads like any
    pipeline: adds score, probability and prediction.  An unseen or null category adds nothing."""
    weights = iter(zip(found.names, found.coefficients.tolist(), strict=True))
    parts = [f"{found.intercept!r}D"]
    for name in roles.numeric:
        parts.append(f"({next(weights)[1]!r}D) * `{name}`")
    for name, w in weights:
        column = next(c for c in roles.categorical if name.startswith(c + "_"))
        parts.append(f"CASE WHEN `{column}` = {_literal(name[len(column) + 1:])} THEN {w!r}D ELSE 0D END")
    score = " + ".join(parts)
    statement = (f"SELECT *, 1D / (1D + exp(-score)) AS probability, CASE WHEN score > 0 THEN 1D ELSE 0D END AS prediction "
                 f"FROM (SELECT *, {score} AS score FROM __THIS__)")
    return PipelineModel([SQLTransformer(statement=statement)])
