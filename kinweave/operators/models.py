"""Scorers of pairs. A scorer has fit(features, names) and predict(features), which adds match_probability."""
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.85


class Scorer(Protocol):
    def fit(self, features: DataFrame, names, label: str = "label") -> "Scorer": ...

    def predict(self, features: DataFrame) -> DataFrame: ...


def make(factory, seed: int = 42) -> Scorer:
    """A scorer from a factory that takes a seed, or else nothing."""
    try:
        return factory(seed=seed)
    except TypeError:
        return factory()


def check_features(features: DataFrame, names, label: str | None = None) -> None:
    missing = [n for n in (*names, *([label] if label else [])) if n not in features.columns]
    if missing:
        raise ValueError(f"features lack columns: {', '.join(missing)}")


def scores(model: Scorer, features: DataFrame) -> DataFrame:
    """Ids and match_probability of pairs."""
    return model.predict(features).select("source1_entity_id", "candidate_entity_id", "match_probability")


def coefficients(model, names) -> DataFrame:
    """(feature, coefficient, absolute_coefficient) of a linear model by falling size; no rows for others."""
    from pyspark.sql import SparkSession

    found = getattr(model, "coef_", None)
    rows = [] if found is None else [(n, float(c), abs(float(c))) for n, c in zip(names, np.ravel(found))]
    rows.sort(key=lambda r: -r[2])
    return SparkSession.active().createDataFrame(rows, "feature string, coefficient double, absolute_coefficient double")


class BestOf:
    """The largest of the features as score; learns nothing."""

    def fit(self, features: DataFrame, names, label: str = "label") -> "BestOf":
        check_features(features, names)
        self.names = list(names)
        return self

    def predict(self, features: DataFrame) -> DataFrame:
        return features.withColumn("match_probability", F.greatest(*self.names) if len(self.names) > 1 else F.col(self.names[0]))


class LogisticScorer:
    """Balanced logistic regression with L2 on weights and intercept, by Newton steps over Spark aggregates.

    A step moves one small Hessian per partition to the driver, never rows.
    Without rows the score is 0, with one class that class. The solution is
    unique, so the seed changes nothing.
    """

    class_weight = "balanced"

    def __init__(self, seed: int = 42, steps: int = 25, tolerance: float = 1e-10):
        self.random_state, self.max_iter, self.tolerance, self.constant, self.coef_ = seed, steps, tolerance, None, None

    def fit(self, features: DataFrame, names, label: str = "label") -> "LogisticScorer":
        check_features(features, names, label)
        self.names = list(names)
        counts = {r[0]: r[1] for r in features.groupBy(label).count().collect()}
        if len(counts) < 2:
            self.constant = float(next(iter(counts), 0))
            return self
        total, k = sum(counts.values()), len(self.names) + 1
        weight = {c: total / (2 * n) for c, n in counts.items()}
        rows, beta = features.select(*self.names, F.col(label).alias("__y")).persist(), np.zeros(k)
        for _ in range(self.max_iter):
            def part(frames, beta=beta):
                g, h = np.zeros(k), np.zeros((k, k))
                for f in frames:
                    x = np.column_stack([f[self.names].to_numpy(dtype=float), np.ones(len(f))])
                    y = f["__y"].to_numpy(dtype=float)
                    w, p = f["__y"].map(weight).to_numpy(dtype=float), 1 / (1 + np.exp(-np.clip(x @ beta, -500, 500)))
                    g += x.T @ (w * (p - y))
                    h += (x * (w * p * (1 - p))[:, None]).T @ x
                yield pd.DataFrame({"i": np.arange(k * k + k), "v": np.concatenate([g, h.ravel()])})

            v = rows.mapInPandas(part, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).toPandas().sort_values("i")["v"].to_numpy()
            move = np.linalg.solve(v[k:].reshape(k, k) + np.eye(k), v[:k] + beta)
            beta = beta - move
            if np.abs(move).max() < self.tolerance:
                break
        rows.unpersist()
        self.coef_, self.intercept_ = beta[:-1], float(beta[-1])
        return self

    def predict(self, features: DataFrame) -> DataFrame:
        check_features(features, getattr(self, "names", ()))
        if self.constant is None and self.coef_ is None:
            raise RuntimeError("fit first")
        if self.constant is not None:
            p = F.lit(self.constant)
        else:
            z = sum((F.col(n) * float(b) for n, b in zip(self.names, self.coef_)), F.lit(self.intercept_))
            p = 1 / (1 + F.exp(-z))
        return features.withColumn("match_probability", p)


class BoostedScorer:
    """Spark's gradient-boosted trees; needs both classes."""

    def __init__(self, seed: int = 42, rounds: int = 300):
        self.seed = self.random_state = seed
        self.rounds, self.model, self.coef_ = rounds, None, None

    def fit(self, features: DataFrame, names, label: str = "label") -> "BoostedScorer":
        from pyspark.ml.classification import GBTClassifier
        from pyspark.ml.feature import VectorAssembler

        check_features(features, names, label)
        if features.select(label).distinct().count() < 2:
            raise ValueError("training needs both positive and negative labels")
        self.assembler = VectorAssembler(inputCols=list(names), outputCol="__x")
        gbt = GBTClassifier(featuresCol="__x", labelCol=label, stepSize=0.05, maxIter=self.rounds, maxDepth=5, minInstancesPerNode=20, maxBins=255, seed=self.seed)
        self.model = gbt.fit(self.assembler.transform(features))
        return self

    def predict(self, features: DataFrame) -> DataFrame:
        from pyspark.ml.functions import vector_to_array

        if self.model is None:
            raise RuntimeError("fit first")
        out = self.model.transform(self.assembler.transform(features))
        return out.withColumn("match_probability", vector_to_array("probability")[1]).drop("__x", "rawPrediction", "probability", "prediction")
