"""Baseline classifier on dense features: multinomial logistic regression."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from invoicelake.operators.metrics import accuracy_macro_f1

# Inverse penalty and iteration limit.
C = 1.0
MAX_ITER = 3000


def _vectors(rows: DataFrame, features: str) -> DataFrame:
    return rows.withColumn("features", array_to_vector(F.col(features).cast("array<double>")))


def fit_baseline(train: DataFrame, features: str, label: str = "label") -> LogisticRegressionModel:
    """Ridge-penalised fit on unscaled features; the penalty does not grow with the number of rows."""
    rows = _vectors(train, features).select("features", F.col(label).cast("double").alias("label"))
    n = rows.count()
    return LogisticRegression(family="multinomial", regParam=1.0 / (C * n), elasticNetParam=0.0,
                              standardization=False, maxIter=MAX_ITER).fit(rows)


def predict(model: LogisticRegressionModel, rows: DataFrame, features: str) -> DataFrame:
    scored = model.setPredictionCol("_p").transform(_vectors(rows, features))
    return scored.withColumn("prediction", F.col("_p").cast("int")).drop("_p", "features", "rawPrediction", "probability")


def baseline_scores(rows: DataFrame, split: DataFrame, key: str, features: str, label: str = "label",
                    condition: str | None = None) -> DataFrame:
    """Fit on 'train', report accuracy and macro F1 on 'test', per condition when given."""
    parts = rows.join(split, key)
    model = fit_baseline(parts.filter("split = 'train'"), features, label)
    test = predict(model, parts.filter("split = 'test'"), features)
    test = test.withColumn("condition", F.lit("all") if condition is None else F.col(condition).cast("string"))
    return accuracy_macro_f1(test, ["condition"], label, "prediction").select(
        F.lit("logreg").alias("model"), "condition", "acc", "macro_f1")
