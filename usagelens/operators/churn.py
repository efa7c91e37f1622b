"""Churn classifier: gradient-boosted trees over user features."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.operators.boosting import BoostedTrees, fit_boosted_trees
from usagelens.operators.splits import stratified_split
from usagelens.session import materialize


@dataclass(frozen=True)
class ChurnModel:
    model: BoostedTrees
    features: tuple[str, ...]
    label: str
    test: DataFrame

    def predict(self, df: DataFrame) -> DataFrame:
        return self.model.transform(df.na.fill(0, subset=list(self.features)))

    def importances(self) -> DataFrame:
        """``feature, importance``, largest first: shares of the gain of all splits."""
        total = sum(self.model.gains) or 1.0
        rows = [(name, gain / total) for name, gain in zip(self.features, self.model.gains, strict=True)]
        spark = self.test.sparkSession
        return spark.createDataFrame(rows, "feature string, importance double").orderBy(
            F.desc("importance"), "feature"
        )

    def metrics(self) -> DataFrame:
        """Accuracy and ROC AUC measured on the test part."""
        scored = self.predict(self.test).select(self.label, "rawPrediction", "prediction")
        # The evaluators read it several times.
        return evaluate(materialize(scored, "churn-scores"), self.label)


def evaluate(predictions: DataFrame, label: str) -> DataFrame:
    # The evaluators would take a column called probability for a vector.
    predictions = predictions.select(label, "rawPrediction", "prediction")
    accuracy = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")
    auc = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC")
    values = [("accuracy", accuracy.evaluate(predictions)), ("roc_auc", auc.evaluate(predictions))]
    return predictions.sparkSession.createDataFrame(values, "metric string, value double")


def train_churn(
    df: DataFrame,
    features: Sequence[str],
    label: str = "churned",
    key: str = "user_id",
    test: float = 0.3,
    seed: int = 42,
    rounds: int = 100,
) -> ChurnModel:
    """Fit on the training part of a stratified split.

    Fails when either class is missing, instead of inventing labels.
    """
    features_once = materialize(df, "churn-features")
    split = materialize(stratified_split(features_once, label, key, test, seed), "churn-split")
    train, held_out = split.filter(~F.col("is_test")), split.filter("is_test")
    classes = {r[label] for r in train.select(label).distinct().limit(3).collect()}
    if classes != {0, 1}:
        raise ValueError(f"training needs both labels 0 and 1, found {sorted(classes)}")
    model = fit_boosted_trees(train.na.fill(0, subset=list(features)), features, label, rounds)
    return ChurnModel(model, tuple(features), label, held_out)
