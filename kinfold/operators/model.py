"""The match classifier: training, scoring, saving."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import FEATURES
from . import metrics
from .blocking import S1
from .features import split_groups


@dataclass(frozen=True)
class Settings:
    """Boosting parameters. `trees` 350 is the full setting; boosting here has no L2 penalty on leaf weights."""

    trees: int = 350
    depth: int = 5
    rate: float = 0.05
    rows: float = 0.85
    columns: float = 0.90
    least: int = 2
    seed: int = 42


#: The large-sample trainer: its boosting parameters and its threshold, which is not tuned.
LARGE_THRESHOLD = 0.88
LARGE_SAMPLE = Settings(trees=300, depth=6, rate=0.08, columns=0.85)


@dataclass
class Matcher:
    """A fitted pipeline with its decision threshold."""

    model: PipelineModel
    threshold: float = 0.5
    settings: Settings = Settings()

    def score(self, features: DataFrame) -> DataFrame:
        """Adds probability, of being a match."""
        scored = self.model.transform(features).withColumn("probability_", vector_to_array("probability")[1])
        return scored.drop("features", "rawPrediction", "prediction", "probability").withColumnRenamed("probability_", "probability")

    def decide(self, features: DataFrame) -> DataFrame:
        return self.score(features).withColumn("predicted", F.col("probability") >= self.threshold)

    def importances(self) -> dict[str, float]:
        return dict(zip(FEATURES, self.model.stages[-1].featureImportances.toArray().tolist(), strict=True))

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/pipeline")
        row = json.dumps({"threshold": self.threshold, "features": FEATURES, "settings": asdict(self.settings)})
        spark = SparkSession.getActiveSession()
        spark.createDataFrame([(row,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/bundle")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Matcher:
        row = json.loads(spark.read.text(f"{path}/bundle").first()["value"])
        return cls(PipelineModel.load(f"{path}/pipeline"), row["threshold"], Settings(**row["settings"]))


def fit(features: DataFrame, settings: Settings = Settings()) -> Matcher:
    """Trees on the thirteen features and `label`."""
    trees = GBTClassifier(
        labelCol="label", featuresCol="features", maxIter=settings.trees, maxDepth=settings.depth, stepSize=settings.rate,
        subsamplingRate=settings.rows, featureSubsetStrategy=str(settings.columns), minInstancesPerNode=settings.least, seed=settings.seed,
    )
    return Matcher(Pipeline(stages=[VectorAssembler(inputCols=list(FEATURES), outputCol="features"), trees]).fit(features), settings=settings)


def train(features: DataFrame, settings: Settings = Settings(), refit: bool = True) -> tuple[Matcher, DataFrame]:
    """(matcher, grid): fitted on the training groups, threshold of best macro F0.5 on the others, then fitted on all.

    Where either part would be empty, both are all pairs.
    """
    split = split_groups(features)
    sizes = {r["is_val"]: r["n"] for r in split.groupBy("is_val").agg(F.count("*").alias("n")).collect()}  # two rows
    train_rows, val_rows = (split.where("not is_val"), split.where("is_val")) if len(sizes) == 2 else (split, split)
    matcher = fit(train_rows, settings)
    scored = matcher.score(val_rows).select(F.col(S1).alias("s1"), "probability", "label")
    grid = metrics.macro_grid(scored)
    best = metrics.best_threshold(grid).first()
    final = fit(features, settings) if refit else matcher
    return Matcher(final.model, best["threshold"], settings), grid


def train_large(features: DataFrame, settings: Settings = LARGE_SAMPLE, threshold: float = LARGE_THRESHOLD) -> tuple[Matcher, DataFrame, dict]:
    """(matcher, sweep, metrics): fitted on the training groups, measured on the others at thresholds 0.50 to 0.95 and at the
    fixed one, then fitted on all. metrics holds rates, confusion counts, area under the curve and importances."""
    split = split_groups(features)
    held = fit(split.where("not is_val"), settings)
    scored = held.score(split.where("is_val")).select("probability", "label").persist()
    at = metrics.pair_metrics(scored, threshold).first()
    found = {"precision": at["precision"], "recall": at["recall"], "accuracy": at["accuracy"], "f05_score": at["f05"], "roc_auc": metrics.roc_auc(scored).first()["auc"]}
    found = {k: round(v, 6) for k, v in found.items()} | {"optimal_threshold": threshold}
    found |= {"true_positives": at["tp"], "false_positives": at["fp"], "true_negatives": at["tn"], "false_negatives": at["fn"]}
    grid = metrics.sweep(scored, 50, 95, 5)
    final = Matcher(fit(features, settings).model, threshold, settings)
    return final, grid, found | {"feature_importances": {k: round(v, 4) for k, v in final.importances().items()}}
