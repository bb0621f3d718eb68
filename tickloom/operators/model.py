"""Boosted-tree classifier over the feature matrix."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.features import FEATURES
from tickloom.session import use_checkpoints


@dataclass(frozen=True)
class ModelSpec:
    trees: int = 300
    depth: int = 5
    learning_rate: float = 0.05
    row_share: float = 0.8
    column_share: float = 0.8
    seed: int = 42


def train(rows: DataFrame, spec: ModelSpec = ModelSpec()) -> PipelineModel:
    """Fit on a feature matrix; positives weigh as much as all negatives together."""
    use_checkpoints(rows.sparkSession)
    counts = rows.agg(
        F.count_if(F.col("label") == 0).alias("neg"), F.count_if(F.col("label") == 1).alias("pos")
    ).first()
    scale = counts["neg"] / max(counts["pos"], 1)
    weight = F.when(F.col("label") == 1, F.lit(scale)).otherwise(1.0)
    trees = GBTClassifier(
        labelCol="label",
        weightCol="weight",
        maxIter=spec.trees,
        maxDepth=spec.depth,
        stepSize=spec.learning_rate,
        subsamplingRate=spec.row_share,
        featureSubsetStrategy=str(spec.column_share),
        seed=spec.seed,
        checkpointInterval=10,
    )
    steps = [VectorAssembler(inputCols=FEATURES, outputCol="features"), trees]
    return Pipeline(stages=steps).fit(rows.withColumn("weight", weight))


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Add class, probability of a rise, and the decision with its confidence.

    Works on batch and streaming tables.
    """
    probability = vector_to_array("probability")[1]
    return (
        model.transform(rows)
        .withColumn("score", probability)
        .withColumn("decision", F.when(F.col("score") >= 0.5, "BUY").otherwise("HOLD"))
        .withColumn("confidence", F.col("score"))
        .withColumn("prediction", F.col("prediction").cast("int"))
        .drop("features", "rawPrediction", "probability")
    )


def importances(model: PipelineModel, spark: SparkSession, top: int = 10) -> DataFrame:
    """The `top` features by importance."""
    values = model.stages[-1].featureImportances.toArray()
    pairs = [(name, float(value)) for name, value in zip(FEATURES, values)]
    table = spark.createDataFrame(pairs, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(top)


def save_model(model: PipelineModel, path: str, spark: SparkSession) -> None:
    """Write the model and, beside it, one row that describes its input."""
    model.write().overwrite().save(f"{path}/model")
    described = spark.createDataFrame(
        [(FEATURES, len(FEATURES), type(model.stages[-1]).__name__, "spark-ml")],
        "feature_names array<string>, n_features int, model_type string, framework string",
    )
    described.coalesce(1).write.mode("overwrite").json(f"{path}/metadata")


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(f"{path}/model")
