"""A distributed text classifier in the train, predict, evaluate chain."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import label_array


def fit_classifier(
    train: DataFrame, features: int = 1 << 16, iterations: int = 20, regularization: float = 0.01
) -> PipelineModel:
    """Fit a three-class model of hashed words on ``(text, label)`` records.

    The model's size depends on ``features`` only, not on the data.
    """
    coded = train.select(
        "text", (F.array_position(label_array(), F.col("label")) - 1).cast("double").alias("code")
    )
    stages = [
        RegexTokenizer(inputCol="text", outputCol="words", pattern=r"\W+"),
        HashingTF(inputCol="words", outputCol="counts", numFeatures=features),
        IDF(inputCol="counts", outputCol="weights"),
        LogisticRegression(
            featuresCol="weights",
            labelCol="code",
            family="multinomial",
            maxIter=iterations,
            regParam=regularization,
        ),
    ]
    return Pipeline(stages=stages).fit(coded)


def score_with_classifier(model: PipelineModel, records: DataFrame) -> DataFrame:
    """Prediction records with the most probable label and its probability.

    Scoring runs inside Spark together with other work, so rows carry no latency.
    """
    scored = model.transform(records).withColumn("p", vector_to_array("probability"))
    seen = F.slice(label_array(), 1, F.size("p"))
    best = F.array_position(F.col("p"), F.array_max("p"))
    return scored.select(
        F.col("id").cast("string").alias("id"),
        "label",
        F.element_at(seen, best.cast("int")).alias("prediction"),
        F.array_max("p").alias("confidence"),
        F.lit(0.0).alias("latency_ms"),
    )
