"""Fits with Spark ML: regularised goal rates and outcome challengers (see ``fits`` and ``calibration`` for the others).

Every fit sees only the rows it is given (training or calibration block); every seed and
hyper-parameter is the caller's.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def side_rows(matches: DataFrame, weight: str | None = None) -> DataFrame:
    """Two rows per match: attacking team, defending team, home flag and goals."""
    w = F.lit(1.0) if weight is None else F.col(weight)
    sides = F.array(
        F.struct(F.col("home_team").alias("attack"), F.col("away_team").alias("defence"),
                 F.lit(1.0).alias("home"), F.col("home_goals").cast("double").alias("goals")),
        F.struct(F.col("away_team").alias("attack"), F.col("home_team").alias("defence"),
                 F.lit(0.0).alias("home"), F.col("away_goals").cast("double").alias("goals")),
    )
    return matches.select("match_id", w.alias("weight"), F.inline(sides))


def fit_goal_rates(training: DataFrame, regularization: float, weight: str | None = None) -> PipelineModel:
    """log(rate) = intercept + home + attack + defence, Poisson likelihood."""
    indexer = StringIndexer(inputCols=["attack", "defence"], outputCols=["a", "d"], handleInvalid="keep")
    encoder = OneHotEncoder(inputCols=["a", "d"], outputCols=["av", "dv"])
    assembler = VectorAssembler(inputCols=["home", "av", "dv"], outputCol="features")
    glm = GeneralizedLinearRegression(
        family="poisson", link="log", labelCol="goals", weightCol="weight", regParam=regularization
    )
    return Pipeline(stages=[indexer, encoder, assembler, glm]).fit(side_rows(training, weight))


def predict_goal_rates(model: PipelineModel, matches: DataFrame) -> DataFrame:
    """(match_id, home_rate, away_rate)."""
    scored = model.transform(side_rows(matches))
    return scored.groupBy("match_id").agg(
        F.max(F.when(F.col("home") == 1.0, F.col("prediction"))).alias("home_rate"),
        F.max(F.when(F.col("home") == 0.0, F.col("prediction"))).alias("away_rate"),
    )


def fit_outcome_logistic(training: DataFrame, features: Sequence[str], label: str, regularization: float) -> PipelineModel:
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    model = LogisticRegression(family="multinomial", labelCol=label, regParam=regularization)
    return Pipeline(stages=[assembler, model]).fit(training)


def outcome_probabilities(model: PipelineModel, rows: DataFrame, names: Sequence[str]) -> DataFrame:
    p = vector_to_array(F.col("probability"))
    scored = model.transform(rows).withColumn("_p", p)
    return scored.select(*rows.columns, *[F.get("_p", F.lit(i)).alias(n) for i, n in enumerate(names)])


def fit_outcome_boosting(
    training: DataFrame, features: Sequence[str], label: str, classes: int, iterations: int, depth: int, seed: int
) -> list[PipelineModel]:
    """One boosted model per class against the rest."""
    models = []
    for c in range(classes):
        one = training.withColumn("_is", (F.col(label) == c).cast("double"))
        assembler = VectorAssembler(inputCols=list(features), outputCol="features")
        gbt = GBTClassifier(labelCol="_is", maxIter=iterations, maxDepth=depth, seed=seed)
        models.append(Pipeline(stages=[assembler, gbt]).fit(one))
    return models


def boosting_probabilities(models: Sequence[PipelineModel], rows: DataFrame, names: Sequence[str]) -> DataFrame:
    scored = rows
    for i, model in enumerate(models):
        kept = scored.columns
        scored = model.transform(scored).select(
            *kept, F.get(vector_to_array(F.col("probability")), F.lit(1)).alias(f"_raw{i}")
        )
    total = sum((F.col(f"_raw{i}") for i in range(len(models))), F.lit(0.0))
    return scored.select(*rows.columns, *[(F.col(f"_raw{i}") / total).alias(n) for i, n in enumerate(names)])
