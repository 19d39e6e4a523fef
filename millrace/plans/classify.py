"""Text classification: tokens, stop words, hashed counts, logistic regression."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, StopWordsRemover, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_text
from ..session import settle

# Number of hashed features, iterations and regularisation of the classifier.
FEATURES = 20
MAX_ITER = 10
REG_PARAM = 0.001


def cleaned(df: DataFrame, text: Column, *keep: Column) -> DataFrame:
    """(keep, clean_description); rows without text are dropped, as the tokenizer cannot take NULL."""
    return df.where(text.isNotNull()).select(*keep, clean_text(text).alias("clean_description"))


def hashing_stages(text_col: str = "clean_description", features: int = FEATURES) -> list:
    return [
        Tokenizer(inputCol=text_col, outputCol="words"),
        StopWordsRemover(inputCol="words", outputCol="words_without_stopwords"),
        HashingTF(inputCol="words_without_stopwords", outputCol="features", numFeatures=features),
    ]


def train(rows: DataFrame, features: int = FEATURES) -> PipelineModel:
    """Fit on (label, clean_description). Features are written once, as the regression reads its rows several times."""
    hashing = Pipeline(stages=hashing_stages(features=features)).fit(rows)
    ready = settle(hashing.transform(rows).select("label", "features"), "features")
    regression = LogisticRegression(maxIter=MAX_ITER, regParam=REG_PARAM).fit(ready)
    return PipelineModel(stages=[*hashing.stages, regression])


def score(model: PipelineModel, rows: DataFrame, *keep: str) -> DataFrame:
    """(keep, clean_description, probability, prediction), the probability as an array."""
    return model.transform(rows).select(
        *keep, "clean_description", vector_to_array("probability").alias("probability"), "prediction"
    )


def accuracy(scored: DataFrame) -> DataFrame:
    """(n, n_correct, accuracy) of scored rows that still carry their label."""
    hit = (F.col("prediction") == F.col("label")).cast("int")
    return scored.agg(
        F.count("*").alias("n"), F.sum(hit).alias("n_correct"), F.round(F.avg(hit), 6).alias("accuracy")
    )
