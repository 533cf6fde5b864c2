"""Two-branch neural classifier: averaged sub-word embeddings next to scaled features.

Both branches meet in a multilayer perceptron of Spark ML. It is no recurrent
network: the order of the tokens is averaged out, and its trainer takes no
class weights; ``network`` has its own.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.feature import VectorAssembler, Word2Vec
from pyspark.sql import DataFrame

from quillsift.operators.linear import TextModel
from quillsift.operators.subword import Subwords
from quillsift.operators.vectors import scaler_stages


WHOLE = 1_000_000_000


def fit_neural(
    table: DataFrame,
    subwords: Subwords,
    features: list[str],
    embedding_dim: int = 64,
    dense_units: int = 32,
    max_iter: int = 15,
    rows_per_part: int = 20_000,
    seed: int = 42,
) -> TextModel:
    """Fit on a training table; the embedding table is bounded by the vocabulary size.

    The embedding is trained in as many parts as the rows ask for, on whole messages.
    """
    embedding = Word2Vec(
        vectorSize=embedding_dim, minCount=0, seed=seed, numPartitions=1 + table.count() // rows_per_part, maxSentenceLength=WHOLE,
        inputCol="tokens", outputCol="embedded",
    ).fit(table)
    numeric = scaler_stages(table, features) if features else []
    parts = ["embedded", *(["scaled"] if features else [])]
    stages = [embedding, *numeric, VectorAssembler(inputCols=parts, outputCol="features")]
    vectors = PipelineModel(stages).transform(table).select("features", "Label")
    network = MultilayerPerceptronClassifier(
        layers=[embedding_dim + len(features), dense_units, 2], maxIter=max_iter, seed=seed,
        featuresCol="features", labelCol="Label",
    ).fit(vectors)
    params = {"embedding_dim": embedding_dim, "dense_units": dense_units, "max_iter": max_iter}
    return TextModel(PipelineModel([*stages, network]), subwords, features, params)
