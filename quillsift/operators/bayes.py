"""Multinomial naive Bayes on word TF-IDF, as grouped sums and joins."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillsift.operators.vectors import MODEL_ROWS, term_idf, tfidf, word_terms
from quillsift.session import cut, small_side, written


@dataclass(frozen=True)
class BayesModel:
    """``terms`` is (term, idf, log0, log1); the two priors are logarithms."""

    terms: DataFrame
    priors: tuple[float, float]


def fit(train: DataFrame, keys: list[str], label: str = "Label", text: str = "text", alpha: float = 1.0) -> BayesModel:
    """Class weights per term with additive smoothing, and unsmoothed class priors.

    The weights are summed per term on both sides of the shuffle; the label
    travels with each message's terms, so no join with the messages is needed.
    """
    size = train.agg(
        F.count("*").alias("n"),
        F.count_if(F.col(label) == 0).alias("n0"),
        F.count_if(F.col(label) == 1).alias("n1"),
    ).first()
    if not size["n0"] or not size["n1"]:
        raise ValueError("training rows of both classes are needed")
    terms = written(word_terms(train, [*keys, label], text), "terms")
    weights = tfidf(terms, term_idf(terms, size["n"]), keys)
    sums = cut(
        weights.groupBy("term", "idf").agg(
            *[F.sum(F.when(F.col(label) == c, F.col("weight")).otherwise(0.0)).alias(f"sum{c}") for c in (0, 1)]
        )
    )
    total = sums.agg(F.count("*").alias("v"), F.sum("sum0").alias("t0"), F.sum("sum1").alias("t1")).first()
    logs = [
        F.log((F.col(f"sum{c}") + alpha) / (total[f"t{c}"] + alpha * total["v"])).alias(f"log{c}") for c in (0, 1)
    ]
    priors = math.log(size["n0"] / size["n"]), math.log(size["n1"] / size["n"])
    return BayesModel(sums.select("term", "idf", *logs), priors)


def score(model: BayesModel, messages: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Messages with ``score``, the probability of class 1; unknown words count for nothing.

    Norm and both class sums of a message come out of one aggregate.
    """
    w = F.col("tf") * F.col("idf")
    known = word_terms(messages, keys, text).join(small_side(model.terms, MODEL_ROWS), "term")
    sums = known.groupBy(*keys).agg(
        (F.sum(w * (F.col("log0") - F.col("log1"))) / F.sqrt(F.sum(w * w))).alias("against")
    )
    odds = F.coalesce(F.col("against"), F.lit(0.0)) + (model.priors[0] - model.priors[1])
    return messages.join(sums, keys, "left").withColumn("score", 1 / (1 + F.exp(odds))).drop("against")
