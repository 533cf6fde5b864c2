"""Term weights and scaled features, as plain tables and as ML pipeline stages."""

from __future__ import annotations

import math

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import (
    CountVectorizerModel,
    ElementwiseProduct,
    NGram,
    Normalizer,
    SQLTransformer,
    VectorAssembler,
)
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillsift.functions.charsets import STOP_WORDS
from quillsift.session import cut, small_side

WORD_PATTERN = r"[\p{L}\p{N}_]{2,}"
MODEL_ROWS = 500_000
MAX_WIDTH = 10_000_000


def word_terms(
    texts: DataFrame, keys: list[str], text: str = "text", stop_words: list[str] | None = None
) -> DataFrame:
    """(keys, term, tf): lower-case words of two or more characters, stop words left out.

    The explode is counted back at once per message; the stop list is tested as
    a set after the explode, inside generated code.
    """
    words = F.regexp_extract_all(F.lower(F.col(text)), F.lit(WORD_PATTERN), F.lit(0))
    exploded = texts.select(*keys, F.explode(words).alias("term"))
    kept = exploded.where(~F.col("term").isin(STOP_WORDS if stop_words is None else stop_words))
    return kept.groupBy(*keys, "term").agg(F.count("*").alias("tf"))


def smooth_idf(documents: int) -> Column:
    return F.log((F.lit(1.0) + documents) / (F.lit(1.0) + F.col("df"))) + 1


def term_idf(terms: DataFrame, documents: int) -> DataFrame:
    """(term, df, idf) with smoothed inverse document frequency."""
    return terms.groupBy("term").agg(F.count("*").alias("df")).withColumn("idf", smooth_idf(documents))


def tfidf(terms: DataFrame, idf: DataFrame, keys: list[str]) -> DataFrame:
    """Add ``weight``: tf * idf scaled to unit length per message; unknown terms drop out.

    The term table is broadcast only if it was counted small. Beyond that the
    join shuffles by term, where AQE splits the terms that hold too many rows.
    """
    raw = F.col("tf") * F.col("idf")
    message = Window.partitionBy(*keys)
    return terms.join(small_side(idf, MODEL_ROWS), "term").withColumn(
        "weight", raw / F.sqrt(F.sum(raw * raw).over(message))
    )


def scaling(featured: DataFrame, features: list[str]) -> list[tuple[str, float, float]]:
    """(feature, mean, population deviation) from one aggregate; 1 where nothing varies."""
    row = featured.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"mean_{c}") for c in features],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"std_{c}") for c in features],
    ).first()
    return [(c, row[f"mean_{c}"], row[f"std_{c}"] or 1.0) for c in features]


def scaled(feature: str, mean: float, std: float) -> str:
    return f"(CAST({feature} AS DOUBLE) - {mean!r}D) / {std!r}D"


def with_scaled(featured: DataFrame, features: list[str]) -> DataFrame:
    """Replace the features by their standardised values."""
    values = {c: F.expr(scaled(c, m, s)) for c, m, s in scaling(featured, features)}
    return featured.withColumns(values)


def scaler_stages(featured: DataFrame, features: list[str], out: str = "scaled") -> list[Transformer]:
    parts = scaling(featured, features)
    names = [f"z_{c}" for c, _, _ in parts]
    columns = ", ".join(f"{scaled(c, m, s)} AS z_{c}" for c, m, s in parts)
    return [
        SQLTransformer(statement=f"SELECT *, {columns} FROM __THIS__"),
        VectorAssembler(inputCols=names, outputCol=out),
    ]


def term_stages(ngrams: tuple[int, int], tokens: str = "tokens", out: str = "terms") -> list[Transformer]:
    """Stages that turn a token array into the array of its n-grams."""
    low, high = ngrams
    stages: list[Transformer] = [
        NGram(n=n, inputCol=tokens, outputCol=f"grams{n}") for n in range(low, high + 1)
    ]
    columns = ", ".join(f"grams{n}" for n in range(low, high + 1))
    return [*stages, SQLTransformer(statement=f"SELECT *, concat({columns}) AS {out} FROM __THIS__")]


def term_counts(termed: DataFrame, by: list[str], terms: str = "terms") -> DataFrame:
    """(by, term, tf, df): one explode carries both counts and is summed before the shuffle."""
    def mark(array: Column, tf: int, df: int) -> Column:
        return F.transform(
            array, lambda t: F.struct(t.alias("term"), F.lit(tf).alias("tf"), F.lit(df).alias("df"))
        )

    marks = F.concat(mark(F.col(terms), 1, 0), mark(F.array_distinct(terms), 0, 1))
    return termed.select(*by, F.inline(marks)).groupBy(*by, "term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))


def vocabulary(termed: DataFrame, max_features: int | None, terms: str = "terms") -> list:
    """Rows (term, tf, df) of the most frequent terms, ties by term.

    The result is the width of the model, which the driver holds: without ``max_features``
    the terms are counted first, and too many of them are an error, not a cut.
    """
    counts = term_counts(termed, [], terms)
    if not max_features:
        counts = cut(counts)
        max_features = counts.count()
        if max_features > MAX_WIDTH:
            raise ValueError(f"{max_features} terms are too many for one model: set max_features")
    return counts.orderBy(F.desc("tf"), "term").limit(max_features).collect()


def tfidf_stages(
    tokenised: DataFrame,
    documents: int,
    ngrams: tuple[int, int] = (1, 1),
    max_features: int | None = 20_000,
    tokens: str = "tokens",
    out: str = "tfidf",
) -> list[Transformer]:
    """Fitted stages from a token array to a TF-IDF vector of unit length.

    Term and document frequencies come from the same pass, so no separate IDF
    fit is needed; the smoothed idf is applied as an element-wise product.
    """
    grams = term_stages(ngrams, tokens)
    kept = vocabulary(PipelineModel(grams).transform(tokenised), max_features)
    counter = CountVectorizerModel.from_vocabulary([r["term"] for r in kept], "terms", "counts")
    idf = [math.log((1 + documents) / (1 + r["df"])) + 1 for r in kept]
    return [
        *grams,
        counter,
        ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="counts", outputCol="weighted"),
        Normalizer(p=2.0, inputCol="weighted", outputCol=out),
    ]
