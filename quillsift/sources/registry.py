"""Tables of models and runs, kept next to the model files."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsift.operators.linear import TextModel

SCHEMA_VERSION = 1
MODEL_TYPES = ("classic", "dnn")
REGISTRY_SCHEMA = (
    "name string, params_hash string, schema_version int, model_type string, artifact_path string, "
    "feature_cols array<string>, created_at string, hyperparameters string"
)
RUN_SCHEMA = (
    "run string, operation string, duration_seconds double, "
    "input_data struct<train_rows: bigint, test_rows: bigint, num_features: bigint>, "
    "hyperparameters map<string, string>, best_params map<string, string>, best_cv_f1 double, "
    "metrics struct<precision: double, recall: double, f1: double, roc_auc: double, threshold: double, "
    "confusion_matrix: array<array<bigint>>, classification_report: array<struct<label: int, precision: double, "
    "recall: double, f1: double, support: bigint>>>, search_space string, cv_folds int, timestamp string"
)


def params_hash(params: dict) -> str:
    return hashlib.sha256(json.dumps(params, sort_keys=True, default=str).encode()).hexdigest()


def now() -> str:
    return datetime.now(timezone.utc).isoformat()


def register(spark: SparkSession, registry: str, name: str, model_type: str, model: TextModel, key: dict | None = None) -> str:
    """Save a model and append its row; returns the path of the model."""
    digest = params_hash(model.params if key is None else key)
    path = f"{registry}/models/{name}-{digest[:16]}"
    model.save(spark, path)
    row = (
        name, digest, SCHEMA_VERSION, model_type, path, model.features, now(),
        json.dumps(model.params, sort_keys=True),
    )
    spark.createDataFrame([row], REGISTRY_SCHEMA).write.mode("append").parquet(f"{registry}/manifest")
    return path


def manifest(spark: SparkSession, registry: str) -> DataFrame:
    return spark.read.schema(REGISTRY_SCHEMA).parquet(f"{registry}/manifest")


def load_model(spark: SparkSession, registry: str, name: str, key: dict | None = None) -> TextModel:
    """Newest model of a name (and parameters); version and type are checked first."""
    rows = manifest(spark, registry).where(F.col("name") == name)
    if key is not None:
        rows = rows.where(F.col("params_hash") == params_hash(key))
    found = rows.orderBy(F.desc("created_at")).limit(1).collect()
    if not found:
        raise LookupError(f"no model {name} in {registry}")
    row = found[0]
    if row["schema_version"] != SCHEMA_VERSION:
        raise ValueError(f"schema version {row['schema_version']} of {name}, expected {SCHEMA_VERSION}")
    if row["model_type"] not in MODEL_TYPES:
        raise ValueError(f"unknown model type {row['model_type']} of {name}")
    return TextModel.load(spark, row["artifact_path"], list(row["feature_cols"]), json.loads(row["hyperparameters"]))


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.schema(REGISTRY_SCHEMA).parquet(path).schema  # noqa: B018  analysis fails without the path
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def cached_model(
    spark: SparkSession, registry: str, name: str, model_type: str, key: dict, train: Callable[[], TextModel]
) -> tuple[TextModel, bool]:
    """(model, was it there): reuse a registered model of the same parameters, else train and save it."""
    if _exists(spark, f"{registry}/manifest"):
        try:
            return load_model(spark, registry, name, key), True
        except LookupError:
            pass
    model = train()
    register(spark, registry, name, model_type, model, key)
    return model, False


def save_runs(runs: DataFrame, folder: str) -> None:
    """Append run records, one JSON object per run."""
    runs.withColumn("timestamp", F.lit(now())).write.mode("append").json(folder)


def load_runs(spark: SparkSession, path: str, one_per_file: bool = False) -> DataFrame:
    """Run records as a flat table: family, parameters as 'k=v, ...', metrics.

    Reads folders written by ``save_runs``, or with ``one_per_file`` indented
    ``*.metrics.json`` files, whose name is the run where the record has none.
    """
    runs = spark.read.option("multiLine", one_per_file).schema(RUN_SCHEMA).json(path)
    stem = F.regexp_replace(F.col("_metadata.file_name"), r"\.metrics\.json$", "")
    given = F.coalesce("hyperparameters", "best_params")
    pairs = F.transform(F.map_entries(given), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return runs.select(
        F.coalesce("run", stem).alias("run"),
        F.when(F.col("operation").startswith("classic"), "classic").otherwise("dnn").alias("model"),
        F.when(F.coalesce(F.size(given), F.lit(0)) > 0, F.array_join(pairs, ", "))
        .otherwise("(defaults)")
        .alias("hyperparameters"),
        F.col("duration_seconds").alias("duration_s"),
        "metrics.precision",
        "metrics.recall",
        "metrics.f1",
        "metrics.roc_auc",
    )
