"""End-to-end flows: raw table to processed table, to store, to trained model, to predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feldspark.functions.aggregates import regression_scores
from feldspark.operators.filters import apply_steps, model_input
from feldspark.operators.mlp import MLPModel, train_mlp
from feldspark.operators.models import ForestModel, LinearModel, ModelRegistry, linear_regression, random_forest, ridge_regression
from feldspark.operators.preprocess import Preprocessor
from feldspark.operators.quality import RAW_SCHEMA, check_schema, infer_features, numeric_projection, processed_schema
from feldspark.operators.recipe import Recipe, default_recipe
from feldspark.operators.serving import prediction_log, transform_records
from feldspark.operators.splits import TRAIN, holdout
from feldspark.operators.store import FeatureStore
from feldspark.sources.parquet import create_source, read_parquet, write_parquet


def preprocess_table(
    spark: SparkSession, source: str | DataFrame, output: str, state_path: str,
    source_type: str = "parquet", expected: T.StructType | None = RAW_SCHEMA,
    preprocessor: Preprocessor | None = None, **options,
) -> DataFrame:
    """Load, check, fit, transform, check again, write the table and the fitted state."""
    if isinstance(source, DataFrame):
        df = source
    elif source_type == "parquet":
        df = create_source(spark, "parquet", path=source, schema_validation=False, **options)
    else:
        df = create_source(spark, source_type, **options)
    if expected is not None:
        check_schema(df, expected)
    # the health check rides on the first pass of the fit
    fitted = (preprocessor or Preprocessor()).fit(df, profile=True)
    if not fitted.health["num_rows"]:
        raise ValueError("Dataset is empty")
    done = fitted.transform(df)
    if expected is not None:
        check_schema(done, processed_schema(expected))
    write_parquet(done, output, mode="overwrite")
    fitted.save(spark, state_path)
    return read_parquet(spark, output)


def build_features(
    store: FeatureStore, source: str | DataFrame, output_name: str, version: str = "latest",
    recipe: Recipe | None = None, expected: T.StructType | None = None,
) -> str:
    """Read, optionally check, apply the recipe and store a new version; returns its id."""
    df = source if isinstance(source, DataFrame) else read_parquet(store.spark, source)
    if expected is not None:
        check_schema(df, expected)
    engineered = (recipe or default_recipe()).transform(df)
    return store.write(
        engineered, output_name, version, description="Engineered features", tags={"stage": "features"}
    )


FITTERS = {"linear_regression": linear_regression, "ridge": ridge_regression, "random_forest": random_forest, "mlp": train_mlp}


def train_from_store(
    store: FeatureStore, dataset: str, registry: ModelRegistry, model_name: str, target: str, key: str,
    version: str = "latest", kind: str = "linear_regression", steps: Sequence[dict] = (),
    features: Sequence[str] | None = None, validation_split: float = 0.2, seed: int = 42,
    model_version: str = "1", **options,
) -> tuple[LinearModel | ForestModel | MLPModel, DataFrame]:
    """Read a stored set, apply the configured steps, hold out a part, fit, score, register.

    Returns the model and its metrics per split. Numeric columns other than target, key
    and timestamp are the features unless some are named.
    """
    if kind not in FITTERS:
        raise ValueError(f"Unknown model type: {kind}")
    data, _ = store.read(dataset, version)
    rows = holdout(numeric_projection(apply_steps(data, steps)), key, validation_split, seed)
    names = list(features) if features else infer_features(rows, target, exclude=("id", "timestamp", key))
    model = FITTERS[kind](rows.filter(F.col("split") == TRAIN), names, target, **options)
    scores = regression_scores(F.col(target).cast("double"), F.col("prediction"))
    metrics = model.transform(rows).groupBy("split").agg(*[e.alias(n) for n, e in scores.items()])
    found = {f"{r['split']}_{n}": r[n] for r in metrics.collect() for n in scores}
    registry.save(model_name, model_version, model, metrics=found, tags={"dataset": dataset})
    table = [(s, *[found[f"{s}_{n}"] for n in scores]) for s in sorted({k.split("_")[0] for k in found})]
    return model, store.spark.createDataFrame(table, "split string, " + ", ".join(f"{n} double" for n in scores))


def score_records(
    records: DataFrame, stats: dict, model: LinearModel | MLPModel, key: str, version: str, batch: str,
    on_missing: str = "error",
) -> DataFrame:
    """Standardize with stored statistics, order the model input, predict, log; one job."""
    ready = transform_records(records, stats, interaction="feature_interaction" in model.features)
    inputs = model_input(ready, model.features, keep=[key], on_missing=on_missing)
    return prediction_log(model.transform(inputs), key, version, batch, features=model.features)
