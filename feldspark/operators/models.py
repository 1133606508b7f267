"""Regression models fitted as Spark jobs, and the model registry."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feldspark.functions.missing import number
from feldspark.operators.forest import CELLS, cells, find_splits, grow_forest
from feldspark.operators.serving import score_linear
from feldspark.session import path_exists, remove_path

BAGGED_BYTES = 1 << 30  # of rows with their draws that Spark's own forests may keep

_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")
ENTRY = (
    "name string, version string, framework string, created_at string, kind string, state string, "
    "hyperparameters string, metrics map<string,double>, tags map<string,string>"
)


@dataclass
class LinearModel:
    """Weights of a linear model over named features."""

    features: list[str]
    weights: list[float]
    intercept: float
    hyperparameters: dict = field(default_factory=dict)

    def transform(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        return score_linear(df, self.features, self.weights, self.intercept, output)


def complete_rows(df: DataFrame, columns: Sequence[str], extra: Sequence[Column] = ()) -> DataFrame:
    """The columns as doubles (and ``extra`` ones as they are), without rows that miss a value of the former."""
    return df.select(*[number(df, c).alias(c) for c in columns], *extra).dropna(subset=list(columns))


def assemble(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    rows = complete_rows(df, [*features, target])
    return VectorAssembler(inputCols=list(features), outputCol="vector").transform(rows)


def linear_regression(df: DataFrame, features: Sequence[str], target: str) -> LinearModel:
    """Least squares by the normal equations, summed over the partitions in one pass."""
    fitted = LinearRegression(featuresCol="vector", labelCol=target, solver="normal").fit(
        assemble(df, features, target)
    )
    return LinearModel(list(features), [float(w) for w in fitted.coefficients], float(fitted.intercept))


def solve_normal(moments: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The weights of a small normal system; the least-norm ones if features are dependent."""
    try:
        return np.linalg.solve(moments, target)
    except np.linalg.LinAlgError:
        return np.linalg.pinv(moments, hermitian=True) @ target


def ridge_regression(df: DataFrame, features: Sequence[str], target: str, alpha: float = 1.0) -> LinearModel:
    """Minimize ``|y - Xw - b|² + alpha·|w|²`` (intercept not penalized).

    The centered moments of all pairs of columns come from one aggregate; what reaches
    the driver is one number per pair, and the small system is solved there.
    """
    names = [*features, target]
    rows = complete_rows(df, names)
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    row = rows.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(n).alias(f"m{i}") for i, n in enumerate(names)],
        *[F.covar_pop(names[i], names[j]).alias(f"c{i}_{j}") for i, j in pairs],
    ).first()
    if not row["n"]:
        raise ValueError("no complete rows to fit")
    k = len(features)
    moment = np.zeros((k + 1, k + 1))
    for i, j in pairs:
        moment[i, j] = moment[j, i] = row[f"c{i}_{j}"]
    weights = solve_normal(moment[:k, :k] + np.eye(k) * (alpha / row["n"]), moment[:k, k])
    intercept = row[f"m{k}"] - sum(w * row[f"m{i}"] for i, w in enumerate(weights))
    return LinearModel(list(features), [float(w) for w in weights], float(intercept), {"alpha": alpha})


@dataclass
class ForestModel:
    """A fitted forest over named features; the trees stay in Spark's own model."""

    features: list[str]
    forest: RandomForestRegressionModel
    hyperparameters: dict = field(default_factory=dict)

    def transform(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        """Rows that miss a feature get no prediction."""
        names = [f"_f{i}" for i in range(len(self.features))]
        whole = df.withColumns({n: number(df, f) for n, f in zip(names, self.features, strict=True)})
        vectors = VectorAssembler(inputCols=names, outputCol="_vector", handleInvalid="keep").transform(whole)
        found = self.forest.setFeaturesCol("_vector").setPredictionCol("_found").transform(vectors)
        missing = F.exists(F.array(*names), lambda x: x.isNull())
        return found.withColumn(output, F.when(~missing, F.col("_found"))).drop("_vector", "_found", *names)


def random_forest(
    df: DataFrame, features: Sequence[str], target: str, trees: int = 100, depth: int = 5, seed: int = 42,
    every_feature: bool = False, all_rows: bool = False, bins: int = 32, bagged_bytes: int = BAGGED_BYTES,
) -> ForestModel:
    """A forest grown level by level from binned statistics over the partitions.

    ``every_feature`` lets each split look at all features; ``all_rows`` grows each tree on all rows. Spark's own
    forests keep every row with a draw per tree and pass over them once a level. Where that is more than
    ``bagged_bytes``, a forest grows from sums per cell of the binned features instead, if these are few enough.
    """
    forest = RandomForestRegressor(
        featuresCol="vector", labelCol=target, numTrees=trees, maxDepth=depth, seed=seed, maxBins=bins,
        featureSubsetStrategy="all" if every_feature else "auto", bootstrap=not all_rows,
    )
    rows = complete_rows(df, [*features, target])
    n = rows.count()
    splits = find_splits(rows, features, bins, seed, n) if n * (100 + 4 * trees) > bagged_bytes else None
    if splits is not None and cells(splits) * trees <= CELLS:
        fitted = grow_forest(rows, features, target, splits, trees, depth, seed, every_feature, all_rows)
        fitted._set(**{p.name: v for p, v in forest.extractParamMap().items() if fitted.hasParam(p.name)})
        fitted._transfer_params_to_java()
    else:
        fitted = forest.fit(assemble(df, features, target))
    return ForestModel(list(features), fitted, {"trees": trees, "depth": depth, "seed": seed})


def forest_predictions(model: ForestModel, df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    return model.transform(complete_rows(df, [*features, target]))


FITTERS = {"linear_regression": linear_regression, "ridge": ridge_regression, "random_forest": random_forest}


def fit_model(kind: str, df: DataFrame, features: Sequence[str], target: str, **options):
    if kind not in FITTERS:
        raise ValueError(f"Unknown model type: {kind}")
    return FITTERS[kind](df, features, target, **options)


@dataclass(frozen=True)
class ModelRegistry:
    """Models as JSON rows below ``base/<name>/v=<version>``; a forest's trees lie beside its row."""

    spark: SparkSession
    base: str

    def save(
        self, name: str, version: str, model, framework: str = "feldspark",
        metrics: dict[str, float] | None = None, tags: dict[str, str] | None = None,
    ) -> None:
        """Store a new version; one that exists is not replaced."""
        path = self._path(name, version)
        if path_exists(self.spark, path):
            raise ValueError(f"Version {version} of model {name} already exists")
        if isinstance(model, ForestModel):
            model.forest.write().save(f"{self.base}/{name}/trees/{version}")
            state = {"features": model.features, "hyperparameters": model.hyperparameters}
        else:
            state = asdict(model)
        entry = {
            "name": name,
            "version": version,
            "framework": framework,
            "created_at": datetime.now(timezone.utc).isoformat(timespec="microseconds"),
            "kind": type(model).__name__,
            "state": json.dumps(state),
            "hyperparameters": json.dumps(getattr(model, "hyperparameters", {})),
            "metrics": metrics or {},
            "tags": tags or {},
        }
        self.spark.createDataFrame([(json.dumps(entry),)], "value string").coalesce(1).write.text(path)

    def _path(self, name: str, version: str) -> str:
        for text in (name, version):
            if not _NAME.fullmatch(text):
                raise ValueError(f"Not a valid model name or version: {text}")
        return f"{self.base}/{name}/v={version}"

    def entries(self) -> DataFrame:
        return self.spark.read.schema(ENTRY).json(f"{self.base}/*/v=*")

    def delete(self, name: str, version: str) -> None:
        remove_path(self.spark, self._path(name, version))
        remove_path(self.spark, f"{self.base}/{name}/trees/{version}")

    def load(self, name: str, version: str):
        from feldspark.operators.mlp import MLPModel

        path = self._path(name, version)
        if not path_exists(self.spark, path):
            raise LookupError(f"Model {name}, version {version} not found")
        row = self.spark.read.schema(ENTRY).json(path).first()
        if row["kind"] == "ForestModel":
            forest = RandomForestRegressionModel.load(f"{self.base}/{name}/trees/{version}")
            return ForestModel(forest=forest, **json.loads(row["state"]))
        kinds = {"LinearModel": LinearModel, "MLPModel": MLPModel}
        return kinds[row["kind"]](**json.loads(row["state"]))

