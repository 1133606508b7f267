"""Schema checks, declarative column rules and record validation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feldspark.functions.expressions import FLOOR
from feldspark.functions.missing import is_float, is_missing, numeric_columns

# The expected raw columns and the declarable types.
RAW_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("feature_1", T.FloatType()),
    T.StructField("feature_2", T.FloatType()),
    T.StructField("feature_3", T.FloatType()),
    T.StructField("feature_4", T.FloatType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("target", T.LongType()),
])
DECLARABLE = {
    "float32": T.FloatType(),
    "float64": T.DoubleType(),
    "int32": T.IntegerType(),
    "int64": T.LongType(),
    "string": T.StringType(),
    "bool": T.BooleanType(),
}
# The texts of record validation.
MISSING_FEATURE = "Missing required feature: {}"
NAN_FEATURE = "Feature {} is NaN"
INFINITE_FEATURE = "Feature {} is infinite"
OUTLIER_FEATURE = "Feature {} is an outlier (z-score: %.2f)"


class SchemaMismatch(ValueError):
    """The columns or their type families are not the expected ones."""


def processed_schema(raw: T.StructType = RAW_SCHEMA) -> T.StructType:
    """The raw schema with ``_norm`` added to each feature name that lacks it."""
    return T.StructType([
        T.StructField(f"{f.name}_norm", f.dataType)
        if f.name.startswith("feature_") and not f.name.endswith("_norm") else f
        for f in raw.fields
    ])


def _family(kind: T.DataType) -> str:
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return "float"
    if isinstance(kind, T.IntegralType):
        return "int"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return "timestamp"
    return kind.simpleString()


def schema_problems(actual: T.StructType, expected: T.StructType) -> list[tuple[str, str, str, str]]:
    """(column, problem, expected type, actual type) for missing, extra and mismatched columns."""
    have = {f.name: f.dataType for f in actual.fields}
    want = {f.name: f.dataType for f in expected.fields}
    found = [(n, "missing", want[n].simpleString(), "") for n in sorted(want.keys() - have.keys())]
    found += [(n, "extra", "", have[n].simpleString()) for n in sorted(have.keys() - want.keys())]
    found += [
        (n, "type", want[n].simpleString(), have[n].simpleString())
        for n in want if n in have and _family(want[n]) != _family(have[n])
    ]
    return found


def check_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Return ``df`` if its schema fits, else raise with every problem listed. Runs no job."""
    problems = schema_problems(df.schema, expected)
    columns = [p for p in problems if p[1] != "type"]
    if columns:
        text = "; ".join(f"{problem} column {name}" for name, problem, _, _ in columns)
        raise SchemaMismatch(f"Schema mismatch: {text}")
    if problems:
        text = "; ".join(f"column {n}: expected {want}, got {have}" for n, _, want, have in problems)
        raise SchemaMismatch(f"Type mismatches: {text}")
    return df


def schema_diff(df: DataFrame, expected: T.StructType) -> DataFrame:
    """The problems as rows, with how many rows of ``df`` each one concerns."""
    listed = F.array(*[
        F.struct(*[F.lit(v).alias(n) for v, n in zip(p, ("column", "problem", "expected", "actual"), strict=True)])
        for p in schema_problems(df.schema, expected)
    ])
    counted = df.agg(F.count(F.lit(1)).alias("num_rows"))
    return counted.select(F.inline(listed), "num_rows") if schema_problems(df.schema, expected) else (
        counted.select(F.lit("").alias("column"), F.lit("").alias("problem"), F.lit("").alias("expected"),
                       F.lit("").alias("actual"), "num_rows").filter(F.lit(False)))


def dataset_info(df: DataFrame) -> dict:
    """Row count and column types."""
    return {
        "num_rows": df.count(),
        "num_columns": len(df.columns),
        "schema": {f.name: f.dataType.simpleString() for f in df.schema.fields},
    }


@dataclass(frozen=True)
class ColumnRule:
    """What one column must satisfy."""

    name: str
    dtype: str
    feature_type: str = "numerical"
    required: bool = True
    allowed_range: tuple[float, float] | None = None
    allowed_values: tuple = ()
    metadata: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.dtype not in DECLARABLE:
            raise ValueError(f"Unsupported dtype: {self.dtype}")

    def struct_field(self) -> T.StructField:
        kept = {"feature_type": self.feature_type, **self.metadata}
        return T.StructField(self.name, DECLARABLE[self.dtype], not self.required, kept)

    def violations(self, df: DataFrame) -> list[Column]:
        """One expression per check: the name of the broken check, or NULL."""
        if self.name not in df.columns:
            return [F.lit(f"{self.name}:absent")] if self.required else []
        c, gone = F.col(f"`{self.name}`"), is_missing(df, self.name)
        checks = []
        if _family(df.schema[self.name].dataType) != _family(DECLARABLE[self.dtype]):
            checks.append(F.lit(f"{self.name}:dtype"))
        if self.required:
            checks.append(F.when(gone, f"{self.name}:required"))
        if self.allowed_range is not None:
            low, high = self.allowed_range
            checks.append(F.when(~gone & ((c < F.lit(low)) | (c > F.lit(high))), f"{self.name}:range"))
        if self.allowed_values:
            checks.append(F.when(~gone & ~c.isin(*self.allowed_values), f"{self.name}:values"))
        return checks


@dataclass(frozen=True)
class DatasetRules:
    """A named set of column rules."""

    name: str
    version: str
    rules: tuple[ColumnRule, ...]
    target: str | None = None
    metadata: dict = field(default_factory=dict)

    def struct_type(self) -> T.StructType:
        return T.StructType([r.struct_field() for r in self.rules])

    def annotate(self, df: DataFrame, output: str = "violations") -> DataFrame:
        checks = [c for rule in self.rules for c in rule.violations(df)]
        listed = F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")
        return df.withColumn(output, listed)

    def violation_counts(self, df: DataFrame) -> DataFrame:
        """Rows that break each check: (violation, n)."""
        broken = self.annotate(df, "_v").select(F.explode("_v").alias("violation"))
        return broken.groupBy("violation").agg(F.count(F.lit(1)).alias("n"))


def validate_records(df: DataFrame, required: Sequence[str], stats: dict[str, dict[str, float]]) -> DataFrame:
    """Add ``errors``, ``warnings`` and ``valid`` to records with optional features.

    A NULL feature is absent. NaN and infinite values are errors; values more than
    three standard deviations from the stored mean are warnings.
    """
    errors: list[Column] = []
    warnings: list[Column] = []
    for name in required:
        gone = F.col(f"`{name}`").isNull() if name in df.columns else F.lit(True)
        errors.append(F.when(gone, MISSING_FEATURE.format(name)))
    for name in numeric_columns(df):
        if is_float(df, name):
            c = F.col(f"`{name}`")
            errors.append(F.when(F.isnan(c), NAN_FEATURE.format(name)))
            errors.append(F.when(F.abs(c) == F.lit(float("inf")), INFINITE_FEATURE.format(name)))
    for name, known in stats.items():
        if name in df.columns and known.get("mean") is not None and known.get("std") is not None:
            c = F.col(f"`{name}`").cast("double")
            z = F.abs((c - F.lit(known["mean"])) / F.lit(max(known["std"], FLOOR)))
            text = F.format_string(OUTLIER_FEATURE.format(name), z)
            warnings.append(F.when(~F.isnan(c) & (z > 3.0), text))
    none = F.array().cast("array<string>")
    return df.withColumns({
        "errors": F.array_compact(F.array(*errors)) if errors else none,
        "warnings": F.array_compact(F.array(*warnings)) if warnings else none,
    }).withColumn("valid", F.size("errors") == 0)


def vector_shape(df: DataFrame, vector: str, target: str | None = None) -> DataFrame:
    """One row: counts, lengths and whether the vectors form a regular table."""
    targets = F.count(target) if target else F.count(vector)
    return df.agg(
        F.count(vector).alias("num_vectors"),
        F.min(F.size(vector)).alias("min_length"),
        F.max(F.size(vector)).alias("max_length"),
        targets.alias("num_targets"),
    ).withColumn(
        "valid",
        (F.col("num_vectors") > 0)
        & F.coalesce(F.col("min_length") == F.col("max_length"), F.lit(False))
        & (F.col("num_targets") == F.col("num_vectors")),
    )


def check_vectors(df: DataFrame, vector: str, target: str | None = None) -> DataFrame:
    row = vector_shape(df, vector, target).first()
    if not row["num_vectors"]:
        raise ValueError("Features cannot be empty")
    if row["min_length"] != row["max_length"]:
        raise ValueError("All feature vectors must have the same length")
    if row["num_targets"] != row["num_vectors"]:
        raise ValueError("Number of targets must match number of features")
    return df


def numeric_projection(df: DataFrame) -> DataFrame:
    """The numeric columns only."""
    return df.select(*[f"`{c}`" for c in numeric_columns(df)])


def infer_features(df: DataFrame, target: str, exclude: Sequence[str] = ("id", "timestamp")) -> list[str]:
    """Every numeric column but the target, the row id and the timestamp."""
    return [c for c in numeric_columns(df) if c != target and c not in exclude]
