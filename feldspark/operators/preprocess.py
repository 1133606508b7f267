"""Fitted preprocessing: outlier handling and scaling of ``feature_*`` columns."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feldspark.functions import expressions as X
from feldspark.functions.aggregates import moments
from feldspark.functions.missing import number, numeric_columns
from feldspark.operators.filters import missing_counts
from feldspark.operators.ordering import SKETCH_ACCURACY, exact_quantiles, pivot_places

QUARTILES = (0.25, 0.75)
METHODS = ("standard", "minmax", "robust")


@dataclass
class Preprocessor:
    """Scaling method, outlier rule and, once fitted, the statistics of each feature.

    ``clip_mode`` "winsorize" pulls outliers to the threshold; "null" removes them.
    Scaling uses the statistics of the data as it was before clipping.
    """

    scaling_method: str = "standard"
    clip_outliers: bool = True
    clip_threshold: float = 3.0
    clip_mode: str = "winsorize"
    stats: dict[str, dict[str, float]] = field(default_factory=dict)
    health: dict = field(default_factory=dict)
    _later: Callable[[], dict] | None = field(default=None, repr=False, compare=False)

    def __post_init__(self) -> None:
        if self.scaling_method not in METHODS:
            raise ValueError(f"Unknown scaling method: {self.scaling_method}")
        if self.clip_mode not in ("winsorize", "null"):
            raise ValueError(f"Unknown clip mode: {self.clip_mode}")

    def fit(self, df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False, profile: bool = False) -> Preprocessor:
        """One pass for the moments and sketches of all features. An exact selection of the
        quartiles around the sketched ones follows where the scaling uses them, else only
        when ``complete`` (or ``save``) asks for them. ``approx`` keeps the sketched ones;
        ``profile`` also counts the rows and the missing values of all columns (``health``).
        """
        names = list(columns) if columns else [c for c in numeric_columns(df) if c.startswith("feature_")]
        if not names:
            raise ValueError("no feature columns to fit")
        values = {n: number(df, n) for n in names}
        exprs = []
        for n, x in values.items():
            parts = dict(moments(x))
            places = [q for p in QUARTILES for q in ((p,) if approx else pivot_places(p))]
            parts["sketch"] = F.percentile_approx(x, places, SKETCH_ACCURACY)
            exprs.append(F.struct(*[e.alias(k) for k, e in parts.items()]).alias(n))
        if profile:
            exprs += [F.count(F.lit(1)).alias("_rows"), F.struct(*missing_counts(df, df.columns)).alias("_missing")]
        row = df.agg(*exprs).first()
        if profile:
            self.health = {"num_rows": row["_rows"], "null_counts": row["_missing"].asDict()}
        counts = {n: row[n]["count"] for n in names}
        self.stats = {n: {k: row[n][k] for k in ("mean", "std", "min", "max")} for n in names}
        if approx:
            self._later = lambda: {n: row[n]["sketch"] or [None, None] for n in names}
        else:
            hints = {n: row[n]["sketch"] for n in names}
            self._later = lambda: exact_quantiles(df, values, QUARTILES, counts, hints=hints)
        return self.complete() if approx or self.scaling_method == "robust" else self

    def complete(self) -> Preprocessor:
        """Settle the quartiles of the fitted table if that has not been done."""
        if self._later is not None:
            quartiles, self._later = self._later(), None
            for n, s in self.stats.items():
                s["q25"], s["q75"] = quartiles[n]
        return self

    def _scaled(self, x: Column, s: dict[str, float]) -> Column:
        if self.clip_outliers:
            clip = X.winsorize if self.clip_mode == "winsorize" else X.drop_outlier
            x = clip(x, s["mean"], s["std"], self.clip_threshold)
        if self.scaling_method == "standard":
            return X.standardize(x, s["mean"], s["std"])
        if self.scaling_method == "minmax":
            return X.rescale(x, s["min"], s["max"])
        return X.rescale(x, s["q25"], s["q75"])

    def transform(self, df: DataFrame) -> DataFrame:
        """One projection: other columns first, then each feature as ``<name>_norm``."""
        if not self.stats:
            raise ValueError("Preprocessor must be fitted before transform")
        present = [n for n in self.stats if n in df.columns]
        in_place = {n for n in present if n.endswith("_norm")}
        kept = [
            self._scaled(number(df, c), self.stats[c]).alias(c) if c in in_place else F.col(f"`{c}`")
            for c in df.columns if c in in_place or c not in present
        ]
        added = [
            self._scaled(number(df, n), self.stats[n]).alias(f"{n}_norm") for n in present if n not in in_place
        ]
        return df.select(*kept, *added)

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the state, quartiles included, as one JSON row."""
        self.complete()
        state = {f.name: getattr(self, f.name) for f in fields(self) if f.name != "_later"}
        spark.createDataFrame([(json.dumps(state),)], "state string").coalesce(1).write.mode(
            "overwrite"
        ).text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Preprocessor:
        return cls(**json.loads(spark.read.text(path).first()[0]))
