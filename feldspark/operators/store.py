"""Versioned feature store: parquet per version, a catalog file created last.

Readers look only at the catalog, so a write that fails half-way is never seen.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feldspark.operators.stats import feature_columns, stat_expressions
from feldspark.session import create_file, folder_names, path_exists, remove_path
from feldspark.sources.parquet import gathered, write_parquet

STAT = T.StructType([
    T.StructField("mean", T.DoubleType()),
    T.StructField("std", T.DoubleType()),
    T.StructField("min", T.DoubleType()),
    T.StructField("max", T.DoubleType()),
    T.StructField("count", T.LongType()),
    T.StructField("null_count", T.LongType()),
])
CATALOG = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("version", T.StringType()),
    T.StructField("schema", T.MapType(T.StringType(), T.StringType())),
    T.StructField("schema_json", T.StringType()),
    T.StructField("feature_stats", T.MapType(T.StringType(), STAT)),
    T.StructField("created_at", T.StringType()),
    T.StructField("num_rows", T.LongType()),
    T.StructField("partitions", T.ArrayType(T.StringType())),
    T.StructField("description", T.StringType()),
    T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
])
# the newest entry of a version counts; its files lie in the folder that it names
STORED = T.StructType([*CATALOG.fields, T.StructField("generation", T.LongType()), T.StructField("folder", T.StringType())])
_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9._+-]*")
_ENTRY = re.compile(r"entry-(\d+)\.json")


class DatasetNotFound(LookupError):
    """No such dataset or version in the catalog."""


@dataclass(frozen=True)
class DatasetMetadata:
    """The catalog row of one version."""

    name: str
    version: str
    schema: dict[str, str]
    schema_json: str
    feature_stats: dict[str, dict[str, float]]
    created_at: str
    num_rows: int
    partitions: list[str] = field(default_factory=list)
    description: str = ""
    tags: dict[str, str] = field(default_factory=dict)

    @classmethod
    def from_row(cls, row: Row) -> DatasetMetadata:
        values = row.asDict(recursive=True)
        return cls(**{k: values[k] for k in CATALOG.names})


def new_version(strategy: str = "latest", now: datetime | None = None) -> str:
    """``latest`` is a short id, ``timestamp`` the time, ``uuid`` a full id, all else is literal."""
    if strategy == "latest":
        return str(uuid.uuid4())[:8]
    if strategy == "timestamp":
        return (now or datetime.now(timezone.utc)).strftime("%Y%m%d_%H%M%S")
    if strategy == "uuid":
        return str(uuid.uuid4())
    return strategy


def path_partitions(path: str) -> list[str]:
    """The keys of ``k=v`` parts of a path, without the version."""
    keys = [part.split("=", 1)[0] for part in path.split("/") if "=" in part]
    return [k for k in keys if k not in ("v", "version")]


@dataclass
class FeatureStore:
    """Datasets below ``base``: ``<name>/v=<version>`` and the catalog in ``metadata``."""

    spark: SparkSession
    base: str

    def _entry(self, name: str, version: str | None = None) -> str:
        entry = f"{self.base}/metadata/name={name}"
        return f"{entry}/version={version}" if version else entry

    def catalog(self) -> DataFrame:
        """One row per stored version."""
        return self._stored().select(*CATALOG.names)

    def _stored(self) -> DataFrame:
        """The newest entry of each version."""
        path = f"{self.base}/metadata"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], STORED)
        rows = self.spark.read.schema(STORED).json(path).filter("created_at IS NOT NULL")  # one being written is no entry yet
        newest = rows.groupBy("name", "version").agg(F.max_by(F.struct(*STORED.names), F.coalesce("generation", F.lit(0))).alias("e"))
        return newest.select("e.*")

    def write(
        self, df: DataFrame, name: str, version: str = "latest", description: str = "",
        tags: dict[str, str] | None = None, partition_cols: Sequence[str] = (),
        compute_stats: bool = True, overwrite: bool = False,
    ) -> str:
        """Write one version and return its id.

        Row count and column statistics are observed while the files are written, so
        the input is computed once. A writer reserves a folder of its own and commits by creating a catalog file that
        must not exist, which points at that folder; nothing is renamed. Until then, and if anything fails, the
        version before stays as it was. Of two writers of the same version the one that commits later fails.
        """
        version = new_version(version)
        for text in (name, version):
            if not _NAME.fullmatch(text) or text == "metadata":
                raise ValueError(f"Not a valid dataset name or version: {text}")
        exists = ValueError(f"Version {version} of {name} already exists")
        before = self._generation(name, version)
        if before >= 0 and not overwrite:
            raise exists
        folder = self._reserved(name, version)
        features = feature_columns(df) if compute_stats else []
        exprs = stat_expressions(df, features)
        watch = Observation()
        # observed in the stage that writes: a repeated shuffle stage is not counted twice
        counted = gathered(df, partition_cols).observe(
            watch, F.count(F.lit(1)).alias("rows"), *[e.alias(f"s{i}") for i, e in enumerate(exprs.values())]
        )
        try:
            write_parquet(counted, f"{self.base}/{folder}", partition_cols, mode="error", gather=False)
            seen = watch.get
            stats: dict[str, dict] = {}
            for i, key in enumerate(exprs):
                column, stat = key.rsplit("|", 1)
                stats.setdefault(column, {})[stat] = seen[f"s{i}"]
            entry = {
                "schema": {f.name: f.dataType.simpleString() for f in df.schema.fields},
                "schema_json": df.schema.json(),
                "feature_stats": stats,
                "created_at": datetime.now(timezone.utc).isoformat(timespec="microseconds"),
                "num_rows": seen["rows"],
                "partitions": list(partition_cols),
                "description": description,
                "tags": tags or {},
                "generation": max(before, 0) + 1,
                "folder": folder,
            }
            if not create_file(self.spark, f"{self._entry(name, version)}/entry-{max(before, 0) + 1}.json", json.dumps(entry)):
                raise exists
        except Exception:
            remove_path(self.spark, f"{self.base}/{folder}")
            raise
        self._remove_older(name, version, max(before, 0) + 1, folder)
        return version

    def _generation(self, name: str, version: str) -> int:
        """Number of the newest entry of a version; -1 if there is none."""
        found = (_ENTRY.fullmatch(f) for f in folder_names(self.spark, self._entry(name, version)))
        return max((int(m[1]) for m in found if m), default=-1)

    def _reserved(self, name: str, version: str) -> str:
        """A folder that no other writer uses: the version's plain one for the first."""
        k = 0
        while not create_file(self.spark, f"{self._entry(name, version)}/_reserved-{k}", ""):
            k += 1
        return f"{name}/v={version}" + (f"~{k}" if k else "")

    def _remove_older(self, name: str, version: str, generation: int, folder: str) -> None:
        """Entries before this one and the folders they point at; those of writers still at work stay."""
        entry = self._entry(name, version)
        for file in folder_names(self.spark, entry):
            m = _ENTRY.fullmatch(file)
            if m and int(m[1]) < generation:
                row = self.spark.read.schema(STORED).json(f"{entry}/{file}").first()
                old = (row and row["folder"]) or folder
                remove_path(self.spark, f"{entry}/{file}")
                if old != folder:
                    remove_path(self.spark, f"{self.base}/{old}")

    def metadata(self, name: str, version: str = "latest") -> DatasetMetadata:
        return DatasetMetadata.from_row(self._row(name, version))

    def _row(self, name: str, version: str) -> Row:
        rows = self._stored().filter(F.col("name") == name)
        if version == "latest":
            rows = rows.orderBy(F.desc("created_at"), F.desc("version")).limit(1)
        else:
            rows = rows.filter(F.col("version") == version)
        row = rows.first()
        if row is None:
            raise DatasetNotFound(f"Metadata not found: dataset {name}, version {version} not found")
        return row

    def read(self, name: str, version: str = "latest") -> tuple[DataFrame, DatasetMetadata]:
        row = self._row(name, version)
        known = DatasetMetadata.from_row(row)
        schema = T.StructType.fromJson(json.loads(known.schema_json))
        df = self.spark.read.schema(schema).parquet(f"{self.base}/{row['folder']}")
        return df.select(*[f"`{c}`" for c in schema.names]), known

    def list_datasets(self) -> DataFrame:
        newest = F.struct("created_at", "version")
        return self.catalog().groupBy("name").agg(
            F.max_by("version", newest).alias("latest_version"),
            F.max_by("num_rows", newest).alias("num_rows"),
            F.max("created_at").alias("created_at"),
            F.count(F.lit(1)).alias("num_versions"),
        )

    def delete(self, name: str, version: str | None = None) -> None:
        """Remove one version, or all of them: first from the catalog, then the files."""
        known = self._generation(name, version) >= 0 if version else path_exists(self.spark, self._entry(name))
        if not known:
            raise DatasetNotFound(f"Dataset {name}, version {version or 'any'} not found")
        remove_path(self.spark, self._entry(name, version))
        mine = f"v={version}"
        for folder in folder_names(self.spark, f"{self.base}/{name}"):
            if version is None or folder == mine or folder.startswith(f"{mine}~"):
                remove_path(self.spark, f"{self.base}/{name}/{folder}")
        if version is None:
            remove_path(self.spark, f"{self.base}/{name}")


def flat_metadata(catalog: DataFrame) -> DataFrame:
    """The catalog as (name, version, num_rows, feature, statistics...) rows."""
    return catalog.select("name", "version", "num_rows", F.explode("feature_stats").alias("feature", "s")).select(
        "name", "version", "num_rows", "feature", "s.*"
    )
