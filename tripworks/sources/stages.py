"""Numbered pipeline stages and named feature caches, both as Parquet directories."""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tripworks.sources import hadoop

_RECORD = re.compile(r"commit_(\d+)\.json")
_STAGE_NAME = re.compile(r"stage_(\d+)")


class StageStore:
    """Stages live in ``root/stage_<n>``, partitioned by split so reading one split skips the other.

    A write goes to a folder of its own and counts only once a commit record names it: the folders that
    make up the stage, each with its files, their sizes and schema, and notes such as what the stage was
    built from. A write that is killed leaves no record, so it is never read, and the stage before it
    stays as it was. The record with the highest number counts; what it does not name is removed.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, stage: int) -> str:
        return f"{self.root}/stage_{int(stage)}"

    def under(self, name: str) -> StageStore:
        """A store of its own inside this one."""
        return StageStore(self.spark, f"{self.root}/{name}")

    def _records(self, stage: int) -> list[int]:
        found = (_RECORD.fullmatch(name) for name in hadoop.list_names(self.spark, self.path(stage)))
        return sorted(int(m[1]) for m in found if m)

    def record(self, stage: int) -> dict | None:
        """The commit record, or None if the stage was never finished."""
        numbers = self._records(stage)
        return json.loads(hadoop.read_text(self.spark, f"{self.path(stage)}/commit_{numbers[-1]}.json")) if numbers else None

    def exists(self, stage: int) -> bool:
        """Finished means that a record names it and all files it lists are there, whole."""
        record = self.record(stage)
        if record is None:
            return False
        return all(
            hadoop.file_sizes(self.spark, f"{self.path(stage)}/{folder}").items() >= {n: size for n, size in part["files"].items()}.items()
            for folder, part in record["parts"].items()
        )

    def notes(self, stage: int) -> dict:
        record = self.record(stage)
        return record["notes"] if record else {}

    def _write(self, stage: int, df: DataFrame) -> tuple[str, dict]:
        folder = f"data_{uuid.uuid4().hex}"
        df.write.partitionBy("split").parquet(f"{self.path(stage)}/{folder}")
        return folder, {"schema": df.schema.json(), "files": hadoop.file_sizes(self.spark, f"{self.path(stage)}/{folder}")}

    def _commit(self, stage: int, parts: dict, notes: dict) -> None:
        before = self._records(stage)
        number = before[-1] + 1 if before else 0
        hadoop.write_text(self.spark, f"{self.path(stage)}/commit_{number}.json", json.dumps({"parts": parts, "notes": notes}))
        kept = {*parts, f"commit_{number}.json"}
        for name in hadoop.list_names(self.spark, self.path(stage)):
            if name not in kept:
                hadoop.delete_folder(self.spark, f"{self.path(stage)}/{name}")

    def save(self, stage: int, df: DataFrame, notes: Mapping | None = None) -> None:
        folder, part = self._write(stage, df)
        self._commit(stage, {folder: part}, dict(notes or {}))

    def save_split(self, stage: int, df: DataFrame, split: str) -> None:
        """Replace one split of a stage and leave the others as they are."""
        record = self.record(stage) or {"parts": {}, "notes": {}}
        folder, part = self._write(stage, df.where(F.col("split") == split))
        parts = {folder: part}
        for old, held in record["parts"].items():
            rest = {n: size for n, size in held["files"].items() if not n.startswith(f"split={split}/")}
            if rest:
                parts[old] = {"schema": held["schema"], "files": rest}
        self._commit(stage, parts, record["notes"])

    def load(self, stage: int, split: str | None = None) -> DataFrame:
        if not self.exists(stage):
            raise FileNotFoundError(f"no finished stage {stage} under {self.root}")
        whole = None
        for folder, part in self.record(stage)["parts"].items():
            base = f"{self.path(stage)}/{folder}"
            schema = T.StructType.fromJson(json.loads(part["schema"]))
            splits = sorted({n.split("/")[0] for n in part["files"]})
            reader = self.spark.read.schema(schema).option("basePath", base)
            df = reader.parquet(*(f"{base}/{s}" for s in splits)) if splits else self.spark.createDataFrame([], schema)
            df = df if split is None else df.where(F.col("split") == split)
            # splits written one by one may differ in their columns
            whole = df if whole is None else whole.unionByName(df, allowMissingColumns=True)
        return whole

    def ensure(self, stage: int, build: Callable[[], DataFrame]) -> DataFrame:
        """The stored stage if it is finished, else build, store and return it."""
        if not self.exists(stage):
            self.save(stage, build())
        return self.load(stage)

    def latest(self, fits: Callable[[int], bool] = lambda stage: True) -> int | None:
        """Highest finished stage number, of those that fit."""
        found = (_STAGE_NAME.fullmatch(name) for name in hadoop.list_names(self.spark, self.root))
        numbers = sorted((int(m.group(1)) for m in found if m), reverse=True)
        return next((n for n in numbers if fits(n) and self.exists(n)), None)


def content_identity(df: DataFrame) -> str:
    """Digest of schema and rows, whatever their order; one pass over the data."""
    columns = F.struct(*(F.col(f"`{c}`") for c in df.columns))
    row = df.agg(
        F.count(F.lit(1)),
        F.sum(F.xxhash64(columns).cast("decimal(38,0)")),
        F.bit_xor(F.xxhash64(F.lit(1), columns)),
    ).first()
    return hashlib.md5(f"{df.schema.json()}{tuple(row)}".encode()).hexdigest()


class FeatureCache:
    """Features keyed by trip id; name and parameters together make the path."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str, parameters: Mapping[str, object]) -> str:
        settings = "_".join(f"{key}={parameters[key]}" for key in sorted(parameters))
        return f"{self.root}/{name}/{settings or 'default'}"

    def get(self, name: str, parameters: Mapping[str, object], build: Callable[[], DataFrame]) -> DataFrame:
        path = self.path(name, parameters)
        if not hadoop.exists(self.spark, f"{path}/_SUCCESS"):
            features = build()
            if "id" not in features.columns:
                raise ValueError("cached features need the id column")
            features.write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)


class BucketedFeatures:
    """Features that depend on a trip alone, by trip id, in tables bucketed by id; only new trips are built.

    An extension looks up which ids are there by an anti join and builds the others, so its work goes
    with what is new. Tables of one number of buckets join by id without a shuffle. A write that breaks
    off leaves whole rows or none, and what it left out is built next time.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets

    def path(self, name: str, parameters: Mapping[str, object]) -> str:
        settings = "_".join(f"{key}={parameters[key]}" for key in sorted(parameters))
        return f"{self.root}/{name}/{settings or 'default'}_by_{self.buckets}"

    def _table(self, path: str) -> str:
        """Name of the table over the path, made known to this session if it is not."""
        name = f"features_{hashlib.md5(path.encode()).hexdigest()[:16]}"
        if not self.spark.catalog.tableExists(name) and hadoop.exists(self.spark, f"{path}/_SUCCESS"):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.spark.read.parquet(path).schema)
            self.spark.sql(
                f"create table {name} ({columns}) using parquet clustered by (id) sorted by (id) into {self.buckets} buckets location '{path}'"
            )
        return name

    def extend(
        self, name: str, parameters: Mapping[str, object], trips: DataFrame, build: Callable[[DataFrame], DataFrame]
    ) -> DataFrame:
        """The features of all trips seen so far, after building those of ``trips`` that are not there."""
        path = self.path(name, parameters)
        table = self._table(path)
        known = self.spark.catalog.tableExists(table)
        new = trips.join(self.spark.table(table).select("id"), "id", "left_anti") if known else trips
        features = build(new)
        if "id" not in features.columns:
            raise ValueError("cached features need the id column")
        writer = features.write.format("parquet").mode("append").bucketBy(self.buckets, "id").sortBy("id")
        writer.option("path", path).saveAsTable(table)
        self.spark.catalog.refreshTable(table)
        return self.spark.table(table)


def join_features(df: DataFrame, features: DataFrame) -> DataFrame:
    """Add cached features to trips by id."""
    return df.join(features, "id", "left")


