"""Run ledger and model registry as tables.

``ledger`` and ``registry`` are database names. Rows are only ever appended; the newest one wins. Versions
of models and settings of aliases are numbered records, so many sessions can register at once; runs have
random ids.
"""

from __future__ import annotations

import datetime
import json
import uuid
from collections.abc import Mapping
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.features import signature as make_signature
from millrace.sources.numbered import append_numbered
from millrace.sources.snapshots import read_snapshot
from millrace.sources.tables import read_version

RUNS = "runs"
VERSIONS = "model_versions"
ALIASES = "model_aliases"
LATEST_ALIAS = "latest-model"

RUNS_SCHEMA = (
    "run_id string, experiment string, started_at timestamp, tags map<string,string>, "
    "params map<string,string>, metrics map<string,double>, signature string, model_path string, "
    "dataset_table string, dataset_version bigint, dataset_context string"
)
VERSIONS_SCHEMA = (
    "name string, version bigint, run_id string, path string, tags map<string,string>, "
    "registered_at timestamp"
)
ALIASES_SCHEMA = "name string, alias string, version bigint, set_at timestamp, seq bigint"


def _append(spark: SparkSession, database: str, table: str, row: tuple, schema: str) -> None:
    one = spark.createDataFrame([row], schema)
    one.coalesce(1).write.mode("append").saveAsTable(f"{database}.{table}")


def _now() -> datetime.datetime:
    return datetime.datetime.now(datetime.timezone.utc)


def _texts(values: Mapping[str, Any] | None) -> dict[str, str]:
    return {str(k): str(v) for k, v in (values or {}).items()}


def latest_runs(runs: DataFrame) -> DataFrame:
    """The newest run of every experiment, by start time and then run id."""
    order = F.struct("started_at", "run_id")
    return runs.groupBy("experiment").agg(
        F.max_by("run_id", order).alias("run_id"),
        F.max("started_at").alias("started_at"),
        F.max_by("metrics", order).alias("metrics"),
    )


def newest_versions(versions: DataFrame) -> DataFrame:
    """The highest version of every model."""
    return versions.groupBy("name").agg(
        F.max("version").alias("version"),
        F.max_by("run_id", "version").alias("run_id"),
        F.max_by("path", "version").alias("path"),
    )


def resolve_aliases(aliases: DataFrame, versions: DataFrame) -> DataFrame:
    """What every alias of every model points at: the row with the highest ``seq`` wins."""
    current = aliases.groupBy("name", "alias").agg(F.max_by("version", "seq").alias("version"))
    return current.join(versions.select("name", "version", "run_id", "path"), ["name", "version"])


def log_run(
    spark: SparkSession,
    ledger: str,
    experiment: str,
    model: PipelineModel,
    model_root: str,
    metrics: Mapping[str, float],
    params: Mapping[str, Any] | None = None,
    tags: Mapping[str, str] | None = None,
    dataset: tuple[str, int | None] | None = None,
    inputs: DataFrame | None = None,
    context: str = "training",
    outputs: DataFrame | None = None,
) -> str:
    """Save the model below ``model_root``, append a run and return its id.

    ``dataset`` is the table the model was fitted on and its snapshot version; ``inputs`` is a
    frame of the model's input columns and ``outputs`` one of what it adds; both are recorded as its
    signature.
    """
    run_id = uuid.uuid4().hex
    started_at = _now()
    path = f"{model_root.rstrip('/')}/{run_id}"
    model.write().overwrite().save(path)
    recorded = None
    if inputs is not None:
        recorded = make_signature(inputs, inputs.columns, outputs=outputs)
    table, version = dataset or (None, None)
    row = (
        run_id,
        experiment,
        started_at,
        _texts(tags),
        _texts(params),
        {k: None if v is None else float(v) for k, v in metrics.items()},
        recorded,
        path,
        table,
        version,
        context if dataset else None,
    )
    _append(spark, ledger, RUNS, row, RUNS_SCHEMA)
    return run_id


def run_metadata(spark: SparkSession, ledger: str, run_id: str) -> DataFrame:
    """Metrics, parameters and tags of one run, as one row."""
    runs = spark.table(f"{ledger}.{RUNS}")
    return runs.where(F.col("run_id") == run_id).select("metrics", "params", "tags")


def run_dataset(spark: SparkSession, ledger: str, run_id: str) -> DataFrame:
    """The rows a run was fitted on, in the version it recorded."""
    row = (
        spark.table(f"{ledger}.{RUNS}")
        .where(F.col("run_id") == run_id)
        .select("dataset_table", "dataset_version")
        .first()
    )
    if row is None or row["dataset_table"] is None:
        raise ValueError(f"run {run_id} has no recorded dataset")
    if row["dataset_version"] is None:
        raise ValueError(f"run {run_id} recorded no version of {row['dataset_table']}")
    table, version = row["dataset_table"], row["dataset_version"]
    if any(c.isPartition for c in spark.catalog.listColumns(table)):
        return read_snapshot(spark, table, version)
    return read_version(spark, table, version)


def used_versions(spark: SparkSession, ledger: str, table: str) -> DataFrame:
    """(version) of ``table`` that some run was fitted on."""
    if not spark.catalog.tableExists(f"{ledger}.{RUNS}"):
        return spark.createDataFrame([], "version bigint")
    runs = spark.table(f"{ledger}.{RUNS}").where(F.col("dataset_table") == table)
    return runs.where("dataset_version is not null").select(F.col("dataset_version").alias("version")).distinct()


def latest_run(spark: SparkSession, ledger: str, experiment: str) -> DataFrame:
    """The newest run of one experiment, as one row or none."""
    runs = spark.table(f"{ledger}.{RUNS}")
    return latest_runs(runs.where(F.col("experiment") == experiment))


def register_version(
    spark: SparkSession,
    registry: str,
    name: str,
    run_id: str,
    tags: Mapping[str, str] | None = None,
    ledger: str | None = None,
) -> int:
    """Append a run's model as the next version of ``name``, from 1, and return the number.

    Writers that register at once get different numbers without a gap.
    ``ledger`` is the database of the run, by default the registry's own.
    """
    runs = spark.table(f"{ledger or registry}.{RUNS}").where(F.col("run_id") == run_id)
    run = runs.select("model_path").first()
    if run is None:
        raise LookupError(f"no run {run_id} in {ledger or registry}")

    def row(version: int) -> dict[str, Any]:
        return {
            "name": name,
            "version": version,
            "run_id": run_id,
            "path": run["model_path"],
            "tags": _texts(tags),
            "registered_at": _now().isoformat(),
        }

    return append_numbered(spark, f"{registry}.{VERSIONS}", VERSIONS_SCHEMA, name, row)


def set_alias(spark: SparkSession, registry: str, name: str, alias: str, version: int) -> None:
    """Point an alias at a registered version."""
    stored = spark.table(f"{registry}.{VERSIONS}")
    if stored.where((F.col("name") == name) & (F.col("version") == version)).isEmpty():
        raise ValueError(f"{name} has no version {version}")

    def row(seq: int) -> dict[str, Any]:
        return {"name": name, "alias": alias, "version": version, "set_at": _now().isoformat(), "seq": seq}

    key = json.dumps([name, alias])
    append_numbered(spark, f"{registry}.{ALIASES}", ALIASES_SCHEMA, key, row)


def find_alias(spark: SparkSession, registry: str, name: str, alias: str) -> dict | None:
    """Version, run id and path an alias points at; ``None`` if it was never set."""
    if not spark.catalog.tableExists(f"{registry}.{ALIASES}"):
        return None
    is_model = F.col("name") == name
    aliases = spark.table(f"{registry}.{ALIASES}").where(is_model & (F.col("alias") == alias))
    versions = spark.table(f"{registry}.{VERSIONS}").where(is_model)
    row = resolve_aliases(aliases, versions).first()
    return None if row is None else row.asDict()


def load_alias(
    spark: SparkSession, registry: str, name: str, alias: str = LATEST_ALIAS
) -> PipelineModel:
    """Load the model an alias points at."""
    found = find_alias(spark, registry, name, alias)
    if found is None:
        raise LookupError(f"model {name} has no alias {alias}")
    return PipelineModel.load(found["path"])
