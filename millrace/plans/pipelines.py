"""The three batch jobs: prepare a table, train and promote a model, score a table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.boosting import DEFAULT_PARAMS, fit_mean_boost
from millrace.operators.clean import cast_strict_int, coerce_numeric, select_features, stamp_utc
from millrace.operators.features import check_outputs, check_signature, predict
from millrace.operators.impute import impute
from millrace.operators.keys import add_sequential_key, number_file_rows
from millrace.operators.ledger import (
    LATEST_ALIAS,
    RUNS,
    find_alias,
    log_run,
    register_version,
    set_alias,
    used_versions,
)
from millrace.operators.metrics import decide, gate_columns, metric_columns
from millrace.operators.scoring import save_scored
from millrace.operators.split import split_bucket, split_exact
from millrace.sources.raw_csv import BLOCK, FILE, LINE, read_raw_csv
from millrace.sources.snapshots import read_snapshot, snapshot_versions, write_snapshot
from millrace.sources.storage import stage, stage_scope
from millrace.sources.tables import drop_versions, latest_version, read_version, write_version

UPDATED_AT = "update_timestamp_utc"
MODEL_TYPE = "gradient-boosted trees with one-hot encoding"


@dataclass(frozen=True)
class Columns:
    """Which columns play which part."""

    num: Sequence[str]
    cat: Sequence[str]
    target: str
    key: str = "Id"

    @property
    def features(self) -> list[str]:
        return [*self.num, *self.cat]


def clean_table(
    raw: DataFrame,
    columns: Columns,
    fills: Mapping[str, str | float],
    order_keys: Sequence[str] | None = None,
) -> DataFrame:
    """Type, fill and number the rows of ``raw`` and keep the wanted columns.

    Numbers follow ``order_keys``; without them ``raw`` must carry file positions and the numbers
    follow the file. Typed rows are written once, so that text is parsed once and each statistic
    reads only its own column.
    """
    places = [FILE, BLOCK, LINE] if order_keys is None else list(order_keys)
    typed = cast_strict_int(coerce_numeric(raw, columns.num), columns.target)
    wanted = list(dict.fromkeys([*columns.cat, *columns.num, columns.target, *places]))
    typed = stage(typed.select(*(F.col(f"`{c}`") for c in wanted)), "typed")
    filled = impute(typed, fills)
    if order_keys is None:
        numbered = number_file_rows(filled, columns.key, stored=True)
    else:
        numbered = add_sequential_key(filled, order_keys, columns.key)
    return select_features(numbered, columns.cat, columns.num, columns.target, columns.key)


def prepare(
    spark: SparkSession,
    path: str,
    columns: Columns,
    fills: Mapping[str, str | float],
    train_table: str,
    test_table: str,
    test_size: float = 0.2,
    seed: int = 42,
    sep: str = ",",
    exact: bool = True,
    snapshots: bool = False,
    ledger: str | None = None,
) -> dict[str, tuple[int, int]]:
    """Delimited text to a training and a test table; the rows and columns of each.

    ``exact=False`` splits by hash bucket, which saves the scans that look for the boundary. The rows of
    both tables are replaced, and the replaced versions stay readable as long as a run of ``ledger``, by
    default the training table's database, was fitted on them. ``snapshots=True`` adds a partition to
    each table instead, and none is ever dropped.
    """
    shapes = {}
    with stage_scope(spark):
        raw = read_raw_csv(spark, path, sep, with_position=True)
        cleaned = clean_table(raw, columns, fills)
        split = split_exact if exact else split_bucket
        for part, table in zip(
            split(cleaned, columns.key, test_size, seed), (train_table, test_table), strict=True
        ):
            stamped = stamp_utc(part, UPDATED_AT)
            if snapshots:
                version = write_snapshot(stamped, table)
                stored = read_snapshot(spark, table, version)
            else:
                write_version(stamped, table)
                runs = ledger or table.rpartition(".")[0] or spark.catalog.currentDatabase()
                drop_versions(spark, table, used_versions(spark, runs, table))
                stored = spark.table(table)
            shapes[table] = (stored.count(), len(stored.columns))
    return shapes


def _read(spark: SparkSession, table: str, snapshots: bool) -> tuple[DataFrame, int | None]:
    if not snapshots:
        version = latest_version(spark, table)
        return spark.table(table) if version is None else read_version(spark, table, version), version
    version = snapshot_versions(spark, table)[-1]
    return read_snapshot(spark, table, version), version


def train_and_promote(
    spark: SparkSession,
    train_table: str,
    test_table: str,
    columns: Columns,
    ledger: str,
    model_name: str,
    model_root: str,
    experiment: str,
    params: Mapping[str, Any] | None = None,
    tags: Mapping[str, str] | None = None,
    fit: Callable[..., PipelineModel] = fit_mean_boost,
    alias: str = LATEST_ALIAS,
    snapshots: bool = False,
) -> dict[str, Any]:
    """Fit a model, measure it, log the run, and register it if it beats the aliased model.

    ``fit`` is boosting from the mean, or ``fit_gbt``. The run records the version of the training table.
    Both models score the whole test table in one scan, and one aggregate yields the metrics and
    the comparison. Returns the decision: errors, ``promote``, ``reason``, ``run_id`` and
    ``version`` (``None`` if not promoted). An aliased model that cannot be loaded is an error.
    """
    train, dataset_version = _read(spark, train_table, snapshots)
    test, _ = _read(spark, test_table, snapshots)
    parameters = {**DEFAULT_PARAMS, **(params or {})}
    model = fit(train, columns.cat, columns.num, columns.target, parameters)

    champion = find_alias(spark, ledger, model_name, alias)
    inputs = test.select(*(F.col(f"`{c}`") for c in (*columns.features, columns.target)))
    scored = predict(model, inputs, "_current")
    if champion is not None:
        scored = predict(PipelineModel.load(champion["path"]), scored, "_latest")
    latest = None if champion is None else "_latest"
    measures = metric_columns(columns.target, "_current") | gate_columns(
        columns.target, "_current", latest
    )
    measured = scored.agg(*(c.alias(name) for name, c in measures.items()))
    outcome = decide(measured, champion is not None).first().asDict()

    run_id = log_run(
        spark,
        ledger,
        experiment,
        model,
        model_root,
        metrics={name: outcome[name] for name in ("mse", "mae", "r2_score")},
        params={"model_type": MODEL_TYPE, **parameters},
        tags=tags,
        dataset=(train_table, dataset_version),
        inputs=train.select(*(F.col(f"`{c}`") for c in columns.features)),
        outputs=predict(model, inputs).select("prediction"),
    )
    outcome |= {"run_id": run_id, "version": None}
    if outcome["promote"]:
        outcome["version"] = register_version(spark, ledger, model_name, run_id, tags)
        set_alias(spark, ledger, model_name, alias, outcome["version"])
    return outcome


def score_batch(
    spark: SparkSession,
    input_table: str,
    columns: Columns,
    ledger: str,
    model_name: str,
    output_table: str,
    alias: str = LATEST_ALIAS,
    snapshots: bool = False,
) -> DataFrame | None:
    """Score a table with the aliased model and replace ``output_table``; return that table.

    Each row keeps its columns, without the target, through the model, so predictions need no join.
    An empty input writes nothing and returns ``None``. Inputs and
    outputs must fit the signature of the model's run.
    """
    rows, _ = _read(spark, input_table, snapshots)
    rows = rows.drop(columns.target)
    found = find_alias(spark, ledger, model_name, alias)
    if found is None:
        raise LookupError(f"model {model_name} has no alias {alias}")
    recorded = (
        spark.table(f"{ledger}.{RUNS}")
        .where(F.col("run_id") == found["run_id"])
        .select("signature")
        .first()
    )
    if recorded is not None and recorded["signature"]:
        check_signature(recorded["signature"], rows)
    if rows.isEmpty():
        return None
    scored = predict(PipelineModel.load(found["path"]), rows)
    if recorded is not None and recorded["signature"]:
        check_outputs(recorded["signature"], scored)
    return save_scored(scored, output_table)
