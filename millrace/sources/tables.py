"""Reading catalog tables and replacing their contents."""

from __future__ import annotations

import datetime
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources.numbered import append_numbered
from millrace.sources.storage import delete_path

VERSION_FOLDER = "_versions"
PREVIOUS = "millrace.previous"
# Property of a table whose versions are kept, and where they are recorded.
KEEPS = "millrace.versions"
VERSION_RECORDS = "table_versions"
VERSION_SCHEMA = (
    "name string, version bigint, path string, format string, columns string, "
    "written_at timestamp, dropped boolean"
)


def scan(spark: SparkSession, table: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A catalog table, or some of its columns."""
    df = spark.table(table)
    return df if columns is None else df.select(*(F.col(f"`{c}`") for c in columns))


def overwrite_table(df: DataFrame, table: str) -> None:
    """Replace a table, schema included. ``df`` must not read from ``table``."""
    df.write.mode("overwrite").saveAsTable(table)


def merged_schema(current: T.StructType, incoming: T.StructType) -> T.StructType:
    """Columns of ``current``, then those that only ``incoming`` has.

    A column that both have must have one type; names are compared without regard to case.
    """
    known = {f.name.lower(): f for f in current}
    for field in incoming:
        old = known.get(field.name.lower())
        if old is not None and old.dataType != field.dataType:
            raise ValueError(
                f"column {field.name} is {old.dataType.simpleString()} in the table "
                f"and {field.dataType.simpleString()} in the new data"
            )
    added = [f for f in incoming if f.name.lower() not in known]
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in [*current, *added]])


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` in its order; those that ``df`` lacks are typed NULLs."""
    present = {c.lower() for c in df.columns}
    return df.select(
        *(
            F.col(f"`{f.name}`").alias(f.name)
            if f.name.lower() in present
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema
        )
    )


def add_columns(spark: SparkSession, table: str, fields: Sequence[T.StructField]) -> None:
    """Add columns to a table; its existing rows hold NULL there."""
    if fields:
        listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({listed})")


def table_details(spark: SparkSession, table: str) -> dict[str, str]:
    """What the catalog knows about a table, such as its location and format."""
    rows = spark.sql(f"DESCRIBE EXTENDED {table}").collect()
    start = [r["col_name"] for r in rows].index("# Detailed Table Information")
    return {r["col_name"]: r["data_type"] for r in rows[start + 1 :]}


def _new_version_path(spark: SparkSession, table: str) -> str:
    *parents, name = table.replace("`", "").split(".")
    database = ".".join(parents) or spark.catalog.currentDatabase()
    base = spark.catalog.getDatabase(database).locationUri.rstrip("/")
    return f"{base}/{VERSION_FOLDER}/{name}/{uuid.uuid4().hex}"


def _replace(df: DataFrame, table: str) -> tuple[str, str | None]:
    """Write ``df`` to a new folder and point ``table`` at it; the new folder and the old one."""
    spark = df.sparkSession
    path = _new_version_path(spark, table)
    if not spark.catalog.tableExists(table):
        df.write.parquet(path)
        spark.catalog.createTable(table, path=path, source="parquet", schema=df.schema)
        return path, None
    if any(column.isPartition for column in spark.catalog.listColumns(table)):
        raise ValueError(f"{table} is partitioned; its folders cannot be replaced as one")
    current = spark.table(table).schema
    target = merged_schema(current, df.schema)
    details = table_details(spark, table)
    align(df, target).write.format(details["Provider"]).save(path)
    add_columns(spark, table, target.fields[len(current.fields) :])
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    spark.catalog.refreshTable(table)
    return path, details["Location"]


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    return dict(map(tuple, spark.sql(f"SHOW TBLPROPERTIES {table}").collect()))


def write_merged(df: DataFrame, table: str) -> None:
    """Replace the rows of ``table`` while its columns grow to include those of ``df``.

    The new rows go to a new folder, and the table is then pointed at it: columns are added first,
    then the location moves. Both are catalog changes, so no data is copied or renamed, the table
    can be read at every moment, a failed write leaves the old rows, and ``df`` may read the table
    it replaces. The replaced folder stays until the next overwrite, for queries still reading it. A
    table that keeps its versions gets another one.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(table) and KEEPS in _properties(spark, table):
        write_version(df, table)
        return
    _, old_path = _replace(df, table)
    if old_path is None:
        return
    outdated = _properties(spark, table).get(PREVIOUS)
    if f"/{VERSION_FOLDER}/" in old_path:
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{PREVIOUS}' = '{old_path}')")
    if outdated:
        delete_path(spark, outdated)


# --- versions of replaced tables -------------------------------------------------------------------


def _recorded(table: str, spark: SparkSession) -> tuple[str, str]:
    """The table of version records of a table's database, and the table's own name there."""
    *parents, name = table.replace("`", "").split(".")
    database = ".".join(parents) or spark.catalog.currentDatabase()
    return f"{database}.{VERSION_RECORDS}", name


def write_version(df: DataFrame, table: str) -> int:
    """:func:`write_merged`, but the replaced rows can still be read; the number of the new version.

    A version is the folder it was written to. Numbers start at 1 and are recorded once the table has the
    new rows. :func:`drop_versions` deletes what is not needed.
    """
    spark = df.sparkSession
    path, _ = _replace(df, table)
    records, name = _recorded(table, spark)

    def row(version: int) -> dict:
        schema = spark.table(table).schema
        details = table_details(spark, table)
        return {
            "name": name,
            "version": version,
            "path": path,
            "format": details["Provider"],
            "columns": schema.json(),
            "written_at": datetime.datetime.now(datetime.timezone.utc).isoformat(),
            "dropped": False,
        }

    version = append_numbered(spark, records, VERSION_SCHEMA, f"written {name}", row)
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{KEEPS}' = 'true')")
    spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ('{PREVIOUS}')")
    return version


def stored_versions(spark: SparkSession, table: str) -> DataFrame:
    """(version, path, format, columns) of the versions of ``table`` that can be read."""
    records, name = _recorded(table, spark)
    if not spark.catalog.tableExists(records):
        return spark.createDataFrame([], "version bigint, path string, format string, columns string")
    spark.catalog.refreshTable(records)
    own = spark.table(records).where(F.col("name") == name)
    dropped = own.where("dropped").select("version")
    kept = own.where("not dropped").join(dropped, "version", "left_anti")
    return kept.select("version", "path", "format", "columns")


def latest_version(spark: SparkSession, table: str) -> int | None:
    """The version that ``table`` now shows; None if it keeps none, or was replaced in another way."""
    if not spark.catalog.tableExists(table):
        return None
    folder = table_details(spark, table)["Location"].rstrip("/").rsplit("/", 1)[1]
    shown = F.element_at(F.split("path", "/"), -1) == folder
    return stored_versions(spark, table).where(shown).agg(F.max("version")).first()[0]


def read_version(spark: SparkSession, table: str, version: int) -> DataFrame:
    """The rows of ``table`` as they were in one of its versions."""
    found = stored_versions(spark, table).where(F.col("version") == version).first()
    if found is None:
        raise ValueError(f"{table} has no version {version}")
    schema = T.StructType.fromJson(json.loads(found["columns"]))
    return spark.read.format(found["format"]).schema(schema).load(found["path"])


def drop_versions(spark: SparkSession, table: str, used: DataFrame) -> list[int]:
    """Delete the versions of ``table`` that are not among ``used`` (version); their numbers.

    The newest version stays, and so does the one before, for queries still reading it. A version is
    recorded as dropped before its folder goes.
    """
    stored = stored_versions(spark, table)
    newest = [r["version"] for r in stored.select("version").orderBy(F.desc("version")).limit(2).collect()]
    outdated = stored.join(used.select("version"), "version", "left_anti")
    gone = outdated.where(~F.col("version").isin(newest)).orderBy("version").collect()
    records, name = _recorded(table, spark)
    for r in gone:
        row = {"name": name, **r.asDict(), "dropped": True}
        append_numbered(spark, records, VERSION_SCHEMA, f"dropped {name}", lambda _, row=row: row)
        delete_path(spark, r["path"])
    return [r["version"] for r in gone]
