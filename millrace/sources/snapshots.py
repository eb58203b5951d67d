"""Tables that keep their earlier versions, and the changes between two versions.

Versions are written by one writer at a time: the next number is read and then used.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources.storage import delete_path
from millrace.sources.tables import add_columns, align, merged_schema, table_details

VERSION = "snapshot_version"
CHANGE = "change_type"
COMMIT = "commit_version"
# Table property that turns recording on and names the key.
CHANGE_KEY = "millrace.change_key"


def partition_values(spark: SparkSession, table: str) -> list[int]:
    """Values of a table's only partition column in ascending order, from the catalog alone."""
    rows = spark.sql(f"SHOW PARTITIONS {table}").collect()
    return sorted(int(r["partition"].split("=")[1]) for r in rows)


def snapshot_versions(spark: SparkSession, table: str) -> list[int]:
    """Stored versions in ascending order."""
    return partition_values(spark, table)


def write_snapshot(
    df: DataFrame, table: str, bucket_key: str | None = None, buckets: int = 0
) -> int:
    """Store ``df`` as the next version of ``table`` and return its number, from 0.

    Each version is one partition, known to the catalog only when it is complete; what a failed
    attempt left in its folder is removed first. With a ``bucket_key`` at the first write, all
    versions are bucketed by it, and :func:`change_feed` on that key then needs no shuffle. If changes
    are recorded (:func:`record_changes`), those of this version are stored as well.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        first = df.withColumn(VERSION, F.lit(0).cast("bigint"))
        if bucket_key:
            first = first.repartition(buckets, F.col(f"`{bucket_key}`"))
            writer = first.write.bucketBy(buckets, bucket_key).sortBy(bucket_key)
        else:
            writer = first.write
        writer.partitionBy(VERSION).saveAsTable(table)
        return 0
    version = max(snapshot_versions(spark, table), default=-1) + 1
    _append_partition(df, table, VERSION, version)
    key = recorded_key(spark, table)
    if key is not None:
        _store_changes(spark, table, version, key)
    return version


def _append_partition(df: DataFrame, table: str, column: str, value: int) -> None:
    """Add one partition to a table; columns that are new in ``df`` are added to the table."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        rows = df.withColumn(column, F.lit(value).cast("bigint"))
        rows.limit(0).write.partitionBy(column).saveAsTable(table)
    current = spark.table(table).drop(column).schema
    target = merged_schema(current, df.schema)
    add_columns(spark, table, target.fields[len(current.fields) :])
    aligned = align(df, target)
    details = table_details(spark, table)
    if int(details.get("Num Buckets", 0)) > 0:
        key = details["Bucket Columns"].strip("[]`")
        aligned = aligned.repartition(int(details["Num Buckets"]), F.col(f"`{key}`"))
    delete_path(spark, f"{details['Location'].rstrip('/')}/{column}={value}")
    spark.sql(
        f"INSERT INTO TABLE {table} PARTITION ({column} = {value}) SELECT * FROM {{rows}}", rows=aligned
    )


def read_snapshot(spark: SparkSession, table: str, version: int | None = None) -> DataFrame:
    """One stored version, the newest by default; only its partition is read."""
    stored = snapshot_versions(spark, table)
    if version is None and stored:
        version = stored[-1]
    if version not in stored:
        raise ValueError(f"{table} has no version {version}")
    return spark.table(table).where(F.col(VERSION) == version).drop(VERSION)


# --- changes between versions --------------------------------------------------------------------


def row_digest(fields: Sequence[T.StructField]) -> tuple[Column, Column]:
    """Two 64-bit hashes of a row that tell NULL from every value, wherever it stands."""
    nested = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
    flags, values = [], []
    for field in fields:
        column = F.col(f"`{field.name}`")
        flags.append(column.isNull())
        if isinstance(field.dataType, nested):
            # Hashes pass over NULLs inside of lists; text does not.
            column = F.to_json(F.struct(column), {"ignoreNullFields": "false"})
        values.append(column)
    return F.xxhash64(*flags, *values), F.xxhash64(F.lit("second"), *flags, *values)


def _digests(rows: DataFrame, key: str, prefix: str) -> DataFrame:
    """(key, two hashes) of the row of each key; a key with two rows stops the query."""
    column = F.col(f"`{key}`")
    first, second = row_digest(rows.schema.fields)
    hashed = rows.where(column.isNotNull()).select(column, first.alias("_d1"), second.alias("_d2"))
    single = F.when(F.count(F.lit(1)) == 1, F.max("_d1")).otherwise(_doubled(key, column, "bigint"))
    return hashed.groupBy(column).agg(
        single.alias(f"{prefix}1"), F.max("_d2").alias(f"{prefix}2")
    )


def _doubled(key: str, column: Column, kind: str) -> Column:
    message = F.concat(F.lit(f"more than one row of a version has {key} "), column.cast("string"))
    return F.raise_error(message).cast(kind)


def change_feed(old: DataFrame, new: DataFrame, key: str, images: bool = False) -> DataFrame:
    """Rows that were inserted, deleted or updated between two versions with a unique key.

    Each changed key comes once, with its new values (old values for a delete) and ``change_type``; with
    ``images`` an update comes twice, as ``update_preimage`` and ``update_postimage``. Values and keys are
    compared so that NULL equals NULL, and a column that one side lacks counts as NULL. A key that
    comes twice in one version stops the query.

    Only keys and 128-bit digests of rows meet to tell what has changed; the columns of changed keys are
    fetched afterwards. Versions bucketed by the key need no shuffle for any of it. The one row without a
    key that a version may have is looked up first.
    """
    schema = merged_schema(old.schema, new.schema)
    old, new = align(old, schema), align(new, schema)
    column = F.col(f"`{key}`")
    met = _digests(new, key, "_new").join(_digests(old, key, "_old"), key, "left")
    differs = (F.col("_new1") != F.col("_old1")) | (F.col("_new2") != F.col("_old2"))
    updated = "update_postimage" if images else "update"
    kind = F.when(F.col("_old1").isNull(), "insert").when(differs, updated)
    written = met.select(column, kind.alias(CHANGE)).where(F.col(CHANGE).isNotNull())
    # Digests cover the keys of the new version; here those of the old one alone are checked.
    known = old.where(column.isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    lost = known.join(new.where(column.isNotNull()).select(column), key, "left_anti").select(
        column, F.when(F.col("_n") == 1, "delete").otherwise(_doubled(key, column, "string")).alias(CHANGE)
    )
    parts = [new.join(written, key), old.join(lost, key)]
    if images:
        earlier = written.where(F.col(CHANGE) == updated).withColumn(CHANGE, F.lit("update_preimage"))
        parts.append(old.join(earlier, key))
    parts += _change_without_key(old, new, key, images)
    fields = [f.name for f in schema if f.name.lower() != key.lower()]
    listed = [p.select(column, *(F.col(f"`{c}`") for c in fields), CHANGE) for p in parts]
    return reduce(DataFrame.unionByName, listed)


def _change_without_key(old: DataFrame, new: DataFrame, key: str, images: bool) -> list[DataFrame]:
    """The change of the row whose key is NULL, if there is one: two rows at most are read of each side."""
    first, second = row_digest(new.schema.fields)
    found = []
    for side in (old, new):
        rows = side.where(F.col(f"`{key}`").isNull()).withColumns({"_d1": first, "_d2": second}).limit(2).collect()
        if len(rows) > 1:
            raise ValueError(f"more than one row of a version has no {key}")
        found.append((rows[0][:-2], rows[0][-2:]) if rows else (None, None))
    (before, old_digest), (after, new_digest) = found
    if old_digest == new_digest:
        return []
    changes = []
    if before is None:
        changes.append((after, "insert"))
    elif after is None:
        changes.append((before, "delete"))
    elif images:
        changes += [(before, "update_preimage"), (after, "update_postimage")]
    else:
        changes.append((after, "update"))
    return [
        old.sparkSession.createDataFrame([row], new.schema).withColumn(CHANGE, F.lit(kind))
        for row, kind in changes
    ]


def record_changes(spark: SparkSession, table: str, key: str) -> None:
    """From its next version on, store the changes of each version of ``table`` beside it.

    ``key`` must be unique in every version. Changes go to the table ``<table>_changes``, a partition for
    each version, with both images of every update; :func:`table_changes` reads them.
    """
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{CHANGE_KEY}' = '{key}')")


def recorded_key(spark: SparkSession, table: str) -> str | None:
    """The key by which changes of ``table`` are recorded, if they are."""
    properties = dict(map(tuple, spark.sql(f"SHOW TBLPROPERTIES {table}").collect()))
    return properties.get(CHANGE_KEY)


def _store_changes(spark: SparkSession, table: str, version: int, key: str) -> None:
    feed = _difference(spark, table, version, key)
    _append_partition(feed, f"{table}_changes", COMMIT, version)


def _difference(spark: SparkSession, table: str, version: int, key: str) -> DataFrame:
    stored = snapshot_versions(spark, table)
    earlier = [v for v in stored if v < version]
    if version not in stored or not earlier:
        raise ValueError(f"{table} has no version {version} with one before it")
    return change_feed(
        read_snapshot(spark, table, earlier[-1]), read_snapshot(spark, table, version), key, images=True
    )


def table_changes(spark: SparkSession, table: str, first: int, last: int) -> DataFrame:
    """All changes after version ``first`` up to version ``last``, with ``commit_version``.

    Recorded changes are read from their partitions. Those of a version that was written before recording
    began, or whose writer was lost in between, are computed from the stored versions.
    """
    key = recorded_key(spark, table)
    if key is None:
        raise ValueError(f"changes of {table} are not recorded")
    versions = [v for v in snapshot_versions(spark, table) if first < v <= last]
    name, recorded = f"{table}_changes", set()
    if spark.catalog.tableExists(name):
        recorded = set(partition_values(spark, name))
    parts = []
    if recorded.intersection(range(first + 1, last + 1)):
        parts.append(spark.table(name).where(F.col(COMMIT).between(first + 1, last)))
    for version in versions:
        if version not in recorded:
            parts.append(_difference(spark, table, version, key).withColumn(COMMIT, F.lit(version).cast("bigint")))
    if not parts:
        empty = read_snapshot(spark, table).limit(0)
        return empty.withColumns({CHANGE: F.lit(""), COMMIT: F.lit(0).cast("bigint")})
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def net_changes(changes: DataFrame, key: str) -> DataFrame:
    """What many versions changed in all, from :func:`table_changes`: one row for each changed key at most.

    The rows are those of :func:`change_feed` between the versions before the first and after the last
    change. Again keys, versions and digests meet first: the earliest image of a key tells whether and as
    what it was there before, the latest one what it is now. A row that came and went, or that is again
    what it was, has not changed. Then the columns of the images that count are fetched.
    """
    column = F.col(f"`{key}`")
    fields = [f for f in changes.schema.fields if f.name not in (CHANGE, COMMIT)]
    first, second = row_digest(fields)
    was = F.col(CHANGE).isin("delete", "update_preimage")
    light = changes.select(
        column, F.col(COMMIT).alias("_v"), was.alias("_was"), first.alias("_d1"), second.alias("_d2")
    )

    def picked(function: str, value: str, side: str) -> Column:
        ordered = f"{value}, _v" if "by" in function else value
        return F.expr(f"{function}({ordered}) FILTER (WHERE {side})")

    ends = light.groupBy(column).agg(
        F.min("_v").alias("_low"),
        F.max("_v").alias("_high"),
        picked("min", "_v", "_was").alias("_before"),
        picked("max", "_v", "NOT _was").alias("_after"),
        *(picked("min_by", d, "_was").alias(f"_old{d}") for d in ("_d1", "_d2")),
        *(picked("max_by", d, "NOT _was").alias(f"_new{d}") for d in ("_d1", "_d2")),
    )
    existed = F.coalesce(F.col("_before") == F.col("_low"), F.lit(False))
    exists = F.coalesce(F.col("_after") == F.col("_high"), F.lit(False))
    same = (F.col("_old_d1") == F.col("_new_d1")) & (F.col("_old_d2") == F.col("_new_d2"))
    kind = (
        F.when(~existed & exists, "insert")
        .when(existed & ~exists, "delete")
        .when(existed & exists & ~same, "update")
    )
    wanted = ends.select(
        column.alias("_key"),
        kind.alias("_kind"),
        F.when(exists, F.col("_after")).otherwise(F.col("_before")).alias("_v"),
        (~exists).alias("_was"),
    ).where(F.col("_kind").isNotNull())
    here = column.eqNullSafe(F.col("_key")) & (F.col(COMMIT) == F.col("_v")) & (was == F.col("_was"))
    rest = [F.col(f"`{f.name}`") for f in fields if f.name.lower() != key.lower()]
    return changes.join(wanted, here).select(column, *rest, F.col("_kind").alias(CHANGE))
