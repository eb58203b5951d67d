"""Append-only records whose numbers no two writers can both take.

A record is one small JSON file named by its key and number. It is written under a name of its own and then
published under its final one, which only one writer can create: by a hard link on a local file system, by a
rename elsewhere (on HDFS and its like a rename onto a file fails). The loser looks again and takes the
next number, so numbers are different and without gaps, and a reader sees whole records or none. A table
over the folder has all records as rows.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _folder(spark: SparkSession, table: str) -> str:
    """Where the records of a table lie: beside the database's tables."""
    database, name = table.rsplit(".", 1)
    return f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/_records/{name}"


def _file_system(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())


def _publish(spark: SparkSession, folder: str, name: str, text: str) -> bool:
    """Create ``folder/name`` with its whole content, unless there is such a file: then False."""
    jvm = spark._jvm
    fs, path = _file_system(spark, folder), jvm.org.apache.hadoop.fs.Path
    own, final = path(f"{folder}/_new-{uuid.uuid4().hex}"), path(f"{folder}/{name}")
    fs.mkdirs(path(folder))
    out = fs.create(own, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    try:
        if fs.getUri().getScheme() == "file":
            no_more = spark.sparkContext._gateway.new_array(jvm.java.lang.String, 0)
            source, target = (jvm.java.nio.file.Paths.get(p.toUri().getPath(), no_more) for p in (own, final))
            jvm.java.nio.file.Files.createLink(target, source)
            return True
        return fs.rename(own, final)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    finally:
        fs.delete(own, False)


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, path = _file_system(spark, folder), spark._jvm.org.apache.hadoop.fs.Path(folder)
    return [status.getPath().getName() for status in fs.listStatus(path)] if fs.exists(path) else []


def append_numbered(
    spark: SparkSession,
    table: str,
    schema: str,
    key: str,
    row: Callable[[int], Mapping[str, Any]],
) -> int:
    """Add a record to ``table`` (database.name) under the next number of ``key``, from 1; return it.

    ``row`` gives the record for a number. The table is created over the records when it is first needed.
    """
    folder = _folder(spark, table)
    prefix = hashlib.sha256(key.encode("utf-8")).hexdigest()[:24] + "-"
    if not spark.catalog.tableExists(table):
        _file_system(spark, folder).mkdirs(spark._jvm.org.apache.hadoop.fs.Path(folder))
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({schema}) USING json LOCATION '{folder}'")
    taken = [int(n[len(prefix) : -5]) for n in _names(spark, folder) if n.startswith(prefix)]
    number = max(taken, default=0) + 1
    while not _publish(spark, folder, f"{prefix}{number:09d}.json", json.dumps(row(number)) + "\n"):
        number += 1
    spark.catalog.refreshTable(table)
    return number

