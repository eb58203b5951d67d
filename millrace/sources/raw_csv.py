"""Reading delimited text, with or without line breaks inside its cells.

A line break ends a row unless it stands inside a quoted cell, so where rows start in the middle of a
file depends on all quotes before. Files with such cells are still read in parts, in two passes. The
first counts the quotes of every part of a file; the parity of the sum of all counts before a part says
whether the part begins inside a cell. The second joins the lines of each part to rows, starting where its
first row truly starts. Rows that run over the end of a part are put together from their pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.sources.storage import stage
from millrace.sources.workers import find_package

FILE, BLOCK, LINE = "_file", "_block", "_line"

# What the second pass finds in a part: whole rows, and pieces of rows that reach over its ends.
WHOLE, HEAD, INNER, TAIL = 0, 1, 2, 3
_PIECES = f"{FILE} string, {BLOCK} long, {LINE} long, kind int, record string"


def read_raw_csv(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    with_position: bool = False,
    multiline: bool = False,
) -> DataFrame:
    """Read delimited text with a header line; every column is a string.

    Types are not inferred: that would read the data twice, and one bad cell would turn its whole
    column into text. A quote inside a quoted cell is written twice. A row of another width stops the
    query whatever columns are used, as does a file whose header differs from the first one's. Line
    breaks inside cells need ``multiline=True``; then a cell with a quote must be quoted as a whole, and
    rows are written to the shared folder once, while a file is still read by many tasks.
    ``with_position`` adds where each row stood: file, first byte of the part of the file that a task
    read, and a position that counts up inside that part.
    """
    if multiline:
        rows = _read_quoted(spark, path, sep)
        return rows if with_position else rows.drop(FILE, BLOCK, LINE)
    # With columns pruned the parser would not look at what follows the last one that is used.
    reader = spark.read.option("columnPruning", "false")
    raw = reader.csv(path, header=True, sep=sep, escape='"', enforceSchema=False, mode="FAILFAST")
    if not with_position:
        return raw
    return raw.select(
        "*",
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias(LINE),
    )


def _read_quoted(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """The rows of files whose cells may hold line breaks, with their positions."""
    find_package(spark)
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.col("value").alias("line"),
        (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes"),
    )
    pieces = stage(_cut_into_rows(lines, _open_parts(lines)), "rows")
    whole = pieces.where(F.col("kind") == WHOLE).drop("kind").union(_joined_pieces(pieces))
    return _cells(spark, path, sep, whole)


def _open_parts(lines: DataFrame) -> DataFrame:
    """(part, open): the hash of each part of a file, and whether it begins inside a quoted cell.

    One small row for each part goes through the running sum: nine bytes, so 9 MB for a million parts,
    which is 128 TB in parts of 128 MB. A file whose quotes do not pair up stops the query.
    """
    odd = lines.groupBy(FILE, BLOCK).agg((F.sum("quotes") % 2).alias("odd"))
    file = Window.partitionBy(FILE)
    before = file.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    unpaired = F.raise_error(F.concat(F.lit("a quoted cell is not closed in "), F.col(FILE)))
    parts = odd.select(
        F.xxhash64(FILE, BLOCK).alias("part"),
        F.when(F.sum("odd").over(file) % 2 == 0, F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1)
        .otherwise(unpaired)
        .alias("open"),
    )
    parts = stage(parts, "parts")
    if parts.count() != parts.select("part").distinct().count():
        raise RuntimeError("two parts of files share a hash; store the rows in other files")
    return parts


class _Part:
    """One part of a file, fed with its lines in order."""

    def __init__(self, key: int, file: str, start: int, inside: bool):
        self.key, self.file, self.start = key, file, start
        #: Whether the next line begins in a quoted cell, and whether a row has started in this part.
        self.inside, self.fresh = inside, not inside
        self.number = 0
        self.waiting: list[str] = []

    def feed(self, lines: list[str], quotes: np.ndarray) -> Iterator[tuple[int, int, str]]:
        """(place, kind, text) of each row that ends in these lines."""
        parity = (np.cumsum(quotes) + int(self.inside)) % 2
        self.inside = bool(parity[-1])
        at = 0
        for end in (np.flatnonzero(parity == 0) + 1).tolist():
            # A carriage return before the line break that ends a row belongs to neither.
            text = "\n".join([*self.waiting, *lines[at:end]]).removesuffix("\r")
            self.waiting, at = [], end
            if not self.fresh:
                self.fresh = True
                yield -1, HEAD, text
            elif text:
                yield self.number, WHOLE, text
                self.number += 1
        self.waiting += lines[at:]

    def rest(self) -> Iterator[tuple[int, int, str]]:
        """What no row end follows in this part."""
        if self.waiting:
            text = "\n".join(self.waiting)
            yield (self.number, TAIL, text) if self.fresh else (-1, INNER, text)

    def batch(self, found: Iterator[tuple[int, int, str]]) -> Iterator[pa.RecordBatch]:
        rows = list(found)
        if rows:
            number, kind, text = zip(*rows)
            columns = [
                pa.array([self.file] * len(rows), pa.string()),
                pa.array([self.start] * len(rows), pa.int64()),
                pa.array(number, pa.int64()),
                pa.array(kind, pa.int32()),
                pa.array(text, pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, [FILE, BLOCK, LINE, "kind", "record"])


def _cut_into_rows(lines: DataFrame, parts: DataFrame) -> DataFrame:
    """Whole rows, and pieces of rows at the ends of parts of files; lines are not shuffled.

    ``_line`` counts the rows that start in a part. Lines without a character between rows are no rows.
    """
    marked = lines.withColumn("part", F.xxhash64(FILE, BLOCK)).join(F.broadcast(parts), "part", "left")
    # Both passes must cut files into the same parts.
    changed = F.raise_error(F.lit("files changed, or were cut in another way, between two passes"))
    inside = F.coalesce("open", changed.cast("boolean")).alias("inside")
    marked = marked.select("part", FILE, BLOCK, inside, "quotes", "line")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = None
        for batch in batches:
            keys, quotes = batch.column(0).to_numpy(), batch.column(4).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
            for begin, end in zip(edges, edges[1:]):
                if begin == end:
                    continue
                if part is None or keys[begin] != part.key:
                    if part is not None:
                        yield from part.batch(part.rest())
                    part = _Part(*(batch.column(i)[begin].as_py() for i in range(4)))
                own = batch.column(5).slice(begin, end - begin).to_pylist()
                yield from part.batch(part.feed(own, quotes[begin:end]))
        if part is not None:
            yield from part.batch(part.rest())

    return marked.mapInArrow(run, _PIECES)


def _joined_pieces(pieces: DataFrame) -> DataFrame:
    """Rows that reach over the end of a part: a tail, parts without a row end, and a head.

    Their order comes from a running count over the places alone; the texts then meet by their row.
    """
    broken = pieces.where(F.col("kind") != WHOLE)
    # A part's head stands before its tail.
    order = Window.partitionBy(FILE).orderBy(BLOCK, "kind").rowsBetween(Window.unboundedPreceding, 0)
    owners = broken.select(FILE, BLOCK, "kind").withColumn(
        "row", F.sum((F.col("kind") == TAIL).cast("long")).over(order)
    )
    members = broken.join(owners, [FILE, BLOCK, "kind"])
    parts = F.array_sort(F.collect_list(F.struct(BLOCK, "kind", LINE, "record")))
    joined = members.groupBy(FILE, "row").agg(parts.alias("parts"))
    text = F.array_join(F.transform("parts", lambda x: x["record"]), "\n")
    first = F.col("parts")[0]
    return joined.select(FILE, first[BLOCK].alias(BLOCK), first[LINE].alias(LINE), text.alias("record"))


def _cells(spark: SparkSession, path: str, sep: str, rows: DataFrame) -> DataFrame:
    """Rows as columns named by the header, which is the first row of every file."""
    names = spark.read.csv(path, header=True, sep=sep, escape='"', multiLine=True).columns
    is_first = (F.col(BLOCK) == 0) & (F.col(LINE) == 0)
    headers = rows.where(is_first).select(FILE, "record")
    expected = headers.agg(F.min_by("record", FILE)).first()[0]
    other = F.raise_error(F.concat(F.lit("another header in "), F.col(FILE)))
    is_header = F.when(is_first, F.when(F.col("record") == F.lit(expected), True).otherwise(other))
    # Quoted stretches become marks, so that what is left of separators lies between cells. A cell is
    # either marks or has none. This is a filter, which no choice of columns can prune.
    record, mark = F.col("record"), "\uffff"
    bare = F.when(record.contains('"'), F.regexp_replace(record, '"[^"]*"', mark)).otherwise(record)
    width = (F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit("")))) / len(sep) + 1
    around = f"[^{re.escape(sep)}{mark}]"
    stray = record.contains('"') & bare.rlike(f"{around}{mark}|{mark}{around}")
    malformed = F.raise_error(F.concat(F.lit("malformed row: "), F.substring(record, 1, 200)))
    fits = F.when((width == len(names)) & ~stray, True).otherwise(malformed)
    kept = rows.where(~F.coalesce(is_header, F.lit(False)) & fits)
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    options = {"sep": sep, "escape": '"', "mode": "FAILFAST", "multiLine": "true"}
    parsed = kept.withColumn("_cells", F.from_csv("record", schema, options))
    cells: list[Column] = [F.col(f"_cells.c{i}").alias(name) for i, name in enumerate(names)]
    return parsed.select(*cells, FILE, BLOCK, LINE)
