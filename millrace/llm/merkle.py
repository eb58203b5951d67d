"""Merkle manifest of a table, with a witness for every row, by incremental witnesses.

Leaves of one tree are appended in order. A run of eight siblings closes when the last of them comes;
each of them is a subtree with leaves, and the witnesses of these leaves, partial until then, grow by the
siblings of their subtree. So a witness is never looked up: it is extended whenever something above it
closes. What is still open at the end closes as it is.

Spark deals out aligned blocks of 4,096 leaves, each a run of appends of its own. Block roots
are then the leaves of further appends, until each tree has one node; the roots of all trees are appended
to one last tree. On the way back the witness of a block's root extends those of the leaves in the block.
A task holds one block at a time, and what is shuffled are digests, never texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.keys import add_sequential_key
from millrace.sources.storage import stage


@dataclass(frozen=True)
class Shape:
    """Siblings of a run, and levels of a block: a group has at most ``fan ** height`` rows."""

    fan: int = 8
    height: int = 4

    @property
    def block(self) -> int:
        return self.fan**self.height

    def levels(self, nodes: int) -> int:
        """Closings above a run of ``nodes`` until one node is left."""
        found, room = 0, 1
        while room < nodes:
            found, room = found + 1, room * self.fan
        return found


_STEPS = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
STEPS = "array<struct<left: string, right: string>>"
_NODE = "tree string, at long, digest string, nodes long"


class Appending:
    """One aligned block: open subtrees by level, each with the partial witnesses of its leaves."""

    def __init__(self, height: int, fan: int):
        self.height, self.fan = height, fan
        self.open: list[list[tuple[str, list]]] = [[] for _ in range(height + 1)]
        self.witnesses: list[list[tuple[str, str]]] = []

    def append(self, digest: str) -> None:
        witness: list[tuple[str, str]] = []
        self.witnesses.append(witness)
        self._add(digest, [witness], 0)

    def _add(self, digest: str, leaves: list, level: int) -> None:
        self.open[level].append((digest, leaves))
        if level < self.height and len(self.open[level]) == self.fan:
            self._close(level)

    def _close(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        digests = [digest for digest, _ in run]
        below: list = []
        for place, (_, leaves) in enumerate(run):
            step = "".join(digests[:place]), "".join(digests[place + 1 :])
            for witness in leaves:
                witness.append(step)
            below += leaves
        whole = hashlib.sha256("".join(digests).encode("ascii")).hexdigest()
        self._add(whole, below, level + 1)

    def root(self) -> str:
        """Close what is open, from the leaves up; no append may follow."""
        for level in range(self.height):
            if self.open[level]:
                self._close(level)
        ((digest, _),) = self.open[self.height]
        return digest


def append_all(digests: Iterable[str], height: int, fan: int) -> tuple[str, list[list[tuple[str, str]]]]:
    """Root of one block and the witness of each of its leaves."""
    block = Appending(height, fan)
    for digest in digests:
        block.append(digest)
    return block.root(), block.witnesses


def _block(shape: Shape) -> Column:
    return F.expr(f"at div {shape.block}L").alias("block")


def _grown(rows: pa.Table, shape: Shape) -> tuple[pa.Table, str, list]:
    rows = rows.sort_by("at")
    height = min(shape.height, shape.levels(rows.column("nodes")[0].as_py()))
    return rows, *append_all(rows.column("digest").to_pylist(), height, shape.fan)


def _roots(nodes: DataFrame, shape: Shape) -> DataFrame:
    """The root of each block, as a node of the next layer."""

    def run(rows: pa.Table) -> pa.Table:
        rows, root, _ = _grown(rows, shape)
        left = -(-rows.column("nodes")[0].as_py() // shape.block)
        at = rows.column("at")[0].as_py() // shape.block
        tree = rows.column("tree")[0].as_py()
        return pa.table(
            {"tree": [tree], "at": [at], "digest": [root], "nodes": [left]},
            schema=pa.schema(
                [("tree", pa.string()), ("at", pa.int64()), ("digest", pa.string()), ("nodes", pa.int64())]
            ),
        )

    slim = nodes.select("tree", "at", "digest", "nodes")
    return slim.groupBy("tree", _block(shape)).applyInArrow(run, _NODE)


def _extend(nodes: DataFrame, above: DataFrame, shape: Shape) -> DataFrame:
    """``nodes`` with ``steps``: siblings in their own block, then those of ``above`` (tree, at, steps, top)."""

    def run(rows: pa.Table, parent: pa.Table) -> pa.Table:
        rows, _, witnesses = _grown(rows, shape)
        rest = [(s["left"], s["right"]) for s in parent.column("steps")[0].as_py()]
        steps = pa.array([own + rest for own in witnesses], _STEPS)
        top = pa.array([parent.column("top")[0].as_py()] * rows.num_rows, pa.string())
        return rows.append_column("steps", steps).append_column("top", top)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema)
    parents = above.select("tree", F.col("at").alias("block"), "steps", "top")
    return (
        nodes.groupBy("tree", _block(shape))
        .cogroup(parents.groupBy("tree", "block"))
        .applyInArrow(run, f"{schema}, steps {STEPS}, top string")
    )


def _layers(nodes: DataFrame, shape: Shape) -> list[DataFrame]:
    """``nodes``, then the nodes of each further layer, until every tree has one."""
    found = [nodes]
    most = nodes.agg(F.max("nodes")).first()[0] or 0
    while most > 1:
        found.append(stage(_roots(found[-1], shape), "nodes"))
        most = -(-most // shape.block)
    return found


def manifest(leaves: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """``leaves`` (tree, key, digest, and columns to carry) with ``subroot``, ``root`` and ``steps``.

    ``tree`` is text or NULL, ``digest`` hexadecimal text. Leaves of a tree stand in the order of
    ``key``, NULL first, then of ``digest``; equal rows are leaves each. ``steps`` holds for each level,
    from the leaf to the root, the digests to the left and to the right of the path, concatenated; a
    level of a run of one has empty texts. The columns ``at``, ``nodes``, ``top`` and ``_tie`` must not
    be in use. An empty table gives no rows.
    """
    # A text for every tree, in the same order: NULL is empty, others have a sign in front.
    named = leaves.withColumns(
        {
            "_name": F.col("tree"),
            "tree": F.coalesce(F.concat(F.lit("="), F.col("tree")), F.lit("")),
            # Equal rows may stand in any order, and a range sort can then part them.
            "_tie": F.monotonically_increasing_id(),
        }
    )
    ordered = add_sequential_key(
        stage(named, "leaves"), [F.asc("tree"), F.asc_nulls_first("key"), F.asc("digest"), F.asc("_tie")], "at"
    )
    trees = stage(
        ordered.groupBy("tree").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("nodes")), "trees"
    )
    placed = ordered.drop("_tie").join(trees, "tree").withColumn("at", F.col("at") - F.col("first"))
    docs = _layers(placed.drop("first"), shape)

    subroots = docs[-1].select(F.col("tree").alias("_of"), "digest")
    # One row for each tree.
    numbered = add_sequential_key(subroots, ["_of"], "at").select(
        F.lit("").alias("tree"), (F.col("at") - 1).alias("at"), "digest", "_of"
    )
    count = F.lit(trees.count()).alias("nodes")
    heads = _layers(numbered.select("tree", "at", "digest", count, "_of"), shape)
    last = heads[-1].agg(F.max("digest")).first()[0]
    # One row, written, since it is joined to the layer it may come from.
    above = stage(
        heads[-1].select(
            "tree", "at", F.array().cast(STEPS).alias("steps"), F.lit(None).cast("string").alias("top")
        ),
        "top",
    )
    for nodes in reversed(heads[:-1] or heads):
        above = _extend(nodes, above, shape)
    # Each tree's own root is the only node of its last layer.
    above = above.select(
        F.col("_of").alias("tree"), F.lit(0).cast("long").alias("at"), "steps", F.col("digest").alias("top")
    )
    for nodes in reversed(docs[:-1] or docs):
        above = _extend(nodes, above, shape)
    return above.select(
        *(F.col("_name").alias("tree") if c == "tree" else F.col(f"`{c}`") for c in leaves.columns),
        F.col("top").alias("subroot"),
        F.lit(last).alias("root"),
        "steps",
    )


def fold(digest: Column | str, steps: Column | str) -> Column:
    """The root that a leaf and its witness lead to."""
    start = F.col(digest) if isinstance(digest, str) else digest
    return F.aggregate(
        steps, start, lambda own, step: F.sha2(F.concat(step["left"], own, step["right"]), 256)
    )


def proof_digest(steps: Column | str) -> Column:
    """SHA-256 of all digests of a witness, from the leaf up and from left to right."""
    texts = F.transform(steps, lambda step: F.concat(step["left"], step["right"]))
    return F.sha2(F.array_join(texts, ""), 256)


def leaf_digest(*columns: Column) -> Column:
    """SHA-256 of values told apart by their lengths: ``-`` for NULL, else byte count, colon, value."""
    parts = []
    for column in columns:
        text = column.cast("string")
        sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
        parts.append(F.coalesce(sized, F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def check_documents(docs: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """A manifest of ``docs`` by language, and whether tampered rows still lead to its root.

    (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) for each row. Rows whose
    checksum of ``doc_id`` is divisible by three are folded with A-Z of their text in lower case, so
    they fail unless the text has no such letter. Defined results: a NULL column counts as ``-``; NULL
    languages form a tree of their own; a NULL ``doc_id`` comes first and is not tampered with; repeated
    rows, and several texts under one ``doc_id``, are leaves each; an empty table gives no rows; other
    columns are not read.
    """
    def own(text: Column) -> Column:
        return leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)

    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    changed = own(F.translate("text", _UPPER, _LOWER))
    leaves = docs.select(
        F.col("lang").alias("tree"),
        F.col("doc_id").alias("key"),
        own(F.col("text")).alias("digest"),
        F.when(tampered, changed).alias("changed"),
    )
    found = manifest(leaves, shape).withColumn("folded", fold(F.coalesce("changed", "digest"), "steps"))
    return found.select(
        F.col("key").alias("doc_id"),
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        proof_digest("steps").alias("proof_sha256"),
        F.col("folded").alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )
