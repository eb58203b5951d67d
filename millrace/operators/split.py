"""Repeatable train/test splits and ordered limits."""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import digest_number, key_digest

# Candidates for the boundary row are ordered once there are no more than this many.
CANDIDATE_LIMIT = 100_000
# Random rows that propose where an order is cut, cuts of one pass, and passes without any progress.
DRAWN = 10_000
CUTS = 31
MOST_TRIES = 3
DIGITS = 3
DIGEST_LENGTH = 32


def _check_size(test_size: float) -> None:
    if not 0 < test_size < 1:
        raise ValueError("test_size must lie between 0 and 1")


def _boundary(
    df: DataFrame, key: str, seed: int, test_size: float, candidate_limit: int
) -> tuple[str, object] | None:
    """Digest of the last test row in the order of digest and key, and its key if that matters.

    The key matters only if the next row has the same digest; otherwise it is None.

    Finds the ⌈n·f⌉-th smallest digest by its leading characters: a scan of the key column counts
    the rows per leading three hex digits, those that hold the boundary are kept, and so on. Each
    pass returns at most 4096 counts, and digests are spread evenly, so each pass leaves 1/4096 of
    the rows.
    """
    hashed = df.select(key_digest(key, seed).alias("d"), F.col(f"`{key}`").alias("k"))
    prefix, wanted = "", None
    while True:
        digits = F.substring("d", len(prefix) + 1, DIGITS).alias("digits")
        rows = hashed.where(F.col("d").startswith(prefix)) if prefix else hashed
        counts = dict(map(tuple, rows.groupBy(digits).count().collect()))
        if wanted is None:
            n = sum(counts.values())
            if n == 0:
                return None
            wanted = math.ceil(n * test_size)
        for leading in sorted(counts):
            if wanted <= counts[leading]:
                break
            wanted -= counts[leading]
        prefix += leading
        if counts[leading] <= candidate_limit:
            break
        if len(prefix) + DIGITS > DIGEST_LENGTH:
            raise ValueError(f"column {key} is not unique: too many rows share one digest")
    # One row more than wanted shows whether the boundary falls between two rows of the same key.
    last, following = (
        hashed.where(F.col("d").startswith(prefix))
        .orderBy("d", "k")
        .limit(wanted + 1)
        .agg(F.sort_array(F.collect_list(F.struct("d", "k"))).alias("rows"))
        .select(F.get("rows", F.lit(wanted - 1)), F.get("rows", F.lit(wanted)))
        .first()
    )
    if following is not None and following == last:
        raise ValueError(f"column {key} is not unique: {last['k']} lies on both sides of the split")
    shared = following is not None and following["d"] == last["d"]
    return last["d"], last["k"] if shared else None


def split_exact(
    df: DataFrame,
    key: str,
    test_size: float = 0.2,
    seed: int = 42,
    candidate_limit: int = CANDIDATE_LIMIT,
) -> tuple[DataFrame, DataFrame]:
    """Training and test part; the test part has exactly ⌈n·test_size⌉ rows.

    Rows are taken in the order of md5(seed:key), so the parts depend on seed and keys alone. Only
    the boundary of that order is looked for, by scans of the key column; both parts are then plain
    filters of ``df``. ``key`` must be unique and not NULL.
    """
    _check_size(test_size)
    boundary = _boundary(df, key, seed, test_size, candidate_limit)
    if boundary is None:
        return df, df
    digest = key_digest(key, seed)
    last_digest, last_key = boundary
    if last_key is None:
        is_test = digest <= last_digest
    else:
        is_test = (digest < last_digest) | (
            (digest == last_digest) & (F.col(f"`{key}`") <= F.lit(last_key))
        )
    return df.where(~is_test), df.where(is_test)


def split_bucket(
    df: DataFrame, key: str, test_size: float = 0.2, seed: int = 42, buckets: int = 1000
) -> tuple[DataFrame, DataFrame]:
    """Training and test part by a hash bucket of the key: a filter, without any job.

    The share of the test part is close to ``test_size`` and not exact. Rows with the same key stay
    together.
    """
    _check_size(test_size)
    test_buckets = Fraction(str(test_size)) * buckets
    if test_buckets.denominator != 1:
        raise ValueError(f"test_size must be a whole number of 1/{buckets} parts")
    bucket = digest_number(key_digest(key, seed)) % buckets
    is_test = bucket < int(test_buckets)
    return df.where(~is_test), df.where(is_test)


# --- the first rows of an order -------------------------------------------------------------------


@dataclass(frozen=True)
class _SortKey:
    """One part of a composite order, with the comparisons that Spark's sort makes."""

    column: Column
    data_type: T.DataType
    falling: bool
    nulls_first: bool

    def ahead(self, value) -> Column:
        """Whether a row stands before ``value`` by this part alone."""
        if value is None:
            return F.lit(False) if self.nulls_first else self.column.isNotNull()
        bound = F.lit(value).cast(self.data_type)
        smaller = F.coalesce(self.column > bound if self.falling else self.column < bound, F.lit(False))
        return smaller | self.column.isNull() if self.nulls_first else smaller

    def same(self, value) -> Column:
        return self.column.eqNullSafe(F.lit(value).cast(self.data_type))


_ORDER = re.compile(r"Column<'(.*) (ASC|DESC) NULLS (FIRST|LAST)'>", re.DOTALL)


def _sort_keys(df: DataFrame, keys: Sequence[str | Column]) -> list[_SortKey]:
    found = []
    for key in keys:
        ordered = None if isinstance(key, str) else _ORDER.fullmatch(str(key))
        name = key if isinstance(key, str) else ordered and ordered[1]
        column = F.col(f"`{name}`") if name in df.columns else F.expr(name) if name else key
        data_type = df.select(column.alias("k")).schema[0].dataType
        falling = bool(ordered) and ordered[2] == "DESC"
        nulls_first = ordered[3] == "FIRST" if ordered else True
        found.append(_SortKey(column, data_type, falling, nulls_first))
    return found


def _stands_before(keys: Sequence[_SortKey], bound: Sequence) -> Column:
    """Whether a row stands before ``bound`` in the composite order; equal rows do not."""
    result = F.lit(False)
    for key, value in reversed(list(zip(keys, bound, strict=True))):
        result = key.ahead(value) | (key.same(value) & result)
    return result


def _part_of(keys: Sequence[_SortKey], cuts: Sequence[Sequence], first: int = 0) -> Column:
    """How many of the sorted cuts a row does not stand before, by halves."""
    if not cuts:
        return F.lit(first)
    middle = len(cuts) // 2
    return F.when(
        _stands_before(keys, cuts[middle]), _part_of(keys, cuts[:middle], first)
    ).otherwise(_part_of(keys, cuts[middle + 1 :], first + middle + 1))


def _cuts(
    inside: DataFrame, keys: Sequence[_SortKey], at: float, rows: int, drawn: int
) -> list[tuple]:
    """Keys of random rows around the share ``at`` of ``rows`` rows, in order and without repeats."""
    named = [k.column.alias(f"k{i}") for i, k in enumerate(keys)]
    falling = {True: F.desc_nulls_first, False: F.desc_nulls_last}
    rising = {True: F.asc_nulls_first, False: F.asc_nulls_last}
    sorts = [(falling if k.falling else rising)[k.nulls_first](f"k{i}") for i, k in enumerate(keys)]
    sample = inside.select(*named, F.rand().alias("_draw")).where(F.col("_draw") < drawn / rows)
    found = [tuple(r)[:-1] for r in sample.orderBy(*sorts).collect()]
    if not found:
        return []
    # Five standard errors of a sample quantile.
    slack = 2.5 / math.sqrt(len(found)) + 1 / len(found)
    low, high = max(0.0, at - slack) * (len(found) - 1), min(1.0, at + slack) * (len(found) - 1)
    picked = [found[round(low + (high - low) * i / CUTS)] for i in range(CUTS + 1)]
    return [cut for i, cut in enumerate(picked) if not i or repr(cut) != repr(picked[i - 1])]


def ordered_limit(
    df: DataFrame, keys: Sequence[str | Column], n: int, merged: int = CANDIDATE_LIMIT
) -> DataFrame:
    """The first ``n`` rows in the order of ``keys``, in that order; ``keys`` must end in a unique one.

    A key is a column's name, or a sort order such as ``F.desc("x")``. Up to ``merged`` rows each task
    keeps its first ``n`` and one task merges them. For more, the place where the result ends is looked
    for first: random keys propose cuts, a scan counts the rows between them, and the part with the
    ``n``-th row is cut again until it has no more than ``merged`` rows. What stands before that part is a
    filter, only the part itself is limited, and the whole is sorted by ranges, so no task gets ``n`` rows.
    The cuts only propose; counts decide, so the result is exact.
    """
    if n <= merged:
        return df.orderBy(*keys).limit(n)
    parts = _sort_keys(df, keys)
    total = df.count()
    if total <= n:
        return df.orderBy(*keys)
    before, inside, low, high = 0, total, None, None
    tries = 0
    while inside > merged and tries < MOST_TRIES:
        rows = df
        if low is not None:
            rows = rows.where(~_stands_before(parts, low))
        if high is not None:
            rows = rows.where(_stands_before(parts, high))
        cuts = _cuts(rows, parts, (n - before) / inside, inside, DRAWN)
        part = _part_of(parts, cuts).alias("part")
        counts = dict(map(tuple, rows.select(part).groupBy("part").count().collect()))
        bounds = [low, *cuts, high]
        whole = inside
        for at in range(len(cuts) + 1):
            inside = counts.get(at, 0)
            if n <= before + inside:
                break
            before += inside
        low, high = bounds[at], bounds[at + 1]
        # Equal keys cannot be cut apart; then any of their rows will do.
        tries = tries + 1 if inside == whole else 0
    rest = df
    if low is not None:
        rest = rest.where(~_stands_before(parts, low))
    if high is not None:
        rest = rest.where(_stands_before(parts, high))
    rest = rest.orderBy(*keys).limit(n - before) if inside <= merged else rest.limit(n - before)
    sure = df.where(_stands_before(parts, low)) if low is not None else df.limit(0)
    return sure.union(rest).orderBy(*keys)
