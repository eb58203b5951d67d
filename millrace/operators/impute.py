"""Exact column statistics and filling of missing values."""

from __future__ import annotations

import math
import struct
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from decimal import Context, Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Parts that one pass splits an interval into by distance, and by comparison with cuts.
BUCKETS = 4096
CUTS = 63
# Rank error of 1/1000 for approximate medians: every task sends its whole sketch to one task.
APPROX_ACCURACY = 1_000


def _present(df: DataFrame, name: str) -> Column:
    """``name`` with NaN turned into NULL."""
    column = F.col(f"`{name}`")
    data_type = df.schema[name].dataType
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return F.nanvl(column, F.lit(None).cast(data_type))
    return column


# --- exact medians --------------------------------------------------------------------------------


class _Keys:
    """Integers in the order of the values of one type, with steps of one between neighbours."""

    def __init__(self, data_type: T.DataType):
        self.data_type = data_type
        self.scale = data_type.scale if isinstance(data_type, T.DecimalType) else 0
        self.floating = isinstance(data_type, T.DoubleType)

    def key(self, value) -> int:
        if self.floating:
            # Bits of positive numbers sort as they stand, those of negative ones the other way round.
            (bits,) = struct.unpack("<q", struct.pack("<d", value + 0.0))
            return bits if bits >= 0 else -(bits & 0x7FFFFFFFFFFFFFFF)
        return int(value.scaleb(self.scale, _WIDE)) if isinstance(value, Decimal) else value

    def value(self, key: int):
        if self.floating:
            bits = key if key >= 0 else -key - (1 << 63)
            return struct.unpack("<d", struct.pack("<q", bits))[0]
        if isinstance(self.data_type, T.DecimalType):
            return Decimal(key).scaleb(-self.scale, _WIDE)
        return key

    def literal(self, key: int) -> Column:
        return F.lit(self.value(key)).cast(self.data_type)


# Enough digits for sums of decimals.
_WIDE = Context(prec=80)


@dataclass
class _MedianSearch:
    """The smallest known interval of keys, from a value to a value, that holds the lower middle one.

    ``before`` values come ahead of the interval and ``inside`` lie in it; ``following`` is the key of the
    first value after it, if there is any. ``crowded``: splitting by distance has not helped.
    """

    keys: _Keys
    rank: int
    even: bool
    inside: int
    low: int
    high: int
    before: int = 0
    following: int | None = None
    crowded: bool = False
    buckets: int = BUCKETS

    def interior(self, column: Column) -> Column:
        return column.between(self.keys.literal(self.low), self.keys.literal(self.high))

    def digit(self, column: Column) -> Column:
        """The part of the interval that a value lies in: smaller values never lie in a later part.

        By distance, a part is a share of the interval. Where distances do not fit into a double, or
        have left most values in one part, keys are compared with cuts.
        """
        low, high = self.keys.value(self.low), self.keys.value(self.high)
        least = self.keys.literal(self.low)
        if self.keys.floating:
            # Halves, so that a distance cannot be infinite.
            offset, span = column / 2 - least / 2, high / 2 - low / 2
        elif self.high - self.low < 1 << 62:
            offset, span = (column - least).cast("double"), float(high - low)
        else:
            offset, span = None, 0.0
        if not self.crowded and offset is not None and 0 < span < math.inf:
            share = F.floor(offset / F.lit(span) * self.buckets)
            return F.least(share, F.lit(self.buckets - 1)).cast("int")
        return self._compared(column, self._cuts(), 0)

    def _cuts(self) -> list[int]:
        """Keys that split the interval evenly; the first part holds its lower end alone if need be."""
        span = self.high - self.low
        return sorted({self.low + max(1, span * k // (CUTS + 1)) for k in range(1, CUTS + 1)})

    def _compared(self, column: Column, cuts: list[int], first: int) -> Column:
        """How many of the sorted cuts a value reaches, by halves."""
        if not cuts:
            return F.lit(first)
        middle = len(cuts) // 2
        below = self._compared(column, cuts[:middle], first)
        above = self._compared(column, cuts[middle + 1 :], first + middle + 1)
        return F.when(column < self.keys.literal(cuts[middle]), below).otherwise(above)

    def narrow(self, parts: Sequence[tuple[int, int, int, int]]) -> None:
        """Go on with the part, of (digit, count, lowest key, highest key), that holds the rank."""
        whole = self.inside
        ordered = sorted(parts)
        for at, (_, inside, low, high) in enumerate(ordered):
            if self.rank < self.before + inside:
                break
            self.before += inside
        self.inside, self.low, self.high = inside, low, high
        if at + 1 < len(ordered):
            self.following = ordered[at + 1][2]
        self.crowded = not self.crowded and 2 * inside > whole

    def found(self) -> bool:
        return self.low == self.high

    def median(self):
        lower = self.keys.value(self.low)
        if not self.even or self.rank + 1 < self.before + self.inside:
            return lower
        upper = self.keys.value(self.following)
        if self.keys.floating:
            return (lower + upper) / 2 if math.isfinite(lower + upper) else lower / 2 + upper / 2
        middle = _WIDE.divide(_WIDE.add(Decimal(lower), Decimal(upper)), Decimal(2))
        whole = not isinstance(lower, Decimal) and middle == int(middle)
        return int(middle) if whole else middle


def exact_medians(
    df: DataFrame, columns: Sequence[str], buckets: int = BUCKETS
) -> dict[str, float | int | Decimal | None]:
    """Exact median of each column in its own type; missing values are skipped, no values give None.

    Integers give an integer, or a decimal number that ends in a half; decimals give a decimal number;
    all other types are read as doubles.

    ``median`` itself gathers every distinct value of a column in one task. Here each pass splits the
    interval that holds the middle into parts, by a digit that never falls while values rise, and counts
    the values of each part, with the lowest and the highest one. The part with the middle is the next
    interval; it ends when its lowest value is its highest. Digits only split and comparisons in the
    column's own type decide, so the result is exact whatever the type rounds. All columns share each
    scan; a task sends one row for each part, and the driver reads at most ``buckets`` rows a column.
    """
    if not columns:
        return {}
    exact = (T.IntegralType, T.DecimalType)
    own, kinds = [], {}
    for c in columns:
        present, data_type = _present(df, c), df.schema[c].dataType
        if isinstance(data_type, T.IntegralType):
            data_type = T.LongType()
        elif not isinstance(data_type, exact):
            data_type = T.DoubleType()
        kinds[c] = _Keys(data_type)
        own.append(present.cast(data_type).alias(c))
    scan = df.select(*own)
    values = {c: F.col(f"`{c}`") for c in columns}
    sized = {c: F.struct(F.count(v), F.min(v), F.max(v)) for c, v in values.items()}
    searches: dict[str, _MedianSearch] = {}
    for c, (n, low, high) in _first(scan, sized).items():
        if n:
            keys = kinds[c]
            ends = keys.key(low), keys.key(high)
            searches[c] = _MedianSearch(keys, (n - 1) // 2, n % 2 == 0, n, *ends, buckets=buckets)
    while wide := {c: s for c, s in searches.items() if not s.found()}:
        for c, parts in _count_parts(scan, values, wide).items():
            wide[c].narrow(parts)
    return {c: searches[c].median() if c in searches else None for c in columns}


def _first(scan: DataFrame, aggregates: Mapping[str, Column]) -> dict:
    """The results of some aggregates over ``scan`` by their names."""
    row = scan.agg(*(column.alias(f"a{i}") for i, column in enumerate(aggregates.values()))).first()
    return dict(zip(aggregates, row, strict=True))


def _count_parts(
    scan: DataFrame, values: Mapping[str, Column], searches: Mapping[str, _MedianSearch]
) -> dict[str, list[tuple[int, int, int, int]]]:
    """(digit, count, lowest key, highest key) of each part of each column's interval, in one scan."""
    kinds = list({s.keys.data_type.simpleString(): s.keys.data_type for s in searches.values()}.values())
    each = []
    for i, (c, s) in enumerate(searches.items()):
        inside = s.interior(values[c])
        typed = [
            (values[c] if kind == s.keys.data_type else F.lit(None).cast(kind)).alias(f"v{k}")
            for k, kind in enumerate(kinds)
        ]
        digit = F.when(inside, s.digit(values[c])).alias("digit")
        each.append(F.struct(F.lit(i).alias("i"), digit, *typed))
    rows = scan.select(F.inline(F.array(*each))).where(F.col("digit").isNotNull())
    ends = [f(f"v{k}").alias(f"{name}{k}") for k in range(len(kinds)) for name, f in (("low", F.min), ("high", F.max))]
    found: dict[str, list] = {c: [] for c in searches}
    names = list(searches)
    for r in rows.groupBy("i", "digit").agg(F.count(F.lit(1)).alias("n"), *ends).collect():
        keys = searches[names[r["i"]]].keys
        k = kinds.index(keys.data_type)
        found[names[r["i"]]].append((r["digit"], r["n"], keys.key(r[f"low{k}"]), keys.key(r[f"high{k}"])))
    return found


def column_statistics(
    df: DataFrame, rules: Mapping[str, str | float], approx: bool = False
) -> dict[str, float | int | Decimal | None]:
    """Fill value of each ruled column: ``"median"``, ``"mean"`` or a constant.

    Only these scalars reach the driver. Medians of integers and decimals are exact in their own type.
    ``approx=True`` takes medians from a one-pass sketch.
    """
    unknown = {c: r for c, r in rules.items() if isinstance(r, str) and r not in ("median", "mean")}
    if unknown:
        raise ValueError(f"unknown imputation rules: {unknown}")
    medians = [c for c, r in rules.items() if r == "median"]
    fills: dict[str, float | int | Decimal | None] = {
        c: r for c, r in rules.items() if not isinstance(r, str)
    }
    one_pass = {c: F.avg(_present(df, c)) for c, r in rules.items() if r == "mean"}
    if approx:
        one_pass |= {c: F.percentile_approx(_present(df, c), 0.5, APPROX_ACCURACY) for c in medians}
    else:
        fills |= exact_medians(df, medians)
    if one_pass:
        names = list(one_pass)
        row = df.agg(*(one_pass[c].alias(f"s{i}") for i, c in enumerate(names))).first()
        fills |= {c: row[f"s{i}"] for i, c in enumerate(names)}
    return {c: fills[c] for c in rules}


def fill_missing(
    df: DataFrame, fills: Mapping[str, float | int | Decimal | None]
) -> DataFrame:
    """Replace NULL and NaN by the given value of each column; other columns stay as they are."""
    return df.withColumns(
        {
            c: F.coalesce(_present(df, c), F.lit(value).cast(_filled_type(df, c, value)))
            for c, value in fills.items()
            if value is not None
        }
    )


def _filled_type(df: DataFrame, name: str, value: float) -> T.DataType:
    """The column's own type, or double where that could not hold the fill value."""
    data_type = df.schema[name].dataType
    if isinstance(data_type, T.IntegralType) and value != int(value):
        return T.DoubleType()
    return data_type


def impute(
    df: DataFrame, rules: Mapping[str, str | float], approx: bool = False, exact: bool = False
) -> DataFrame:
    """Fill missing values by a rule per column; columns without a rule keep theirs.

    Integer and decimal columns with a median or mean become double whatever the data, so a table's
    schema follows from its types and rules. With ``exact``, those with a median become decimals with
    one more digit behind the point instead, which holds every value and every median as it is. The
    statistics come first, as a few scans of the ruled columns; the fill itself is a projection with
    constants, so it needs neither join nor shuffle however often the result is read.
    """
    widened = {
        c: F.col(f"`{c}`").cast(_widened(df.schema[c].dataType, exact and rule == "median"))
        for c, rule in rules.items()
        if rule in ("median", "mean") and isinstance(df.schema[c].dataType, (T.IntegralType, T.DecimalType))
    }
    return fill_missing(df.withColumns(widened), column_statistics(df, rules, approx))


def _widened(data_type: T.DataType, exact: bool) -> T.DataType:
    if not exact:
        return T.DoubleType()
    if isinstance(data_type, T.IntegralType):
        return T.DecimalType(20, 1)
    if data_type.precision > 37:
        raise ValueError(f"no decimal type holds the medians of {data_type.simpleString()} exactly")
    return T.DecimalType(data_type.precision + 1, data_type.scale + 1)
