"""Whitening of vectors by the exact characteristic polynomial of their integer scatter.

Components of vectors become integers, so n times the scatter about the mean, ``n * sum(x x') - S S'``, is
a matrix of integers that Spark sums up exactly, and everything that follows starts from exact numbers:

1. For each of enough primes, one row and one task's work, the matrix is brought to Hessenberg form modulo
   the prime, which gives its characteristic polynomial there. Chinese remaindering joins these to the
   polynomial over the integers.
2. Its roots are all real, so the number of roots above a place is the number of sign changes of the
   polynomial moved there: intervals that hold one root, or one multiple root, are halved and then
   narrowed to more digits than a double has. Roots at zero are read off the last coefficients.
3. For each root, one row again, the null space of the matrix less the root is found by inverse iteration
   in fixed-point integers of several hundred bits.

Tables of vectors are scanned three times: for the scatter, for the check of the whitened covariance, and
for the result. What the driver holds depends on the number of dimensions alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A component c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Components that are kept at most.
KEEP = 32
#: Bits of the limbs in which integers are multiplied, and vectors multiplied at a time: products of
#: limbs, summed over a chunk, stay below 2 ** 53 and are exact in doubles.
LIMB_BITS = 20
CHUNK = 4096
#: Sums are dealt out in parts of this many bits, so that Spark can add them up as bigints.
PART_BITS = 40
PARTS = 5
#: Bits to which roots are known and in which null spaces are computed, relative to the trace.
ROOT_BITS = 320
WORK_BITS = 384
#: Largest number of dimensions: the driver holds this many squared integers.
MOST_DIMENSIONS = 2048


@dataclass
class Whitening:
    """What :func:`fit` found; ``vectors`` has a row for each component, by falling eigenvalue."""

    n: int
    sums: list[int]
    trace: float
    eigenvalues: np.ndarray
    vectors: np.ndarray
    polynomial: list[int]


def usable(column: str) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    fine = F.forall(column, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    return F.coalesce(F.col(column).isNotNull() & fine, F.lit(False))


def integers(column: str) -> Column:
    """Components as whole numbers: floor(64 * c) + 1000000, c as double."""
    return F.transform(column, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")) + F.lit(SHIFT))


def _matrix(vectors: pa.Array, dimensions: int) -> np.ndarray:
    """Vectors of a batch as rows; another length stops the query."""
    lists = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    if not (np.diff(lists.offsets.to_numpy()) == dimensions).all():
        raise ValueError(f"a vector has not {dimensions} components")
    return lists.flatten().to_numpy().astype(np.int64).reshape(-1, dimensions)


def product_sum(x: np.ndarray) -> list[list[int]]:
    """The exact matrix of sums of products of columns of 64-bit integers."""
    dimensions = x.shape[1]
    most = int(max(abs(int(x.max())), abs(int(x.min())))) if x.size else 0
    limbs = max(1, -(-most.bit_length() // LIMB_BITS))
    rest, split = x, []
    for _ in range(limbs - 1):
        low = rest & ((1 << LIMB_BITS) - 1)
        split.append(low.astype(np.float64))
        rest = (rest - low) >> LIMB_BITS
    split.append(rest.astype(np.float64))
    total = np.zeros((dimensions, dimensions), object)
    for begin in range(0, len(x), CHUNK):
        part = [s[begin : begin + CHUNK] for s in split]
        for i, a in enumerate(part):
            for j, b in enumerate(part):
                total += (a.T @ b).astype(np.int64).astype(object) << (LIMB_BITS * (i + j))
    return total.tolist()


def _parts(value: int) -> list[int]:
    """A number as parts of PART_BITS bits, all but the last one positive."""
    own = []
    for _ in range(PARTS - 1):
        own.append(value & ((1 << PART_BITS) - 1))
        value >>= PART_BITS
    return [*own, value]


def scatter(vectors: DataFrame, dimensions: int) -> tuple[int, list[int], list[list[int]]]:
    """Number of vectors, their sums, and n * sum(x x') - S S', all exact.

    ``vectors`` has the column ``vector`` of integers. Each task adds up its own rows and sends one sum
    for each pair of dimensions; the integers are moved by a constant first, which changes no scatter.
    """
    names = [f"p{i}" for i in range(PARTS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(dimensions, object)
        products = np.zeros((dimensions, dimensions), object)
        for batch in batches:
            x = _matrix(batch.column(0), dimensions) - SHIFT
            n += len(x)
            for begin in range(0, len(x), CHUNK):
                part = x[begin : begin + CHUNK]
                # Halves, so that sums of 64-bit numbers cannot overflow.
                sums += (part >> 32).sum(axis=0).astype(object) << 32
                sums += (part & 0xFFFFFFFF).sum(axis=0).astype(object)
            products += np.array(product_sum(x), object).reshape(dimensions, dimensions)
        if n:
            upper = [(i, j, products[i, j]) for i in range(dimensions) for j in range(i, dimensions)]
            rows = [(-1, -1, n), *((-1, i, s) for i, s in enumerate(sums)), *upper]
            split = list(zip(*(_parts(int(v)) for _, _, v in rows)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], pa.int32()) for k in (0, 1)]
                + [pa.array(p, pa.int64()) for p in split],
                ["i", "j", *names],
            )

    schema = "i int, j int, " + ", ".join(f"{name} long" for name in names)
    found = vectors.select("vector").mapInArrow(run, schema).groupBy("i", "j")
    n, sums = 0, [0] * dimensions
    products = [[0] * dimensions for _ in range(dimensions)]
    for r in found.agg(*(F.sum(name).alias(name) for name in names)).collect():
        value = sum(r[name] << (PART_BITS * k) for k, name in enumerate(names))
        if r["i"] >= 0:
            products[r["i"]][r["j"]] = products[r["j"]][r["i"]] = value
        elif r["j"] >= 0:
            sums[r["j"]] = value
        else:
            n = value
    exact = [
        [n * products[i][j] - sums[i] * sums[j] for j in range(dimensions)] for i in range(dimensions)
    ]
    return n, [s + n * SHIFT for s in sums], exact


# --- the characteristic polynomial ---------------------------------------------------------------


def _is_prime(p: int) -> bool:
    """Miller and Rabin's test; these bases decide all numbers of 32 bits."""
    odd, twos = p - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, p)
        if x in (1, p - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % p
            if x == p - 1:
                break
        else:
            return False
    return True


def primes(bits: int) -> list[int]:
    """Primes below 2 ** 31, from the largest down, whose product has more than ``bits`` bits."""
    found, have, p = [], 0.0, (1 << 31) - 1
    while have <= bits + 1:
        if _is_prime(p):
            found.append(p)
            have += math.log2(p)
        p -= 2
    return found


def polynomial_modulo(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients, constant first, of det(x - matrix) modulo a prime below 2 ** 31."""
    h = matrix.copy()
    size = len(h)
    for k in range(1, size - 1):
        below = np.flatnonzero(h[k:, k - 1])
        if not len(below):
            continue
        pivot = k + int(below[0])
        if pivot != k:
            h[[k, pivot]] = h[[pivot, k]]
            h[:, [k, pivot]] = h[:, [pivot, k]]
        factors = h[k + 1 :, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        # Rows lose multiples of row k, and column k gains the same multiples of columns: similar matrices.
        h[k + 1 :] = (h[k + 1 :] - factors[:, None] * h[k] % p) % p
        h[:, k] = (h[:, k] + (h[:, k + 1 :] * factors % p).sum(axis=1)) % p
    found = [np.array([1], np.int64)]
    for k in range(size):
        own = np.zeros(k + 2, np.int64)
        own[1:] = found[k]
        own[:-1] = (own[:-1] - h[k, k] * found[k] % p) % p
        run = 1
        for i in range(k - 1, -1, -1):
            run = run * int(h[i + 1, i]) % p
            if not run:
                break
            factor = int(h[i, k]) * run % p
            own[: i + 1] = (own[: i + 1] - factor * found[i] % p) % p
        found.append(own)
    return found[size].tolist()


def coefficient_bits(matrix: list[list[int]]) -> int:
    """Bits that hold every coefficient of the polynomial of a matrix without negative eigenvalues.

    With trace t and d dimensions, the k-th one is at most C(d, k) (t / d) ** k.
    """
    d = len(matrix)
    trace = sum(matrix[i][i] for i in range(d))
    return d + d * max(0, -(-trace // d)).bit_length() + 2


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Integer coefficients, constant first, of det(x - matrix); each prime is a row of a Spark job."""
    moduli = primes(coefficient_bits(matrix))
    shared = spark.sparkContext.broadcast(matrix)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exact = np.array(shared.value, object)
        for batch in batches:
            for p in batch.column(0).to_pylist():
                own = polynomial_modulo((exact % p).astype(np.int64), p)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p], pa.int64()), pa.array([own], pa.list_(pa.int64()))], ["p", "rest"]
                )

    tasks = min(len(moduli), 4 * spark.sparkContext.defaultParallelism)
    rows = spark.createDataFrame([(p,) for p in moduli], "p long").repartition(tasks)
    found = {r["p"]: r["rest"] for r in rows.mapInArrow(run, "p long, rest array<long>").collect()}
    return remainder_join([found[p] for p in moduli], moduli)


def remainder_join(rests: list[list[int]], moduli: list[int]) -> list[int]:
    """Numbers, positive or negative, from their rests modulo each of ``moduli``."""
    whole = math.prod(moduli)
    parts = [whole // p for p in moduli]
    factors = [part * pow(part % p, -1, p) for part, p in zip(parts, moduli)]
    found = []
    for own in zip(*rests):
        value = sum(r * f for r, f in zip(own, factors)) % whole
        found.append(value - whole if value > whole // 2 else value)
    return found


# --- its roots -----------------------------------------------------------------------------------


def roots_above(polynomial: list[int], place: int) -> int:
    """Number of roots above an integer, if all roots are real: sign changes of p(x + place)."""
    own = list(polynomial)
    if place:
        for end in range(len(own) - 1):
            for i in range(len(own) - 2, end - 1, -1):
                own[i] += place * own[i + 1]
    signs = [c > 0 for c in own if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def largest_roots(polynomial: list[int], keep: int, bits: int = ROOT_BITS) -> list[tuple[int, int, int]]:
    """(numerator, bits behind the point, how often) of the largest positive roots, falling.

    All roots must be real and none negative. Roots closer together than ``bits`` behind the point
    count as one of several. At least ``keep`` roots, counted that often, are found if there are so many.
    """
    zeros = next(i for i, c in enumerate(polynomial) if c)
    own = polynomial[zeros:]
    degree = len(own) - 1
    if not degree:
        return []
    bound = -own[-2] // own[-1] + 1  # above the sum of all roots
    found: list[tuple[int, int, int]] = []
    # Intervals (low, high] at a scale, with the number of roots above each end.
    waiting = [(0, bound, 0, degree, 0)]
    scaled = {0: own}

    def at_scale(scale: int) -> list[int]:
        """The polynomial whose roots are 2 ** scale times as large."""
        if scale not in scaled:
            scaled[scale] = [c << (scale * (degree - i)) for i, c in enumerate(own)]
        return scaled[scale]

    kept = 0
    while waiting and kept < keep:
        low, high, scale, above_low, above_high = waiting.pop()
        inside = above_low - above_high
        if inside == 1:
            found.append((*_narrow(own, low, high, scale, bits), 1))
            kept += 1
            continue
        if scale >= bits and high - low <= 1:
            found.append((high, scale, inside))
            kept += inside
            continue
        if high - low <= 1:
            step = min(8, max(1, bits - scale))
            low, high, scale = low << step, high << step, scale + step
        middle = (low + high) // 2
        above = roots_above(at_scale(scale), middle)
        if above_low > above:
            waiting.append((low, middle, scale, above_low, above))
        if above > above_high:
            waiting.append((middle, high, scale, above, above_high))
    return found


def _narrow(own: list[int], low: int, high: int, scale: int, bits: int) -> tuple[int, int]:
    """The only root in (low, high], to ``bits`` behind the point: Newton steps kept in by signs."""
    degree = len(own) - 1

    def value(place: int, scale: int) -> int:
        total = own[-1]
        for i, c in enumerate(reversed(own[:-1]), 1):
            total = total * place + (c << (scale * i))
        return total

    def slope(place: int, scale: int) -> int:
        total = degree * own[-1]
        for i in range(degree - 1, 0, -1):
            total = total * place + ((i * own[i]) << (scale * (degree - i)))
        return total

    sign_high = value(high, scale)
    if sign_high == 0:
        return (high << (bits - scale), bits) if scale <= bits else (high >> (scale - bits), bits)
    rising = sign_high > 0

    def reached(level: int) -> bool:
        return level == 0 or (level > 0) == rising

    while scale < bits or high - low > 1:
        if high - low <= 4 and scale < bits:
            # More digits: twice as many are right after a Newton step near the root.
            step = min(max(8, scale), bits - scale)
            low, high, scale = low << step, high << step, scale + step
        middle = (low + high) // 2
        level, steep = value(middle, scale), slope(middle, scale)
        if steep:
            guess = middle - level // steep
            # Closest to the guess first; each look shortens the interval whatever the guess was.
            for place in (guess - 2, guess + 2):
                if low < place < high:
                    if reached(value(place, scale)):
                        high = place
                    else:
                        low = place
        if low < middle < high:
            if reached(level):
                high = middle
            else:
                low = middle
    return high, scale


# --- its null spaces -----------------------------------------------------------------------------


def null_space(matrix: list[list[int]], root: tuple[int, int, int], work: int = WORK_BITS) -> list[list[float]]:
    """Unit vectors that span the null space of the matrix less a root, one for each time it counts.

    Inverse iteration in fixed point: the matrix, relative to its trace, has ``work`` bits behind the
    point. It is reduced once, with the largest pivot of each column, and solved for as many different
    starts as the root counts, made orthogonal to each other.
    """
    place, scale, times = root
    size = len(matrix)
    trace = sum(matrix[i][i] for i in range(size))
    one = 1 << work
    rows = [[(v << work) // trace for v in row] for row in matrix]
    shift = (place << work) // (trace << scale)
    for i in range(size):
        rows[i][i] -= shift
    order = list(range(size))
    lower: list[list[int]] = []
    for k in range(size):
        best = max(range(k, size), key=lambda i: abs(rows[i][k]))
        rows[k], rows[best] = rows[best], rows[k]
        order[k], order[best] = order[best], order[k]
        if k < len(lower):
            lower[k], lower[best] = lower[best], lower[k]
        else:
            lower += [[] for _ in range(size - len(lower))]
            lower[k], lower[best] = lower[best], lower[k]
        pivot = rows[k][k] or 1  # a pivot of the null space: the least step there is
        rows[k][k] = pivot
        top = rows[k]
        for i in range(k + 1, size):
            factor = (rows[i][k] << work) // pivot
            lower[i].append(factor)
            if factor:
                row = rows[i]
                for j in range(k + 1, size):
                    row[j] -= factor * top[j] >> work
            rows[i][k] = 0

    def solve(right: list[int]) -> list[int]:
        own = [right[i] for i in order]
        for i in range(size):
            for j, factor in enumerate(lower[i]):
                own[i] -= factor * own[j] >> work
        for i in range(size - 1, -1, -1):
            total = own[i]
            for j in range(i + 1, size):
                total -= rows[i][j] * own[j] >> work
            own[i] = (total << work) // rows[i][i]
        return own

    def unit(vector: list[int]) -> list[int]:
        norm = math.isqrt(sum(v * v for v in vector))
        return [(v << work) // norm for v in vector]

    found: list[list[int]] = []
    for t in range(times):
        # No start is orthogonal to the null space but by chance; the second step mends such a chance.
        vector = [one + (((i + 1) * (2 * t + 3) * 2654435761) % 1000) * (one >> 9) * (-1) ** (i * t) for i in range(size)]
        for _ in range(3):
            vector = unit(vector)
            for _ in range(2):
                for other in found:
                    share = sum(a * b for a, b in zip(vector, other)) >> work
                    vector = [a - (share * b >> work) for a, b in zip(vector, other)]
            vector = solve(unit(vector))
        vector = unit(vector)
        for _ in range(2):
            for other in found:
                share = sum(a * b for a, b in zip(vector, other)) >> work
                vector = [a - (share * b >> work) for a, b in zip(vector, other)]
            vector = unit(vector)
        found.append(vector)
    return [[v / one for v in vector] for vector in found]


def _components(spark: SparkSession, matrix: list[list[int]], roots: list[tuple[int, int, int]]) -> np.ndarray:
    """Null-space vectors of all roots, in their order; each root is a row of a Spark job."""
    shared = spark.sparkContext.broadcast((matrix, roots))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exact, own = shared.value
        for batch in batches:
            for at in batch.column(0).to_pylist():
                found = null_space(exact, own[at])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at], pa.int32()), pa.array([found], pa.list_(pa.list_(pa.float64())))],
                    ["at", "vectors"],
                )

    rows = spark.createDataFrame([(i,) for i in range(len(roots))], "at int").repartition(len(roots))
    found = {r["at"]: r["vectors"] for r in rows.mapInArrow(run, "at int, vectors array<array<double>>").collect()}
    return np.array([v for i in range(len(roots)) for v in found[i]], np.float64)


# --- fit and transform ---------------------------------------------------------------------------


def fit(vectors: DataFrame, keep: int = KEEP) -> Whitening | None:
    """Components of the column ``vector`` of integers; None if there is no row.

    A component of eigenvalue zero cannot be whitened and is left out, so there are at most as many as
    the rank. Which of equal eigenvalues comes first is arbitrary but the same for all rows.
    """
    spark = vectors.sparkSession
    first = vectors.select(F.size("vector")).first()
    if first is None:
        return None
    dimensions = first[0]
    if dimensions > MOST_DIMENSIONS:
        raise ValueError(f"{dimensions} dimensions; the limit is {MOST_DIMENSIONS}")
    n, sums, matrix = scatter(vectors, dimensions)
    trace = sum(matrix[i][i] for i in range(dimensions))
    empty = np.zeros(0), np.zeros((0, dimensions))
    if not trace:
        return Whitening(n, sums, 0.0, *empty, [0] * dimensions + [1])
    polynomial = characteristic_polynomial(spark, matrix)
    roots = largest_roots(polynomial, keep)
    components = _components(spark, matrix, roots)[:keep]
    # The matrix is n * n times the covariance.
    exact = [place / (n * n << scale) for place, scale, times in roots for _ in range(times)][:keep]
    return Whitening(n, sums, trace / (n * n), np.array(exact), components, polynomial)


def project(model: Whitening, x: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Exact sums of (n x - S) ** 2, and whitened components, of rows of integers."""
    n, offset = model.n, np.array(model.sums, object)
    most = n * int(np.abs(x).max(initial=0)) + int(np.abs(offset).max(initial=0))
    if most.bit_length() <= 62:
        moved = n * x - offset.astype(np.int64)
    else:
        moved = n * x.astype(object) - offset
    if len(model.sums) * most * most < 1 << 63:
        squares = (moved * moved).sum(axis=1).tolist()
    else:
        squares = [int(s) for s in (moved.astype(object) ** 2).sum(axis=1)]
    weights = model.vectors / np.sqrt(model.eigenvalues)[:, None]
    return squares, (moved.astype(np.float64) / n) @ weights.T


def transform(vectors: DataFrame, model: Whitening) -> DataFrame:
    """``vectors`` (with ``vector``, integers) with ``deviation`` and ``whitened``, an array.

    A deviation beyond 64 bits stops the query.
    """
    dimensions = len(model.sums)
    shared = vectors.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<deviation: long, whitened: array<double>>")
    def run(column: pa.Array) -> pa.Array:
        squares, whitened = project(shared.value, _matrix(column, dimensions))
        offsets = np.arange(len(squares) + 1, dtype=np.int32) * whitened.shape[1]
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(whitened.ravel()))
        return pa.StructArray.from_arrays([pa.array(squares, pa.int64()), lists], ["deviation", "whitened"])

    found = vectors.withColumn("_found", run("vector"))
    return found.select(*vectors.columns, "_found.deviation", "_found.whitened")


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """Largest entry of the covariance of all whitened rows, less the identity; measured on the rows."""
    size = len(model.eigenvalues)
    dimensions = len(model.sums)
    shared = vectors.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, products = np.zeros(size), np.zeros((size, size))
        for batch in batches:
            _, own = project(shared.value, _matrix(batch.column(0), dimensions))
            total += own.sum(axis=0)
            products += own.T @ own
        rows = np.concatenate([total, products.ravel()])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(rows)), pa.int32()), pa.array(rows)], ["place", "value"]
        )

    summed = vectors.select("vector").mapInArrow(run, "place int, value double").groupBy("place")
    found = np.zeros(size + size * size)
    for place, value in summed.agg(F.sum("value")).collect():
        found[place] = value
    mean = found[:size] / model.n
    # The rows are centred before they are multiplied; what is left of the mean is rounding.
    covariance = found[size:].reshape(size, size) / model.n - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(size)).max()) if size else 0.0


def whiten_table(table: DataFrame, column: str = "embedding", keep: int = KEEP) -> DataFrame:
    """Rows (vec_id, component, n, deviation, whitened, explained, identity_error) of all usable vectors.

    Defined results: a vector that is NULL, or holds a NULL, NaN or infinite component, is dropped;
    repeated rows, and NULL ``vec_id``, count and come back like others; an empty table, or vectors that
    are all equal, have no component and give no rows, and there are at most as many components as the
    covariance has positive eigenvalues; vectors of different lengths stop the query; other columns are
    not read.
    """
    spark = table.sparkSession
    vectors = table.where(usable(column)).select("vec_id", integers(column).alias("vector"))
    model = fit(vectors, keep)
    kind = table.schema["vec_id"].dataType
    if model is None or not len(model.eigenvalues):
        schema = T.StructType([T.StructField("vec_id", kind)])
        nothing = spark.createDataFrame([], schema)
        rest = "component int, n long, deviation long, whitened double, explained double, identity_error double"
        return nothing.select("vec_id", *(F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in rest.split(", ")))
    error = identity_error(vectors, model)
    shares = F.array(*(F.lit(float(e / model.trace)) for e in model.eigenvalues))
    placed = transform(vectors, model).select(
        "vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")
    )
    return placed.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, "at").alias("explained"),
        F.lit(error).alias("identity_error"),
    )
