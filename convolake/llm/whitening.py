"""Operator 12: whitening of embeddings by the exact characteristic polynomial of their scatter.

An entry c becomes the integer y = floor(1024 * c); adding a constant to y (as in x = y + 100000) changes no result, so sums
are taken of y. Tasks add up products of balanced 15-bit digits of y, exactly, as small integer matrices; their sum is the
scatter A = n * sum(y y') - S S', an exact integer matrix n * n times the covariance V. Then

1. the characteristic polynomial of A modulo many primes, each by reduction to Hessenberg form (one Spark row per prime),
   and its integer coefficients by Chinese remaindering; as many primes as the bound on the coefficients asks for;
2. isolation of the largest roots: all roots are real, so the sign changes of the coefficients of q(z + a) count the roots
   above a exactly, with multiplicity, and bisection on them parts the roots;
3. one Spark row per root (or per cluster of equal roots): bisection on exact signs to 2**-256 of the root, then inverse
   iteration in 130-digit arithmetic, which finds the null space of A - root.

Only matrices whose size is the square of the dimension reach the driver, however many vectors there are; it is meant for
dimensions up to some hundreds. Each vector is read three times (dimensions, sums, projection) and never shuffled.

Defined results: vectors that are null, empty, or hold a null or non-finite entry are dropped, as are vectors whose length
is not the most frequent one (the smaller of equals); entries beyond 2**53 are cut to that; repeated rows and rows with
equal or null vec_id each keep their rows; components with eigenvalue 0 do not exist, so a constant, single or missing
vector gives no rows; roots that agree to 2**-128 share one eigenspace, of which any orthonormal basis is taken; deviation
is null where it does not fit in a long. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal, localcontext
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from convolake.llm.common import Scratch, table

SCALE = 1024
COMPONENTS = 8
DIGIT = 15
#: Bits to which a root is found, bits below which two roots count as equal, digits of the inverse iteration.
ROOT_BITS, EQUAL_BITS, DIGITS = 256, 128, 130
_LARGEST = 2.0**53


@dataclass
class Whitening:
    """What the fit list says: rows, sums of y, and the components by falling eigenvalue (of the covariance of x)."""

    n: int
    sums: list[int]
    values: list[float]
    components: np.ndarray
    explained: list[float]


# --- exact scatter --------------------------------------------------------------------------------------------------------
def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """vec_id and y (array of long) of the vectors that count."""
    c = F.col(column)
    bad = F.exists(c, lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == float("inf")))
    y = F.transform(c, lambda v: F.floor(F.greatest(F.lit(-_LARGEST), F.least(F.lit(_LARGEST), v.cast("double") * SCALE))))
    return vectors.filter(c.isNotNull() & (F.size(c) > 0) & ~bad).select("vec_id", y.alias("y"))


def commonest_length(vectors: DataFrame) -> int:
    """The most frequent number of entries, the smaller of equals; 0 without vectors."""
    found = vectors.groupBy(F.size("y").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return found.d if found else 0


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.int64, copy=False)


def digits_of(y: np.ndarray) -> list[np.ndarray]:
    """Balanced digits: y is the sum of digit k times 2 ** (DIGIT * k), each at most 2 ** (DIGIT - 1) in size."""
    half, out = 1 << (DIGIT - 1), []
    while y.any():
        low = ((y + half) & ((1 << DIGIT) - 1)) - half
        out.append(low.astype(np.float64))
        y = (y - low) >> DIGIT
    return out


def _sums(dim: int):
    """Of each task: rows, sums of digits and of products of digits, as rows (what, shift, i, values)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, first, second = 0, {}, {}
        for batch in batches:
            parts = digits_of(_matrix(batch.column("y"), dim))
            rows += batch.num_rows
            for a, u in enumerate(parts):
                first[a] = first.get(a, 0) + u.sum(0).astype(np.int64)
                for b, v in enumerate(parts):  # products of 2**28 at most: exact in doubles for 2**25 rows a batch
                    second[a + b] = second.get(a + b, 0) + (u.T @ v).astype(np.int64)
        if rows:
            out = [("n", 0, 0, [rows])] + [("s", a, 0, v) for a, v in first.items()] + [("p", a, i, m[i]) for a, m in second.items() for i in range(dim)]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out]), *(pa.array([x[k] for x in out], pa.int32()) for k in (1, 2)), pa.array([x[3] for x in out], pa.list_(pa.int64()))], ["what", "shift", "i", "v"])

    return run


def scatter(vectors: DataFrame, dim: int) -> tuple[int, list[int], list[list[int]]]:
    """n, S and A = n * sum(y y') - S S' of all vectors (vec_id, y of length dim), exact."""
    parts = vectors.select("y").mapInArrow(_sums(dim), "what string, shift int, i int, v array<bigint>")
    each = parts.select("what", "shift", "i", F.posexplode("v").alias("j", "v")).filter("what <> 'p' OR j >= i")
    found = each.groupBy("what", "shift", "i", "j").agg(F.sum(F.col("v").cast("decimal(20,0)")).alias("v")).collect()  # dim * dim rows a digit
    n, sums, products = 0, [0] * dim, [[0] * dim for _ in range(dim)]
    for what, shift, i, j, v in found:
        v = int(v) << (DIGIT * shift)
        if what == "n":
            n += v
        elif what == "s":
            sums[j] += v
        else:
            products[i][j] += v
    a = [[0] * dim for _ in range(dim)]
    for i in range(dim):
        for j in range(i, dim):
            a[i][j] = a[j][i] = n * products[i][j] - sums[i] * sums[j]
    return n, sums, a


# --- characteristic polynomial ----------------------------------------------------------------------------------------------
def coefficient_bits(a: list[list[int]]) -> int:
    """A bound on the bits of the coefficients of det(z - A), A positive semidefinite: sums of products of k eigenvalues are
    at most C(d, k) * (trace / d) ** k."""
    d, trace = len(a), sum(a[i][i] for i in range(len(a)))
    mean = max(0.0, math.log2(trace) - math.log2(d)) if trace > 0 else 0.0
    choose = lambda k: (math.lgamma(d + 1) - math.lgamma(k + 1) - math.lgamma(d - k + 1)) / math.log(2)
    return int(max(choose(k) + k * mean for k in range(d + 1))) + 8


def _is_prime(n: int) -> bool:
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):  # enough below 3,215,031,751
        x = pow(base, odd, n)
        if x not in (1, n - 1) and not any((x := x * x % n) == n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_for(bits: int) -> list[int]:
    """The largest primes below 2**31 whose product has more than so many bits, sign included."""
    out, have, p = [], 0.0, 2**31 - 1
    while have <= bits + 1:
        if _is_prime(p):
            out.append(p)
            have += math.log2(p)
        p -= 2
    return out


def charpoly_mod(a: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(z - a) modulo p, from the highest on, by way of a similar Hessenberg matrix."""
    h, d = a % p, len(a)
    for m in range(1, d - 1):
        below = np.flatnonzero(h[m:, m - 1])
        if not len(below):
            continue
        if (i := m + int(below[0])) != m:
            h[[m, i]] = h[[i, m]]
            h[:, [m, i]] = h[:, [i, m]]
        u = h[m + 1 :, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        h[m + 1 :, m - 1 :] = (h[m + 1 :, m - 1 :] - u[:, None] * h[m, m - 1 :] % p) % p
        h[:, m] = (h[:, m] + (h[:, m + 1 :] * u % p).sum(1)) % p
    polys = np.zeros((d + 1, d + 1), np.int64)  # row k: that of the leading k x k block, from z ** 0 on
    polys[0, 0] = 1
    for k in range(d):
        weight = np.zeros(k + 1, np.int64)  # of earlier rows: entry above times the subdiagonal product between
        below = 1
        for i in range(k, -1, -1):
            weight[i] = int(h[i, k]) * below % p
            below = below * int(h[i, i - 1]) % p if i else 0
        polys[k + 1, 1:] = polys[k, :-1]
        polys[k + 1] = (polys[k + 1] - (weight[:, None] * polys[: k + 1] % p).sum(0)) % p
    return polys[d, ::-1]


def remaindered(residues: dict[int, list[int]]) -> list[int]:
    """The integers, least in size, with these residues."""
    modulus, value = 1, None
    for p, r in residues.items():
        r = np.array(r, dtype=object)
        if value is None:
            value = r
        else:
            value = value + modulus * ((r - value) * pow(modulus, -1, p) % p)
        modulus *= p
    return [int(v) - modulus if 2 * v > modulus else int(v) for v in value]


def characteristic_polynomial(spark: SparkSession, a: list[list[int]]) -> list[int]:
    """Coefficients of det(z - A), from the highest on; each prime's part is a row of a Spark job."""
    primes = primes_for(coefficient_bits(a))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole = np.array(a, dtype=object)
        for batch in batches:
            yield pd.DataFrame({"p": batch.p, "c": [charpoly_mod((whole % p).astype(np.int64), p).tolist() for p in map(int, batch.p)]})

    rows = spark.createDataFrame([(p,) for p in primes], "p long").repartition(min(len(primes), max(1, spark.sparkContext.defaultParallelism)))
    return remaindered({r.p: r.c for r in rows.mapInPandas(run, "p long, c array<bigint>").collect()})


# --- roots ------------------------------------------------------------------------------------------------------------------
def roots_above(poly: list[int], num: int, bits: int) -> int:
    """How many roots of a polynomial with real roots alone (multiplicity counted) exceed num / 2**bits, num >= 0.

    That is the number of sign changes in the coefficients of q(z + a); with a > 0 those of q(a * (z + 1)) have the same
    signs, and shifting by one is a matter of running sums."""
    if num == 0:
        shifted = np.array(poly, dtype=object)
    else:
        d = len(poly) - 1
        shifted = np.array([c * num ** (d - k) << (bits * k) for k, c in enumerate(poly)], dtype=object)  # of q(a * z), scaled
        for k in range(d, 0, -1):
            shifted[: k + 1] = np.add.accumulate(shifted[: k + 1])
    signs = [c > 0 for c in shifted if c != 0]
    return sum(x != y for x, y in zip(signs, signs[1:], strict=False))


def isolated(poly: list[int], wanted: int) -> list[tuple[int, int, int, int]]:
    """Intervals (low, high, bits, roots) in falling order, each (low, high] / 2**bits with one root, or several that agree
    to EQUAL_BITS, until so many roots are in."""
    bits, top = 0, 1 << max(1, abs(poly[1]).bit_length())  # the trace bounds all roots
    todo, out, got = [(0, top, roots_above(poly, 0, 0), 0, 0)], [], 0
    while todo and got < wanted:
        low, high, over_low, over_high, bits = todo.pop()
        inside = over_low - over_high
        if inside == 0:
            continue
        close = low > 0 and (high - low) << EQUAL_BITS <= low
        if (inside == 1 and low > 0) or close:
            out.append((low, high, bits, inside))
            got += inside
            continue
        if high - low == 1:
            low, high, bits = low << 16, high << 16, bits + 16
        mid = (low + high) // 2
        over_mid = roots_above(poly, mid, bits)
        todo += [(low, mid, over_low, over_mid, bits), (mid, high, over_mid, over_high, bits)]
    return out


def refined(poly: list[int], low: int, high: int, bits: int, roots: int) -> Fraction:
    """The root in (low, high] / 2**bits to ROOT_BITS; of several equal ones the interval's middle."""

    def sign(num: int) -> int:
        value, scale = 0, 0
        for c in poly:  # Horner's rule on integers: value is 2 ** (bits * k) times the polynomial
            value = value * num + (c << scale)
            scale += bits
        return (value > 0) - (value < 0)

    if roots > 1:
        while (high - low) << ROOT_BITS > low:
            if high - low == 1:
                low, high, bits = low << 32, high << 32, bits + 32
            mid = (low + high) // 2
            above = roots_above(poly, mid, bits)
            over_high = roots_above(poly, high, bits)
            if above - over_high == roots:
                low = mid
            elif above == over_high:
                high = mid
            else:
                break  # they part only here
        return Fraction(low + high, 2 << bits)
    at_high = sign(high)
    if at_high == 0:
        return Fraction(high, 1 << bits)
    while (high - low) << ROOT_BITS > low:
        if high - low == 1:
            low, high, bits = low << 32, high << 32, bits + 32
        mid = (low + high) // 2
        at_mid = sign(mid)
        if at_mid == 0:
            return Fraction(mid, 1 << bits)
        low, high = (low, mid) if at_mid == at_high else (mid, high)
    return Fraction(low + high, 2 << bits)


# --- components -------------------------------------------------------------------------------------------------------------
def null_space(a: list[list[int]], root: Fraction, size: int) -> list[list[float]]:
    """So many orthonormal vectors that A - root maps to nearly nothing, by inverse iteration."""
    d = len(a)
    with localcontext() as context:
        context.prec = DIGITS
        shift = Decimal(root.numerator) / Decimal(root.denominator)
        start = np.random.Generator(np.random.PCG64(d)).integers(-999, 1000, (d, size))
        m = np.array([[Decimal(v) for v in [*row, *start[i].tolist()]] for i, row in enumerate(a)], dtype=object)
        for i in range(d):
            m[i, i] -= shift
        tiny = shift.scaleb(-DIGITS) if shift else Decimal(1).scaleb(-DIGITS)
        lower, order = np.zeros((d, d), dtype=object), np.arange(d)
        for k in range(d):
            best = k + max(range(d - k), key=lambda i: abs(m[k + i, k]))  # noqa: B023
            if best != k:
                m[[k, best]], lower[[k, best]], order[[k, best]] = m[[best, k]], lower[[best, k]], order[[best, k]]
            if m[k, k] == 0:
                m[k, k] = tiny
            factor = m[k + 1 :, k] / m[k, k]
            lower[k + 1 :, k] = factor
            m[k + 1 :, k:] -= factor[:, None] * m[k, k:]
        upper, x = m[:, :d], m[:, d:]
        for turn in range(3):
            if turn:
                x = x[order]
                for k in range(d):
                    x[k + 1 :] -= lower[k + 1 :, k][:, None] * x[k]
            for k in range(d - 1, -1, -1):
                x[k] /= upper[k, k]
                x[:k] -= upper[:k, k][:, None] * x[k]
            for k in range(size):  # orthonormal again
                for j in range(k):
                    x[:, k] -= x[:, j] * (x[:, j] * x[:, k]).sum()
                x[:, k] /= (x[:, k] * x[:, k]).sum().sqrt()
        return [[float(v) for v in x[:, k]] for k in range(size)]


def fit_whitening(vectors: DataFrame, dim: int, components: int = COMPONENTS) -> Whitening:
    """The first components of vectors (vec_id, y of length dim)."""
    spark = vectors.sparkSession
    n, sums, a = scatter(vectors, dim)
    trace = sum(a[i][i] for i in range(dim))
    if n == 0 or trace == 0:
        return Whitening(n, sums, [], np.zeros((0, dim)), [])
    poly = characteristic_polynomial(spark, a)
    while poly[-1] == 0:
        poly.pop()  # roots at 0
    found = isolated(poly, min(components, len(poly) - 1))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for k in batch.k:
                low, high, bits, roots = found[k]
                root = refined(poly, low, high, bits, roots)
                for at, v in enumerate(null_space(a, root, roots)):
                    yield pd.DataFrame({"k": [k], "at": [at], "value": [float(root / (n * n))], "share": [float(root / trace)], "v": [v]})

    rows = spark.range(len(found)).withColumnRenamed("id", "k").repartition(len(found)).mapInPandas(run, "k long, at int, value double, share double, v array<double>").collect()
    rows = sorted(rows, key=lambda r: (r.k, r.at))[:components]
    return Whitening(n, sums, [r.value for r in rows], np.array([r.v for r in rows]), [r.share for r in rows])


def deviations(y: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum of (n * y - S) ** 2 of each row, exact; None beyond a long."""
    largest = n * int(np.abs(y).max(initial=0)) + max(map(abs, sums), default=0)
    if largest * largest * y.shape[1] < 2**63:
        return ((y * n - np.array(sums, np.int64)) ** 2).sum(1).tolist()
    exact = ((y.astype(object) * n - np.array(sums, dtype=object)) ** 2).sum(1)
    return [int(v) if v < 2**63 else None for v in exact]


def whitened(vectors: DataFrame, fit: Whitening) -> DataFrame:
    """vec_id, deviation and whitened (one number for each component) of vectors (vec_id, y)."""
    kind, dim = dict(vectors.dtypes)["vec_id"], len(fit.sums)
    mean = np.array([float(Fraction(s, fit.n)) for s in fit.sums]) if fit.n else np.zeros(dim)
    project = (fit.components / np.sqrt(np.array(fit.values))[:, None]).T

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = _matrix(batch.column("y"), dim)
            z = (y - mean) @ project
            offsets = pa.array(np.arange(len(z) + 1, dtype=np.int32) * z.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(deviations(y, fit.n, fit.sums), pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(z.ravel()))], ["vec_id", "deviation", "whitened"])

    return vectors.select("vec_id", "y").mapInArrow(run, f"vec_id {kind}, deviation long, whitened array<double>")


def identity_error(rows: DataFrame, size: int) -> float:
    """The largest absolute entry of the covariance of whitened less the identity; 0 without rows."""
    z = [F.col("whitened")[k] for k in range(size)]
    mean = rows.agg(*[F.avg(x).alias(f"m{k}") for k, x in enumerate(z)]).first()
    if mean is None or mean[0] is None:
        return 0.0
    centred = [x - F.lit(m) for x, m in zip(z, mean, strict=True)]
    entry = lambda i, j: F.abs(F.avg(centred[i] * centred[j]) - float(i == j))
    pairs: list[Column] = [entry(i, j).alias(f"e{i}_{j}") for i in range(size) for j in range(i, size)]
    return max(rows.agg(*pairs).first())


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = usable(table(spark, sf_dir, "embeddings"))
    dim = commonest_length(vectors)
    vectors = vectors.filter(F.size("y") == dim)
    fit = fit_whitening(vectors, dim)
    size = len(fit.values)
    rows = Scratch(spark).written(whitened(vectors, fit), "whitened")
    error = identity_error(rows, size) if size else 0.0
    d = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    share = F.element_at(F.array(*[F.lit(x) for x in fit.explained or [0.0]]), F.col("at") + 1)
    return d.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(fit.n).cast("long").alias("n"), "deviation", "whitened", share.alias("explained"), F.lit(float(error)).alias("identity_error"))
