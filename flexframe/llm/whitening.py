"""Embedding whitening by the exact characteristic polynomial of the integer scatter matrix.

Vectors become whole numbers, so the scatter matrix ``A = n X'X - S S'``
(n squared times the covariance) is an integer matrix, summed exactly.

1. **Scatter.** Each task adds up its own vectors; Spark sums the entries.
2. **Polynomial.** Primes are dealt over tasks; a task brings ``A`` modulo its
   prime to Hessenberg form and reads off the characteristic polynomial.
   Chinese remaindering gives the integer coefficients; their size is bounded
   beforehand by the trace (Maclaurin), so the number of primes is proven.
3. **Roots.** All roots are real, so the sign changes of the coefficients of
   ``p(x + t)`` count the roots above ``t`` exactly (Descartes). Bisection on
   that count isolates the greatest roots; safeguarded Newton steps in integers
   narrow each to ``BITS`` bits. Roots that no interval of that width separates
   are one root of that multiplicity.
4. **Components.** Tasks solve with ``A - root I`` in ``DIGITS`` decimal digits
   (inverse iteration); several vectors of one root are made orthogonal.
5. **Projection.** One pass over the vectors.

What the driver holds depends on the length d of the vectors alone: d * d
integers, and d coefficients of about 1.5 d words. The work of steps 2 to 4
grows with the fourth power of d and not with the rows.

Defined results: vectors that are null or hold null or non-finite entries are
dropped; rows with a null id stay, with a null id; repeated rows each count;
vectors of one length form a fit list of their own, empty ones none; a
component needs a positive eigenvalue, so constant dimensions, or a single
vector, give fewer components or no rows; an empty table gives an empty
result; equal eigenvalues get any orthonormal components of their space; other
columns are ignored. Entries whose whole number doesn't fit a long, and sums of
more than 38 digits, raise.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal, localcontext
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import staged

SCALE, SHIFT = 1024, 100000
COMPONENTS = 8
#: Significant bits of a root, and digits that inverse iteration works with.
BITS, DIGITS = 160, 90
STEPS = 3


@dataclass
class Model:
    """What whitens vectors of one length: exact sums, eigenvalues of the scatter matrix, unit components."""

    dim: int
    n: int
    sums: list[int]
    eigenvalues: list[Fraction]
    trace: int
    components: np.ndarray

    @property
    def explained(self) -> list[float]:
        return [float(e / self.trace) for e in self.eigenvalues]


def usable(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id`` and ``v`` (array of doubles) of the vectors that take part."""
    vector = df[vector_col]
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return df.where(vector.isNotNull() & (F.size(vector) > 0) & ~bad).select(
        df[id_col].cast("long").alias("vec_id"), vector.cast("array<double>").alias("v"))


def whole(v: np.ndarray) -> np.ndarray:
    """floor(SCALE * v) + SHIFT as int64."""
    scaled = np.floor(v * SCALE)
    if scaled.size and np.abs(scaled).max() >= 2.0 ** 62:
        raise OverflowError("an entry does not fit a long")
    return scaled.astype(np.int64) + SHIFT


def matrices(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix of whole numbers) for each vector length of a batch."""
    sizes = np.asarray(column.value_lengths())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    for d in np.unique(sizes):
        at = np.flatnonzero(sizes == d)
        yield at, whole(flat[(starts[at][:, None] + np.arange(d)[None, :])])


def _product(x: np.ndarray) -> np.ndarray:
    """x'x exactly; in doubles where no sum can reach 2^53, else in Python integers."""
    most = float(np.abs(x).max(initial=0))
    if most * most * len(x) < 2.0 ** 53:
        f = x.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    o = x.astype(object)
    return o.T @ o


def scatter(rows: DataFrame) -> dict[int, tuple[int, list[int], list[list[int]]]]:
    """By vector length: the count, the sums and the matrix of products of ``usable`` vectors, summed by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for b in batches:
            for at, x in matrices(b.column(0)):
                d = x.shape[1]
                own = held.setdefault(d, [0, np.zeros(d, object), np.zeros((d, d), object)])
                y = x - SHIFT  # products don't depend on the origin; these are smaller
                own[0] += len(y)
                own[1] += y.astype(object).sum(axis=0)
                own[2] += _product(y)
        for d, (n, s, m) in held.items():
            i, j = np.triu_indices(d)
            values = [Decimal(int(v)) for v in [n, *s, *m[i, j]]]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(values), d, np.int32)), pa.array(np.concatenate([[-1], np.arange(d), i]).astype(np.int32)),
                pa.array(np.concatenate([[-1], np.full(d, -1), j]).astype(np.int32)), pa.array(values, pa.decimal128(38, 0))],
                names=["dim", "i", "j", "value"])

    parts = rows.select("v").mapInArrow(run, "dim int, i int, j int, value decimal(38,0)")
    out: dict[int, tuple] = {}
    for r in parts.groupBy("dim", "i", "j").agg(F.sum("value").alias("value")).collect():
        d, value = r.dim, int(r.value)
        own = out.setdefault(d, [0, [0] * d, [[0] * d for _ in range(d)]])
        if r.i < 0:
            own[0] = value
        elif r.j < 0:
            own[1][r.i] = value
        else:
            own[2][r.i][r.j] = own[2][r.j][r.i] = value
    return {d: tuple(x) for d, x in sorted(out.items())}


def primes_below(top: int, least_product: int) -> list[int]:
    """Primes downwards from ``top`` whose product exceeds ``least_product``."""
    def prime(p: int) -> bool:
        if any(p % q == 0 for q in (2, 3, 5, 7, 11, 13, 17, 19, 23)):
            return False
        s = ((p - 1) & (1 - p)).bit_length() - 1
        for a in (2, 3, 5, 7):  # decides all numbers below 3.2e9
            x = pow(a, (p - 1) >> s, p)
            if x in (1, p - 1):
                continue
            for _ in range(s - 1):
                x = x * x % p
                if x == p - 1:
                    break
            else:
                return False
        return True

    found, product, p = [], 1, top
    while product <= least_product:
        p -= 1
        if prime(p):
            found.append(p)
            product *= p
    return found


def charpoly_mod(a: np.ndarray, p: int) -> list[int]:
    """Coefficients of det(xI - a) modulo the prime p, highest power first, by Hessenberg reduction."""
    h = a.copy()
    d = len(h)
    for m in range(1, d - 1):
        rows = np.flatnonzero(h[m:, m - 1])
        if not len(rows):
            continue
        i = m + int(rows[0])
        if i != m:
            h[[i, m]] = h[[m, i]]
            h[:, [i, m]] = h[:, [m, i]]
        u = h[m + 1:, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        h[m + 1:] = (h[m + 1:] - u[:, None] * h[m][None, :] % p) % p
        h[:, m] = (h[:, m] + (h[:, m + 1:] * u[None, :] % p).sum(axis=1)) % p
    # polynomials of the leading blocks, lowest power first
    polys = np.zeros((d + 1, d + 1), np.int64)
    polys[0, 0] = 1
    for k in range(1, d + 1):
        polys[k, 1:] = polys[k - 1, :-1]
        weights, below = np.zeros(k, np.int64), 1
        for i in range(k - 1, -1, -1):  # h[i, k-1] times the subdiagonal between i and k-1
            weights[i] = int(h[i, k - 1]) * below % p
            if i:
                below = below * int(h[i, i - 1]) % p
        polys[k] = (polys[k] - (weights[:, None] * polys[:k] % p).sum(axis=0)) % p
    return polys[d, ::-1].tolist()


def characteristic(spark: SparkSession, a: list[list[int]]) -> list[int]:
    """Integer coefficients of det(xI - a), highest power first, for a positive semidefinite a."""
    d, trace = len(a), sum(a[i][i] for i in range(len(a)))
    # the k-th elementary symmetric function of the roots is C(d,k) (trace/d)^k at most, and not negative
    bound = max(math.comb(d, k) * (-(-trace // d)) ** k for k in range(d + 1))
    primes = primes_below(1 << 31, bound)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for p in f["prime"].tolist():
                own = np.array([[x % p for x in row] for row in a], np.int64)
                yield pd.DataFrame({"prime": [p], "coefficients": [charpoly_mod(own, p)]})

    tasks = max(1, min(len(primes), spark.sparkContext.defaultParallelism * 2))
    dealt = spark.createDataFrame([(p,) for p in primes], "prime long").repartition(tasks)
    residues = {r.prime: r.coefficients for r in dealt.mapInPandas(run, "prime long, coefficients array<long>").collect()}
    values, modulus = [0] * (d + 1), 1
    for p in primes:
        inverse = pow(modulus, -1, p)
        for k, r in enumerate(residues[p]):
            r = (p - r) % p if k % 2 else r  # the coefficient without its sign
            values[k] += (r - values[k]) * inverse % p * modulus
        modulus *= p
    return [-v if k % 2 else v for k, v in enumerate(values)]


def roots_above(poly: list[int], t: int) -> int:
    """Number of roots greater than t, with multiplicity, of a polynomial whose roots are all real."""
    shifted = list(poly)
    for end in range(len(poly) - 1, 0, -1):
        for i in range(1, end + 1):
            shifted[i] += t * shifted[i - 1]
    signs = [c > 0 for c in shifted if c]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def scaled(poly: list[int], w: int) -> list[int]:
    """The polynomial whose roots are 2^w times those of ``poly``."""
    return [c << (w * k) for k, c in enumerate(poly)]


def isolate(poly: list[int], want: int) -> list[tuple[int, int, int, int, int]]:
    """Intervals (w, low, high, multiplicity, roots above) that hold the greatest ``want`` positive roots, greatest first.

    A root r of an interval has low < r * 2^w <= high. Intervals hold one root,
    or several that agree in ``BITS`` bits.
    """
    top = -poly[1] + 1
    at_scale = {0: poly}
    todo, found = [(0, 0, top, roots_above(poly, 0), 0)], []
    while todo:
        w, low, high, above_low, above = todo.pop()
        many = above_low - above
        if not many or above >= want:
            continue
        if many == 1 or (high - low == 1 and high.bit_length() > BITS):
            found.append((w, low, high, many, above))
            continue
        if high - low == 1:
            w, low, high = w + 32, low << 32, high << 32
            at_scale.setdefault(w, None)
        if at_scale[w] is None:
            at_scale[w] = scaled(poly, w)
        middle = (low + high) // 2
        c = roots_above(at_scale[w], middle)
        todo += [(w, low, middle, above_low, c), (w, middle, high, c, above)]
    return found


def refine(poly: list[int], w: int, low: int, high: int, many: int, above: int) -> Fraction:
    """The root in an interval of ``isolate``, to ``BITS`` significant bits."""
    if many > 1:
        return Fraction(low + high, 2 << w)
    more = max(0, BITS + 8 - high.bit_length())
    w, low, high = w + more, low << more, high << more
    f = scaled(poly, w)
    d = len(f) - 1
    slope = [c * (d - i) for i, c in enumerate(f[:-1])]

    def value(p: list[int], t: int) -> int:
        out = 0
        for c in p:
            out = out * t + c
        return out

    beyond = -1 if above % 2 else 1  # sign between this root and the next greater one
    t = (low + high) // 2
    while high - low > 1:
        y = value(f, t)
        if y == 0:
            return Fraction(t, 1 << w)
        if (y > 0) == (beyond > 0):
            high = t
        else:
            low = t
        s = value(slope, t)
        step = t - y // s if s else low
        if abs(step - t) <= 1:  # at the root: close the interval from the other side
            step = step + 2 if low == t else step - 2
        t = step if low < step < high else (low + high) // 2
    return Fraction(high, 1 << w)


def null_vectors(a: list[list[int]], root: Fraction, many: int) -> list[list[float]]:
    """``many`` orthonormal eigenvectors of ``a`` at ``root``, by inverse iteration in ``DIGITS`` digits."""
    d = len(a)
    with localcontext() as c:
        c.prec = DIGITS
        at = Decimal(root.numerator) / Decimal(root.denominator)
        lu = [[Decimal(x) for x in row] for row in a]
        for i in range(d):
            lu[i][i] -= at
        order = list(range(d))
        tiny = at * Decimal(10) ** (10 - DIGITS)
        for k in range(d):
            best = max(range(k, d), key=lambda r: abs(lu[r][k]))
            lu[k], lu[best] = lu[best], lu[k]
            order[k], order[best] = order[best], order[k]
            pivot = lu[k]
            if abs(pivot[k]) < tiny:
                pivot[k] = tiny  # the null space itself
            for r in range(k + 1, d):
                row = lu[r]
                if row[k]:
                    m = row[k] = row[k] / pivot[k]
                    for j in range(k + 1, d):
                        row[j] -= m * pivot[j]

        def solve(b: list[Decimal]) -> list[Decimal]:
            x = [b[i] for i in order]
            for i in range(d):
                x[i] -= sum((lu[i][j] * x[j] for j in range(i)), Decimal(0))
            for i in range(d - 1, -1, -1):
                x[i] = (x[i] - sum((lu[i][j] * x[j] for j in range(i + 1, d)), Decimal(0))) / lu[i][i]
            return x

        done: list[list[Decimal]] = []

        def unit(x: list[Decimal]) -> list[Decimal]:
            for v in done:
                dot = sum((p * q for p, q in zip(x, v)), Decimal(0))
                x = [p - dot * q for p, q in zip(x, v)]
            norm = sum((p * p for p in x), Decimal(0)).sqrt()
            return [p / norm for p in x]

        for k in range(many):
            draw = random.Random(k)  # a fixed start with a part in every direction of the space
            x = unit([Decimal(draw.random()) - Decimal("0.5") for _ in range(d)])
            for _ in range(STEPS):
                x = unit(solve(x))
            off = max(abs(sum((a[i][j] * x[j] for j in range(d)), Decimal(0)) - at * x[i]) for i in range(d))
            if off > at * Decimal(10) ** -25:
                raise ArithmeticError("inverse iteration did not reach an eigenvector")
            done.append(x)
        return [[float(p) for p in v] for v in done]


def fit(spark: SparkSession, rows: DataFrame, components: int = COMPONENTS) -> dict[int, Model]:
    """A model for each vector length of ``usable`` rows, over all of them."""
    models = {}
    for d, (n, sums, products) in scatter(rows).items():
        a = [[n * products[i][j] - sums[i] * sums[j] for j in range(d)] for i in range(d)]
        trace = sum(a[i][i] for i in range(d))
        if not trace:
            continue
        poly = characteristic(spark, a)
        intervals = [(k, *map(str, x)) for k, x in enumerate(isolate(poly, components))]

        def run(frames: Iterator[pd.DataFrame], a=a, poly=poly) -> Iterator[pd.DataFrame]:
            for f in frames:
                for k, *interval in f.itertuples(index=False):
                    interval = [int(x) for x in interval]
                    root = refine(poly, *interval)
                    vectors = null_vectors(a, root, min(interval[3], components - interval[4]))
                    yield pd.DataFrame({"k": k, "part": range(len(vectors)), "numerator": str(root.numerator),
                                        "denominator": str(root.denominator), "vector": vectors})

        dealt = spark.createDataFrame(intervals, "k int, w string, low string, high string, many string, above string").repartition(len(intervals))
        told = sorted(dealt.mapInPandas(run, "k int, part int, numerator string, denominator string, vector array<double>").collect())[:components]
        models[d] = Model(d, n, [s + n * SHIFT for s in sums], [Fraction(int(r.numerator), int(r.denominator)) for r in told], trace,
                          np.array([r.vector for r in told]))
    return models


def transform(rows: DataFrame, models: dict[int, Model]) -> DataFrame:
    """vec_id, dim, n, deviation (decimal(38,0)), whitened (array of doubles) of ``usable`` rows that a model fits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, x in matrices(b.column(1)):
                model = models.get(x.shape[1])
                if model is None:
                    continue
                n, sums = model.n, np.array(model.sums, object)
                most = n * int(np.abs(x).max(initial=0)) + max(map(abs, model.sums))
                if most < 1 << 62:
                    z = n * x - sums.astype(np.int64)
                else:
                    z = n * x.astype(object) - sums
                far = int(np.abs(z).max(initial=0))
                if far * far * model.dim < 1 << 63:
                    deviation = pa.array((z * z).sum(axis=1).astype(np.int64)).cast(pa.decimal128(38, 0))
                else:
                    o = z.astype(object)
                    deviation = pa.array([Decimal(int(v)) for v in (o * o).sum(axis=1)], pa.decimal128(38, 0))
                # sqrt of the covariance's eigenvalue, root / n^2
                deviations = np.array([math.sqrt(e / (n * n)) for e in model.eigenvalues])
                w = (z / n).astype(np.float64) @ model.components.T / deviations
                lists = pa.ListArray.from_arrays(np.arange(0, w.size + 1, w.shape[1], dtype=np.int32), w.ravel())
                yield pa.RecordBatch.from_arrays([
                    b.column(0).take(pa.array(at)), pa.array(np.full(len(at), model.dim, np.int32)), pa.array(np.full(len(at), n)), deviation, lists],
                    names=["vec_id", "dim", "n", "deviation", "whitened"])

    return rows.mapInArrow(run, "vec_id long, dim int, n long, deviation decimal(38,0), whitened array<double>")


def identity_error(whitened: DataFrame, k: int) -> float:
    """Largest absolute entry of the covariance (divisor n, centred) of the first k places, minus the identity."""
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    one = whitened.agg(*[F.covar_pop(F.col("whitened")[i], F.col("whitened")[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(one[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whiten(spark: SparkSession, df: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    rows = usable(df, id_col, vector_col)
    models = fit(spark, rows, components)
    table = staged(spark, transform(rows, models), "whitened")
    none = F.lit(None).cast("double")
    explained, error = none, none
    for d, model in models.items():
        k = len(model.eigenvalues)
        own = identity_error(table.where(F.col("dim") == d), k)
        explained = F.when(F.col("dim") == d, F.element_at(F.array(*map(F.lit, model.explained)), F.col("component"))).otherwise(explained)
        error = F.when(F.col("dim") == d, F.lit(own)).otherwise(error)
    long = table.select("vec_id", "dim", "n", "deviation", F.posexplode("whitened").alias("place", "whitened")).withColumn(
        "component", (F.col("place") + 1).cast("int"))
    return long.select("vec_id", "component", "n", "deviation", "whitened", explained.alias("explained"), error.alias("identity_error"))
