"""Whitening of integer vectors, with eigenpairs found by spectrum slicing.

Spark sums the vectors and their centred products; only these sums, one number for each pair of
dimensions, reach the driver. There the number of eigenvalues below a shift is read from the signs
of an LDL' factorisation of the shifted covariance. Such counts halve an interval until it holds one
eigenvalue, Rayleigh quotient iteration converges to it, and counts just beside the value found
certify its number in the spectrum.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmart.llm.vectors import filled, matrix, scaled, usable, widest

ROWS = 4096          # vectors multiplied at once
CLOSE = 64 * np.finfo(float).eps   # eigenvalues this close, against the largest, are one
ALPHA = (1 + 17 ** 0.5) / 8        # least growth of pivots of one and of two rows


class Shifted:
    """LDL' of a symmetric matrix less a shift, with pivots of one or two rows."""

    def __init__(self, a: np.ndarray, shift: float):
        a = a - shift * np.eye(len(a))
        n = len(a)
        self.tiny = max(np.finfo(float).eps ** 2 * np.abs(a).max(initial=0.0), 1e-290)
        self.order, self.lower = np.arange(n), np.eye(n)
        self.pivots: list[tuple[int, np.ndarray]] = []
        k = 0
        while k < n:
            rest = np.abs(a[k:, k:])
            diagonal = rest.diagonal()
            i, j = np.unravel_index(np.argmax(rest), rest.shape)
            d = int(np.argmax(diagonal))
            size = 1 if diagonal[d] >= ALPHA * rest[i, j] else 2
            for to, at in zip((k, k + 1), ((k + d,) if size == 1 else sorted((k + i, k + j)))):
                self._swap(a, to, at)
            block = a[k:k + size, k:k + size].copy()
            self.pivots.append((k, block))
            if not block.any():  # nothing is left
                self.pivots += [(m, np.zeros((1, 1))) for m in range(k + 1, n)]
                break
            below = a[k + size:, k:k + size]
            weights = np.linalg.solve(block, below.T).T
            a[k + size:, k + size:] -= weights @ below.T
            self.lower[k + size:, k:k + size] = weights
            k += size

    def _swap(self, a: np.ndarray, to: int, at: int) -> None:
        if to != at:
            a[[to, at]] = a[[at, to]]
            a[:, [to, at]] = a[:, [at, to]]
            self.order[[to, at]] = self.order[[at, to]]
            self.lower[[to, at], :to] = self.lower[[at, to], :to]

    def below(self) -> int:
        """How many eigenvalues are below the shift: those of the pivots that are negative."""
        # a pivot of two rows has one eigenvalue of each sign
        return sum(1 if len(b) == 2 else int(b[0, 0] < 0) for _, b in self.pivots)

    def solve(self, right: np.ndarray) -> np.ndarray:
        y = np.linalg.solve(self.lower, right[self.order])
        for k, block in self.pivots:
            at = slice(k, k + len(block))
            if len(block) == 1:  # at an eigenvalue, its vector may grow but stays finite
                y[at] /= block[0, 0] if abs(block[0, 0]) > self.tiny else self.tiny
            else:
                y[at] = np.linalg.solve(block, y[at])
        out = np.empty_like(y)
        out[self.order] = np.linalg.solve(self.lower.T, y)
        return out


def rayleigh(a: np.ndarray, low: float, high: float, found: list[np.ndarray], scale: float
             ) -> tuple[float, np.ndarray]:
    """The eigenpair of an interval that is farther from all other eigenvalues than it is wide,
    orthogonal to the vectors `found`. Inverse iteration from its middle leads to the pair, Rayleigh
    quotients finish; one that leaves the interval goes back to the middle."""
    middle = (low + high) / 2

    def clean(v):
        for _ in range(2):
            for u in found:
                v = v - (u @ v) * u
        return v / np.linalg.norm(v)

    v = clean(np.cos(np.arange(1, len(a) + 1) * (len(found) + 1.0)) + 0.5)
    shift, best = middle, None
    for step in range(80):
        y = Shifted(a, shift).solve(v)
        if not np.isfinite(y).all() or not y.any():  # the shift is an eigenvalue to the last bit
            shift += CLOSE * scale * (step + 1)
            continue
        v = clean(y / np.abs(y).max())
        value = v @ a @ v
        inside = low <= value <= high
        left = np.linalg.norm(a @ v - value * v)
        if inside and (best is None or left < best[0]):
            best = left, value, v
        elif best and best[0] <= CLOSE * scale:
            break
        shift = value if inside and step > 3 else middle
    if best is None:
        raise ArithmeticError(f"no eigenvalue found in [{low}, {high}]")
    return best[1], best[2]


def leading(a: np.ndarray, count: int) -> list[tuple[float, np.ndarray]]:
    """The `count` largest eigenvalues of a symmetric matrix, falling, with unit eigenvectors.

    Values that agree to rounding get any orthonormal vectors of their space. Every pair is
    certified: counts below and above its value show how many eigenvalues are larger.
    """
    n = len(a)
    radius = np.abs(a).sum(axis=1).max() if n else 0.0  # no eigenvalue is beyond it
    scale = radius or 1.0
    edge = CLOSE * scale
    above = lambda shift: n - Shifted(a, shift).below()
    pairs: list[tuple[float, np.ndarray]] = []
    for number in range(min(count, n)):
        # more than `number` eigenvalues are above `low`, at most `number` above `high`
        low, high = -1.001 * scale, 1.001 * scale
        while (width := high - low) > edge and (
                above(low - width) > number + 1 or above(high + width) < number):
            middle = (low + high) / 2
            if above(middle) > number:
                low = middle
            else:
                high = middle
        value, vector = rayleigh(a, low - edge, high + edge, [v for _, v in pairs], scale)
        if not above(value + 4 * edge) <= number < above(value - 4 * edge):
            raise ArithmeticError(f"eigenvalue {number + 1} is not certified")
        pairs.append((value, vector))
    return sorted(pairs, key=lambda pair: -pair[0])


def sums(fit: DataFrame, width: int) -> tuple[int, list[int]]:
    """The number of vectors and the sum of each dimension, exactly."""
    total = fit.select(F.posexplode("x").alias("at", "c")).groupBy("at").agg(
        F.sum(F.col("c").cast("decimal(38,0)")).alias("s"))
    found = {r["at"]: int(r["s"]) for r in total.collect()}  # one row for each dimension
    return fit.count(), [found.get(k, 0) for k in range(width)]


def centred(x: np.ndarray, mean: np.ndarray) -> np.ndarray:
    return x.astype(np.float64) - mean


def covariance(fit: DataFrame, mean: np.ndarray, n: int, turn: np.ndarray) -> np.ndarray:
    """Covariance of the centred vectors times `turn`, divisor n. A task adds up its own products;
    its sums alone are shuffled."""
    width, size = turn.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                y = centred(matrix(batch.slice(at, ROWS).column("x"), width), mean) @ turn
                total += y.T @ y
        i, j = np.indices(total.shape).reshape(2, -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
             pa.array(total.reshape(-1))], ["i", "j", "s"])

    parts = fit.select("x").mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(
        F.sum("s").alias("s"))
    out = np.zeros((size, size))
    for i, j, s in parts.collect():  # width squared numbers, however many rows
        out[i, j] = s
    return (out + out.T) / 2 / max(n, 1)


def whiten(rows: DataFrame, components: int = 4, key: str = "vec_id",
           vector: str = "embedding") -> DataFrame:
    """For each row and component from 1: `key`, `component`, `n`, `deviation` (sum over dimensions
    of (n x - S)^2), `whitened`, `explained` and `identity_error`.

    x is floor(256 c) of every entry c. The fit list holds each distinct x once: n vectors with sums
    S. Rows whose vector is null or holds null, NaN or infinity are left out. A shorter vector
    counts as if zeros followed. Repeated rows, and rows without a key, each have their result.
    There are as many components as dimensions at most. A component without variance (fewer
    different vectors than components, or one vector alone) has a null `whitened`, and the identity
    is held against the others. `deviation` is null where it leaves the range of long. An empty
    table gives no row. Other columns are ignored.
    """
    given = rows.select(rows[f"`{key}`"].alias("id"), rows[f"`{vector}`"].alias("given")).where(
        usable(F.col("given"))).select("id", scaled(F.col("given")).alias("x"))
    width = widest(given, "x")
    given = given.withColumn("x", filled(F.col("x"), width))
    kind = rows.schema[key].dataType.simpleString()
    schema = (f"`{key}` {kind}, component int, n bigint, deviation bigint, whitened double, "
              "explained double, identity_error double")
    fit = given.groupBy("x").agg(F.lit(True).alias("once")).select("x").checkpoint()
    n, total = sums(fit, width)
    mean = np.array([s / max(n, 1) for s in total])
    v = covariance(fit, mean, n, np.eye(width))
    pairs = leading(v, components)
    trace = float(np.trace(v))
    values = np.array([max(value, 0.0) for value, _ in pairs])
    alive = values > CLOSE * max(trace, 1.0) * width
    turn = np.stack([u for _, u in pairs], axis=1) if pairs else np.zeros((width, 0))
    turn = turn / np.sqrt(np.where(alive, values, 1.0))
    held = covariance(fit, mean, n, turn[:, alive]) if alive.any() else np.zeros((0, 0))
    error = float(np.abs(held - np.eye(len(held))).max()) if held.size else 0.0
    explained = [float(value / trace) if trace > 0 else 0.0 for value in values]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        many = len(explained)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                x = matrix(part.column("x"), width)
                w = centred(x, mean) @ turn
                size = len(x)
                places = pa.array(np.repeat(np.arange(size), many))
                off = [n * x[:, d].astype(object) - total[d] for d in range(width)] if n * float(
                    np.abs(x).max(initial=0)) * 2 > 1e8 else n * x - np.array(total, np.int64)
                squares = sum(o * o for o in off) if isinstance(off, list) else (off * off).sum(1)
                fits = [int(s) if s < 1 << 63 else None for s in squares]
                gone = np.tile(~alive, size)
                yield pa.RecordBatch.from_arrays([
                    part.column("id").take(places),
                    pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), size)),
                    pa.array(np.full(size * many, n)),
                    pa.array(fits, pa.int64()).take(places),
                    pa.array(w.reshape(-1), mask=gone),
                    pa.array(np.tile(explained, size)),
                    pa.array(np.full(size * many, error)),
                ], [key, "component", "n", "deviation", "whitened", "explained",
                    "identity_error"])

    return given.mapInArrow(run, schema)
