"""An additive model y = b0 + smooths + linear terms, from keyed sums of products.

A smooth is a cubic B-spline on even knots with a penalty on second differences. Of its n functions four are
not zero at any x, so a row is a short list of (place, value). One aggregation keyed by two places gives X'X,
X'y and y'y; its size follows the model and not the rows, and the driver solves the small system. With
sums by fold, every fold is left out by subtraction, so a sweep over splines and penalties takes one pass.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as K

#: Makes the level that smooths share with the constant determinate.
RIDGE = 1e-6


@dataclass(frozen=True)
class Design:
    """What a row's list holds: 0 is the constant, then n places for each smooth, then the linear terms, then y."""

    smooths: tuple[str, ...]
    linear: tuple[str, ...]
    ranges: dict[str, tuple[float, float]]
    n: int = K.SPLINES

    @property
    def size(self) -> int:
        return 1 + self.n * len(self.smooths) + len(self.linear)

    def basis(self, name: str, shift: float = 0.0) -> tuple[Column, list[Column]]:
        """Place of the first of a smooth's four functions, and their values; x beyond the ends is held at them."""
        low, high = self.ranges[name]
        step = (high - low) / (self.n - 3) or 1.0
        at = F.greatest(F.lit(0.0), F.least(F.lit(self.n - 3 - 1e-9), (F.col(name) + shift - low) / step))
        first = F.floor(at)
        u = at - first
        v = F.lit(1.0) - u
        return first.cast("int") + 1 + self.n * self.smooths.index(name), [v * v * v / 6, (3 * u * u * u - 6 * u * u + 4) / 6, (-3 * u * u * u + 3 * u * u + 3 * u + 1) / 6, u * u * u / 6]

    def entries(self) -> Column:
        """The row's list, without y."""
        one = lambda i, v: F.struct(F.lit(i).alias("i") if isinstance(i, int) else i.alias("i"), v.cast("double").alias("v"))
        out = [one(0, F.lit(1.0))]
        for name in self.smooths:
            first, values = self.basis(name)
            out += [one(first + k, v) for k, v in enumerate(values)]
        return F.array(*out, *(one(1 + self.n * len(self.smooths) + k, F.col(c)) for k, c in enumerate(self.linear)))

    def penalty(self, weight: float) -> np.ndarray:
        out, bend = np.zeros((self.size, self.size)), np.diff(np.eye(self.n), 2, axis=0)
        for k in range(len(self.smooths)):
            part = slice(1 + k * self.n, 1 + (k + 1) * self.n)
            out[part, part] = weight * bend.T @ bend + RIDGE * np.eye(self.n)
        return out


def design(rows: DataFrame, smooths: tuple[str, ...], linear: tuple[str, ...] = (), n: int = K.SPLINES) -> Design:
    """A design over the ranges of the rows' smooth columns."""
    ends = rows.agg(*(f(c).cast("double").alias(f"{k}_{c}") for c in smooths for k, f in (("a", F.min), ("b", F.max)))).first()
    if any(x is None for x in ends):
        raise ValueError("no rows to fit")
    return Design(tuple(smooths), tuple(linear), {c: (ends[f"a_{c}"], ends[f"b_{c}"]) for c in smooths}, n)


def product_sums(rows: DataFrame, y: str, designs: Iterable[Design], fold: Column | None = None) -> DataFrame:
    """(n, fold, i, j, v): for each design (by its n) and fold the sums of the products of places i <= j; place `size` is y."""
    fold = F.lit(0) if fold is None else fold
    each = F.array(*(F.struct(F.lit(d.n).alias("n"), F.concat(d.entries(), F.array(F.struct(F.lit(d.size).alias("i"), F.col(y).cast("double").alias("v")))).alias("e")) for d in designs))
    listed = rows.select(fold.cast("int").alias("fold"), F.explode(each).alias("x")).select("fold", "x.n", "x.e")
    pairs = listed.select("fold", "n", "e", F.explode("e").alias("a")).select("fold", "n", "a", F.explode("e").alias("b")).where("a.i <= b.i")
    return pairs.groupBy("n", "fold", F.col("a.i").alias("i"), F.col("b.i").alias("j")).agg(F.sum(F.col("a.v") * F.col("b.v")).alias("v"))


def _full(found: list, size: int) -> np.ndarray:
    """The symmetric matrix of product sums, y last."""
    out = np.zeros((size + 1, size + 1))
    for r in found:
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["v"]
    return out


def _solve(sums: np.ndarray, penalty: np.ndarray) -> np.ndarray:
    return np.linalg.solve(sums[:-1, :-1] + penalty, sums[:-1, -1])


@dataclass(frozen=True)
class AdditiveModel:
    design: Design
    weights: np.ndarray

    @classmethod
    def fit(cls, df: DataFrame, y: str, smooths: tuple[str, ...], linear: tuple[str, ...] = (), n: int = K.SPLINES, penalty: float = K.PENALTY) -> AdditiveModel:
        """Rows with a null in any of the columns are left out."""
        rows = df.select(y, *smooths, *linear).dropna()
        own = design(rows, smooths, linear, n)
        return cls(own, _solve(_full(product_sums(rows, y, [own]).collect(), own.size), own.penalty(penalty)))  # at most size^2 rows

    def value(self, shift: dict[str, float] | None = None) -> Column:
        """The prediction, with inputs shifted if asked; null where an input is null."""
        d, table = self.design, F.lit([float(x) for x in self.weights])
        total = F.lit(float(self.weights[0]))
        for name in d.smooths:
            first, values = d.basis(name, (shift or {}).get(name, 0.0))
            for k, v in enumerate(values):
                total = total + F.when(F.col(name).isNotNull(), F.get(table, first + k) * v)
        for k, name in enumerate(d.linear):
            total = total + float(self.weights[1 + d.n * len(d.smooths) + k]) * (F.col(name) + (shift or {}).get(name, 0.0))
        return total

    def predict(self, df: DataFrame, out: str) -> DataFrame:
        return df.withColumn(out, self.value())

    def derivative(self, df: DataFrame, column: str, out: str, h: float) -> DataFrame:
        """Adds the central difference of the prediction in one input."""
        return df.withColumn(out, (self.value({column: h}) - self.value({column: -h})) / (2 * h))


def sweep(df: DataFrame, y: str, smooths: tuple[str, ...], linear: tuple[str, ...] = (), splines: tuple[int, ...] = (8, K.SPLINES), penalties: tuple[float, ...] = (5.0, K.PENALTY), fold: Column | None = None) -> DataFrame:
    """A row for each number of splines and penalty: splines, penalty, folds, n, out-of-fold r2 and rmse.

    `fold` names each row's fold, a block of time as a rule; each is predicted by the model of all others. Sums are
    taken once; the driver gets as many numbers as the designs' matrices have, times the folds. Rows with a
    null in any column are left out. A fold of its own can't be left out: r2 and rmse are null then.
    """
    columns = list(dict.fromkeys((y, *smooths, *linear)))
    rows = df.select(*columns, (F.lit(0) if fold is None else fold).cast("int").alias("__fold")).dropna()
    first = design(rows, smooths, linear, splines[0])
    designs = [replace(first, n=n) for n in splines]
    found = product_sums(rows, y, designs, F.col("__fold")).collect()
    out = []
    for d in designs:
        parts = {k: _full([r for r in found if r["n"] == d.n and r["fold"] == k], d.size) for k in sorted({r["fold"] for r in found})}
        total = sum(parts.values())
        n, yy, mean = total[0, 0], total[-1, -1], total[0, -1] / total[0, 0]
        for penalty in penalties:
            if len(parts) < 2:
                out.append((d.n, float(penalty), len(parts), int(n), None, None))
                continue
            off = 0.0
            for own in parts.values():
                b = np.append(_solve(total - own, d.penalty(penalty)), -1.0)
                off += float(b @ own @ b)
            around = yy - n * mean * mean
            out.append((d.n, float(penalty), len(parts), int(n), float(1 - off / around) if around > 0 else None, float(np.sqrt(off / n))))
    return df.sparkSession.createDataFrame(out, "splines int, penalty double, folds int, n long, r2 double, rmse double")
