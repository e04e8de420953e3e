"""Small linear algebra inside a row: least squares from co-moments, as array expressions."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import Column, functions as F


def co_moments(xs: list, y) -> dict[str, Column]:
    """Aggregates for a regression of ``y`` on ``xs``: one entry per pair, merged on the map side. All columns must be known in
    a row for it to count, so filter or mask them together first."""
    xs, y = [F.col(x) if isinstance(x, str) else x for x in xs], F.col(y) if isinstance(y, str) else y
    out = {f"__c_{i}_{j}": F.covar_pop(xs[i], xs[j]) for i, j in combinations_with_replacement(range(len(xs)), 2)}
    out |= {f"__y_{i}": F.covar_pop(x, y) for i, x in enumerate(xs)}
    out |= {f"__m_{i}": F.avg(x) for i, x in enumerate(xs)}
    return out | {"__m_y": F.avg(y), "__v_y": F.var_pop(y), "__n": F.count(y)}


def gram(k: int) -> Column:
    """The k rows [covariances of x_i with all x | 1 0 .. 0 | covariance with y], the unit matrix between them, as nested arrays."""
    cell = lambda i, j: F.col(f"__c_{min(i, j)}_{max(i, j)}")
    return F.array(*[
        F.array(*[cell(i, j) for j in range(k)], *[F.lit(float(i == j)) for j in range(k)], F.col(f"__y_{i}")) for i in range(k)
    ])


def solved(matrix: Column, k: int) -> Column:
    """Gauss-Jordan elimination on a symmetric positive definite system: the rows [unit matrix | inverse | solution]. A pivot that
    is nothing beside its column's own variance (a constant or dependent column) makes all values NULL."""

    def step(rows: Column, i: Column) -> Column:
        pivot = F.get(rows, i)
        scale = F.get(pivot, i)
        origin = F.abs(F.get(F.get(matrix, i), i))
        unit = F.transform(pivot, lambda v: F.when(F.abs(scale) > 1e-12 * origin, v / scale))
        return F.transform(rows, lambda row, r: F.when(r == i, unit).otherwise(
            F.zip_with(row, unit, lambda a, b: a - F.get(row, i) * b)))

    return F.aggregate(F.sequence(F.lit(0), F.lit(k - 1)), matrix, step)


def least_squares(k: int) -> dict[str, Column]:
    """From the columns of ``co_moments`` over k regressors: ``__rows`` first, then intercept, coefs and t values may be read
    with ``fitted``. Kept apart, so that the elimination is computed once."""
    return {"__rows": solved(gram(k), k)}


def fitted(k: int) -> dict[str, Column]:
    """intercept, coefs, rss (residual sum of squares) and errors (standard errors of the coefs) from ``__rows``."""
    coefs = F.transform(F.col("__rows"), lambda r: F.get(r, F.lit(2 * k)))
    means = F.array(*[F.col(f"__m_{i}") for i in range(k)])
    toward = F.array(*[F.col(f"__y_{i}") for i in range(k)])
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)
    rss = F.greatest(F.col("__v_y") - dot(coefs, toward), F.lit(0.0)) * F.col("__n")
    noise = F.try_divide(rss, F.col("__n") - k - 1)
    errors = F.transform(F.col("__rows"), lambda r, i: F.sqrt(F.when(noise >= 0, noise * F.get(r, i + k) / F.col("__n"))))
    return {"intercept": F.col("__m_y") - dot(coefs, means), "coefs": coefs, "rss": rss, "errors": errors}
