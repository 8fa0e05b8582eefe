"""Ranges of positions that hold some number of rows each, so that no task orders a whole log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of the log in one range of positions, about.
RANGE_ROWS = 250_000


def by_bounds(key: Column, bounds: list[Column], first: int = 0) -> Column:
    """How many of the ascending ``bounds`` are at or below the key (plus ``first``), by halving: a row is compared log2 times."""
    if not bounds:
        return F.lit(first)
    middle = len(bounds) // 2
    return F.when(key < bounds[middle], by_bounds(key, bounds[:middle], first)).otherwise(by_bounds(key, bounds[middle + 1 :], first + middle + 1))


def ranges(rows: DataFrame, at: str, range_rows: int = RANGE_ROWS) -> Column:
    """The number of the range of positions that a row lies in; bounds are approximate quantiles."""
    n = -(-rows.count() // range_rows)
    bounds = sorted(set(rows.agg(F.percentile_approx(at, F.array(*[F.lit(i / n) for i in range(1, n)]), F.lit(max(10_000, 20 * n)))).first()[0] or [])) if n > 1 else []
    return by_bounds(F.col(at), [F.lit(b) for b in bounds])
