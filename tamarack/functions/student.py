"""Two-sided p value of a correlation, as a column expression."""

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Nodes and weights of the double-exponential rule for integrals over 0 .. infinity of what falls off exponentially.
_STEPS = np.arange(-4.5, 4.75, 1 / 16)
_NODES = np.exp(_STEPS - np.exp(-_STEPS))
_WEIGHTS = _NODES * (1 + np.exp(-_STEPS)) / 16


def _tail(start: Column, freedom: Column) -> Column:
    """Integral of sech(u) ** freedom from ``start`` on."""
    reach = 1 / (F.sqrt(freedom) + freedom * F.tanh(start))
    given = F.struct(start.alias("start"), freedom.alias("freedom"), reach.alias("reach"))

    def integral(row: Column) -> Column:
        halves = F.transform(F.lit(_NODES), lambda node: F.sinh((row["start"] + row["reach"] * node) / 2))

        def part(half: Column, weight: Column) -> Column:
            return weight * F.exp(-row["freedom"] * F.log1p(2 * half * half))  # cosh(u) = 1 + 2 * half * half

        return row["reach"] * F.aggregate(F.zip_with(halves, F.lit(_WEIGHTS), part), F.lit(0.0), lambda total, x: total + x)

    # As the elements of arrays, what belongs to the row and the half of a node are worked out once, not where they are named.
    return F.get(F.transform(F.array(given), integral), 0)


def correlation_p(rho: Column, n: Column) -> Column:
    """Of Student's t with n - 2 degrees of freedom; null for fewer than three rows.

    With r = tanh(u) the density of r becomes sech(u) ** (n - 2), so p is the share of the integral beyond atanh |r|. No
    step rounds 1 - r * r, so digits last at any n.
    """
    size, freedom = F.abs(rho), n.cast("double") - 2
    inside = F.when(size < 1, F.least(_tail(F.atanh(size), freedom) / _tail(F.lit(0.0), freedom), F.lit(1.0)))
    return F.when((freedom >= 1) & rho.isNotNull(), F.coalesce(inside, F.lit(0.0)))
