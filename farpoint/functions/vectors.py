"""Vector expressions over ``array<double>`` columns.

4.1 has no built-in vector distance.  Two forms are provided:

* column-to-column: higher-order ``zip_with`` + ``aggregate`` (works for any
  dimension, outside whole-stage codegen);
* column-to-constant: the same form against an array literal.  The literal
  is passed to the generated code as a reference, so a loop that changes the
  center every step reuses one compiled plan; the unrolled alternative
  (``unroll=True``) inlines each coordinate and pays a fresh compile per
  new center, which only pays off for a single long scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Above this dimension the unrolled form makes generated methods too large.
UNROLL_MAX_DIM = 128


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def sqdist(a: Column | str, b: Column | str) -> Column:
    """Squared Euclidean distance of two double arrays; unequal lengths raise."""
    a, b = _c(a), _c(b)
    diffs = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    total = F.aggregate(diffs, F.lit(0.0).cast("double"), lambda s, z: s + z)
    return F.when(F.size(a) != F.size(b), F.raise_error(F.lit(
        "points of different dimension")).cast("double")).otherwise(total)


def euclidean(a: Column | str, b: Column | str) -> Column:
    """Euclidean distance of two equal-length double arrays."""
    return F.sqrt(sqdist(a, b))


def sqdist_to_const(v: Column | str, center: Sequence[float], unroll: bool = False) -> Column:
    """Squared distance from each row's vector to one constant vector."""
    v = _c(v)
    coords = [float(x) for x in center]
    if unroll and len(coords) <= UNROLL_MAX_DIM:
        total = None
        for i, x in enumerate(coords):
            d = v.getItem(i) - F.lit(x)
            term = d * d
            total = term if total is None else total + term
        return total if total is not None else F.lit(0.0)
    const = F.array(*[F.lit(x) for x in coords])
    return sqdist(v, const)


def dist_to_const(v: Column | str, center: Sequence[float], unroll: bool = False) -> Column:
    return F.sqrt(sqdist_to_const(v, center, unroll))


def parse_vector(text: Column | str) -> Column:
    """Comma-separated doubles -> ``array<double>`` (strict).

    Trailing empty fields are dropped as Java ``split(",")`` does; any other
    bad field raises at run time instead of turning into NULL.
    """
    t = F.regexp_replace(_c(text), ",+$", "")
    fields = F.split(t, ",", -1)
    parsed = F.transform(fields, lambda x: x.try_cast("double"))
    bad = F.exists(parsed, lambda p: p.isNull())
    return (F.when(bad | (F.length(t) == 0),
                   F.raise_error(F.concat(F.lit("malformed point: "), F.coalesce(_c(text), F.lit("NULL")))))
            .otherwise(parsed))


def to_double_vector(col: Column | str) -> Column:
    """Cast any numeric array (e.g. ``array<float>``) to ``array<double>``."""
    return _c(col).cast("array<double>")
