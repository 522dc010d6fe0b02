"""Universal-hash Column expressions used by the colouring and sketch operators.

All of them are built-in arithmetic (``pmod``, ``*``, ``+``) so they stay
inside whole-stage codegen; none is a Python UDF.  Parameters may be
Python ints or Columns (the multi-run operators carry ``a``/``b`` as
columns so that all runs execute as one job).

The input is reduced modulo ``p`` *before* the multiplication.  This is
the same value as ``((a*x + b) mod p)`` for every ``x`` (mathematical
modulus), but never overflows 64 bits for ``p < 2**31`` whatever the
magnitude of the id, so it is safe under ANSI arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the prime used by every hash in the original jobs.
DEFAULT_PRIME = 8191
# For ids or items beyond 8191, which that prime would merge: the largest
# prime below 2**31 (products stay within 64 bits).
LARGE_PRIME = 2147483647

IntOrCol = int | Column


def _c(x: IntOrCol | str) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


def mod_hash(x: IntOrCol | str, a: IntOrCol, b: IntOrCol,
             p: int = DEFAULT_PRIME) -> Column:
    """``(a*x + b) mod p`` with a non-negative result."""
    return F.pmod(_c(a) * F.pmod(_c(x), F.lit(p)) + _c(b), F.lit(p))


def node_color(x: IntOrCol | str, a: IntOrCol, b: IntOrCol, num_colors: IntOrCol,
               p: int = DEFAULT_PRIME) -> Column:
    """Vertex colour ``((a*x + b) mod p) mod C`` in ``[0, C)``."""
    return F.pmod(mod_hash(x, a, b, p), _c(num_colors))


def bucket_hash(x: IntOrCol | str, a: IntOrCol, b: IntOrCol, width: IntOrCol,
                p: int = DEFAULT_PRIME) -> Column:
    """Count-sketch column hash ``h(x) = ((a*x + b) mod p) mod W``."""
    return node_color(x, a, b, width, p)


def sign_hash(x: IntOrCol | str, a: IntOrCol, b: IntOrCol,
              p: int = DEFAULT_PRIME) -> Column:
    """Count-sketch sign ``g(x)`` in {-1, +1}.

    ``r = (a*x + b) mod p`` is mapped to ``2r/(p-1) - 1``; the sign is +1
    when that is >= 0, i.e. when ``2r >= p - 1``.  Integer form, no
    floating point.
    """
    r = mod_hash(x, a, b, p)
    return F.when(r * 2 >= F.lit(p - 1), F.lit(1)).otherwise(F.lit(-1))


def edge_bucket(u: IntOrCol | str, v: IntOrCol | str, a_u: IntOrCol, a_v: IntOrCol,
                b: IntOrCol, num_buckets: IntOrCol, p: int = DEFAULT_PRIME) -> Column:
    """Bucket of an edge ``((a_u*u + a_v*v + b) mod p) mod C``.

    A reproducible stand-in for "random partition of the edge set into C
    parts": replaying a lost task assigns the same bucket.
    """
    pp = F.lit(p)
    r = F.pmod(_c(a_u) * F.pmod(_c(u), pp) + _c(a_v) * F.pmod(_c(v), pp) + _c(b), pp)
    return F.pmod(r, _c(num_buckets))


def low32(x: IntOrCol | str) -> Column:
    """Two's-complement narrowing of a bigint to its low 32 bits (as bigint).

    Equal to ``x`` for ``|x| < 2**31``.  Written with ``pmod`` because a
    plain cast to int raises on overflow under ANSI mode.
    """
    two31, two32 = F.lit(2147483648), F.lit(4294967296)
    return F.pmod(F.pmod(_c(x), two32) + two31, two32) - two31


def sorted3(x: Column, y: Column, z: Column) -> tuple[Column, Column, Column]:
    """The three values in non-decreasing order, as three Columns."""
    lo = F.least(x, y, z)
    hi = F.greatest(x, y, z)
    return lo, x + y + z - lo - hi, hi
