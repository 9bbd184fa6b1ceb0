"""A sum of doubles that does not depend on row order.

Adding doubles rounds at every step, so a plain ``sum`` changes with partitioning and retries, and
at rounding ties that moves the published last cent. Here each value is cut into whole numbers whose
long sums are exact.

Values below 2^17 in size are in band 0 and cut at steps of 2^-8, 2^-34 and 2^-60. Those of 2^-8 and
more are represented without loss; below that the loss is under 2^-61 each. No piece exceeds 2^25, so
the long sums hold for 2^38 rows. Put together they give the true sum, rounded to a double once.

Larger values are in one band per eight binary orders of size, each cut in two without loss; these
sums hold for 2^31 rows per band. ANSI mode raises rather than wraps beyond. A group's bands are added
up from the smallest values to the largest, so the result is the same in whatever order rows come.
Infinities and NaN have band -1 and an ordinary sum, whose order makes no difference.

Sums are by group and band first: ``exact_sum_columns`` has the band among its columns, and
``exact_sum_value`` takes a group's rows, one per band, as an array.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BAND = "sum_band"
PIECES = ("sum_coarse", "sum_middle", "sum_fine", "sum_wild")
_LIMIT_BITS = 17
_LIMIT = float(2**_LIMIT_BITS)
_FIRST = float(2**8)
_NEXT = 2**26
_BAND_BITS = 8
_HALF = 2**32


def _unit_bits(band: Column) -> Column:
    """The binary order of the last place kept of a large value."""
    return F.lit(_LIMIT_BITS - 54 - _BAND_BITS) + band * F.lit(_BAND_BITS)


def exact_sum_columns(x: Column) -> dict[str, Column]:
    """The band and the per-row values to add up within it, named ``BAND`` and as in ``PIECES``."""
    size = F.abs(x)
    tame, finite = size < F.lit(_LIMIT), size < F.lit(float("inf"))
    order = F.floor(F.log2(F.when(finite & ~tame, size).otherwise(F.lit(_LIMIT)))).cast("int")
    number = F.call_function("div", order - F.lit(_LIMIT_BITS), F.lit(_BAND_BITS)).cast("int") + 1
    band = F.when(tame, F.lit(0)).when(finite, F.greatest(number, F.lit(1))).otherwise(F.lit(-1))

    scaled = F.when(tame, x * F.lit(_FIRST)).otherwise(F.lit(0.0))
    coarse = F.rint(scaled)
    scaled = (scaled - coarse) * F.lit(float(_NEXT))
    middle = F.rint(scaled)
    fine = F.rint((scaled - middle) * F.lit(float(_NEXT)))

    large = x * F.pow(F.lit(2.0), -_unit_bits(number))
    high = F.rint(large / F.lit(float(_HALF)))
    low = large - high * F.lit(float(_HALF))
    is_large = finite & ~tame
    coarse = F.when(is_large, high).otherwise(coarse)
    middle = F.when(is_large, low).otherwise(middle)
    wild = F.when(finite, F.lit(None).cast("double")).otherwise(x)
    whole = [piece.cast("bigint") for piece in (coarse, middle, fine)]
    return {BAND: band, **dict(zip(PIECES, [*whole, wild], strict=True))}


def band_pieces() -> Column:
    """A band's added-up pieces as one element for ``exact_sum_value``."""
    return F.struct(BAND, *PIECES)


def _band_value(part: Column) -> Column:
    coarse, middle, fine = (part[name].cast("decimal(20,0)") for name in PIECES[:3])
    step = F.lit(_NEXT).cast("decimal(9,0)")
    tame = ((coarse * step).cast("decimal(38,0)") + middle) * step + fine
    tame = tame.cast("decimal(38,0)").cast("double") * F.lit(2.0**-60)
    large = (coarse * F.lit(_HALF).cast("decimal(11,0)")).cast("decimal(38,0)") + middle
    large = large.cast("decimal(38,0)").cast("double") * F.pow(F.lit(2.0), _unit_bits(part[BAND]))
    return F.when(part[BAND] == 0, tame).when(part[BAND] > 0, large).otherwise(part["sum_wild"])


def exact_sum_value(bands: Column) -> Column:
    """The sum as a double, from an array of a group's ``band_pieces``."""
    return F.aggregate(F.array_sort(bands), F.lit(0.0), lambda total, part: total + _band_value(part))
