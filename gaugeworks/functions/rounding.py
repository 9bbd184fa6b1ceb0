from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even_2(x: Column) -> Column:
    """Two decimals, rounding the exact binary value half-even, as Python's ``round(x, 2)`` does.

    ``F.round`` and ``F.bround`` round the shortest decimal text instead and differ on roughly a
    sixth of typical means; the number formatter works on the binary value.
    """
    text = F.call_function("format_number", x, F.lit("0.00"))
    finite = F.abs(x) < F.lit(float("inf"))
    return F.when(finite, text.cast("double")).otherwise(x)
