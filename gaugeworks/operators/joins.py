"""Joining a large, possibly skewed side to a lookup side without assuming the lookup is small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALT = "__salt"


HOT = "__hot"


def frequent_keys(rows: DataFrame, keys: list[str], most: int) -> DataFrame:
    """The ``keys`` that more than one in ``most`` of all ``rows`` have: fewer than ``most`` of them,
    whatever the number of rows. Null keys are left out."""
    total = rows.count()
    counted = rows.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") > F.lit(total / most)).select(*keys)


def join_lookup(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str,
    *,
    broadcast: bool,
    salts: int,
    frequent: DataFrame | None = None,
) -> DataFrame:
    """Equi-join with ``right`` unique on ``keys``; ``how`` keeps or filters rows of ``left``.

    ``broadcast`` is the caller's finding that ``right`` is within the measured bounds. Otherwise
    the rows of a left key spread over ``salts`` tasks, and each right row is repeated once per
    salt. The result is the same either way, in batch and in streams.

    With ``frequent``, a table of keys from ``frequent_keys``, only those keys are spread and repeated.
    It is broadcast, as its size is bounded. A key that is missing there makes no difference to the result.

    In batch a row's salt is a hash of the row: a repeated task gives it the same one, in whatever
    order its input arrives. Copies of one row hash alike, but there adaptive execution splits what
    is still skewed. A stream has no adaptive execution, yet reads its source in the same order
    again, so there a seeded random number spreads the copies too.
    """
    if broadcast:
        return left.join(F.broadcast(right), keys, how)
    if left.isStreaming:
        salt = F.floor(F.rand(0) * salts)
    else:
        salt = F.pmod(F.xxhash64(*left.columns), F.lit(salts))
    copies = F.sequence(F.lit(0), F.lit(salts - 1))
    if frequent is not None:
        hot = F.broadcast(frequent.select(*keys).distinct().withColumn(HOT, F.lit(True)))
        left, right = left.join(hot, keys, "left"), right.join(hot, keys, "left")
        # Rows with a null key match nothing, and there may be many of them.
        missing = F.lit(False)
        for key in keys:
            missing = missing | F.col(key).isNull()
        salt = F.when(F.col(HOT) | missing, salt).otherwise(0)
        copies = F.when(F.col(HOT), copies).otherwise(F.array(F.lit(0)))
    spread = left.withColumn(SALT, salt.cast("int")).drop(HOT)
    repeated = right.withColumn(SALT, F.explode(copies)).drop(HOT)
    # Left to its own size estimate, Spark might broadcast all the copies.
    return spread.join(repeated.hint("merge"), [*keys, SALT], how).drop(SALT)
