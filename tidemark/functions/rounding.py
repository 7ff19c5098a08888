"""Rounding of doubles by their exact value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Splits a double into two halves of its digits, so that products of halves are exact.
_SPLIT = float(2**27 + 1)
# From here on the scaled number has no digits behind the point that could be rounded.
_WHOLE = float(2**52)


def rounded(value: Column, decimals: int) -> Column:
    """``value`` rounded to ``decimals``, ties to even.

    What decides is the exact binary value, not its shortest decimal form:
    2.345 lies above the tie and becomes 2.35, 0.285 below and becomes 0.28.
    The product with the power of ten is kept in two doubles, which together
    are exact.
    """
    x = value.cast("double")
    product = x * 10.0**decimals
    return _nearest(x, product, F.floor(product).cast("double"), decimals)


def _nearest(x: Column, product: Column, below: Column, decimals: int) -> Column:
    scale = 10.0**decimals
    high = x * _SPLIT - (x * _SPLIT - x)
    low = x - high
    scale_high = scale * _SPLIT - (scale * _SPLIT - scale)
    scale_low = scale - scale_high
    error = low * scale_low - (((product - high * scale_high) - low * scale_high) - high * scale_low)
    over = product - below - 0.5
    odd = F.pmod(below, F.lit(2.0)) == 1.0
    up = (over > -error) | ((over == -error) & odd)
    nearest = F.when(up, below + 1).otherwise(below) / scale
    return F.when(F.abs(product) < _WHOLE, nearest).otherwise(F.bround(x, decimals))


def with_rounded(df: DataFrame, **figures: tuple[str, int]) -> DataFrame:
    """``df`` with columns rounded as ``rounded`` does it, each from a column's name and the decimals.

    Every step is a projection, so that a figure that is used several times is computed once.
    """
    product = {name: F.col(of).cast("double") * 10.0**n for name, (of, n) in figures.items()}
    scaled = df.select("*", *(column.alias(f"_p_{name}") for name, column in product.items()))
    floored = scaled.select("*", *(F.floor(f"_p_{name}").cast("double").alias(f"_f_{name}") for name in figures))
    nearest = {
        name: _nearest(F.col(of).cast("double"), F.col(f"_p_{name}"), F.col(f"_f_{name}"), n) for name, (of, n) in figures.items()
    }
    return floored.select(*df.columns, *(column.alias(name) for name, column in nearest.items()))
