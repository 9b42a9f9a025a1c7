"""Bias-corrected moments from counts, built for small (value, n) histograms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sample_variance(n: Column, s2: Column) -> Column:
    """``s2`` is the sum of squared deviations. NULL below two values."""
    return F.when(n > 1, s2 / (n - 1))


def sample_skewness(n: Column, s2: Column, s3: Column) -> Column:
    """Adjusted Fisher-Pearson skewness; 0 for constants, NULL below three values."""
    g1 = (s3 / n) / F.pow(s2 / n, F.lit(1.5))
    adjusted = g1 * F.sqrt(n * (n - 1)) / (n - 2)
    return F.when(n < 3, F.lit(None).cast("double")).when(s2 == 0, F.lit(0.0)).otherwise(adjusted)


def sample_kurtosis(n: Column, s2: Column, s4: Column) -> Column:
    """Bias-corrected excess kurtosis; 0 for constants, NULL below four values."""
    g2 = (s4 / n) / F.pow(s2 / n, F.lit(2.0)) - 3
    adjusted = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6)
    return F.when(n < 4, F.lit(None).cast("double")).when(s2 == 0, F.lit(0.0)).otherwise(adjusted)
