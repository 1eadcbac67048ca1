"""Order-preserving binning of doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# |ln x| of every finite non-zero double lies below this.
_LN_BOUND = 746


def bin_span(per_e_fold: int) -> int:
    """More than the difference of any two bins of :func:`log_bin`."""
    return 4 * _LN_BOUND * per_e_fold + 4


def log_bin(value: Column, per_e_fold: int) -> Column:
    """Map a double to a bigint that never decreases as the value grows.

    Each factor of e is cut into ``per_e_fold`` bins, so a bin spans a relative
    width of about ``1 / per_e_fold`` whatever the scale of the data, and there
    are fewer than ``bin_span(per_e_fold)`` bins. NaN sorts above infinity, as in
    Spark's own ordering; null stays null.
    """
    limit = _LN_BOUND * per_e_fold
    # Clamped so that infinities keep a bin; shifted so that it is positive.
    magnitude = F.floor(F.ln(F.abs(value)) * per_e_fold).cast("double")
    shifted = F.least(magnitude, F.lit(float(limit))) + F.lit(float(limit + 1))
    return (
        F.when(F.isnan(value), F.lit(2 * limit + 2).cast("bigint"))
        .when(value > 0, shifted.cast("bigint"))
        .when(value < 0, -shifted.cast("bigint"))
        .when(value == 0, F.lit(0).cast("bigint"))
    )


def linear_bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Cut ``[low, high]`` evenly; a bigint in ``0..bins`` that never decreases.

    For values of one sign between the bounds; equal bounds give bin 0.
    """
    share = F.try_divide(value - low, high - low)
    return F.coalesce(F.floor(share * bins), F.lit(0))
