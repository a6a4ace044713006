"""Angles in degrees."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _float_mod(x: Column, m: float) -> Column:
    return F.pmod(x, F.lit(m))


def wrap(delta: Column) -> Column:
    """Into [-180, 180): a turn from 350 to 10 is 20."""
    return _float_mod(delta + 180.0, 360.0) - 180.0


def unwrap_step(step: Column) -> Column:
    """Correction to add after a jump of ``step`` so that no step exceeds half a turn.

    A jump of exactly +180 stays +180 rather than becoming -180.
    """
    wrapped = wrap(step)
    wrapped = F.when((wrapped == -180.0) & (step > 0), F.lit(180.0)).otherwise(wrapped)
    return F.when(F.abs(step) < 180.0, F.lit(0.0)).otherwise(wrapped - step)


def azimuth(along: Column, depth: Column) -> Column:
    return F.degrees(F.atan2(depth, along))


def within(error: Column, tolerance: float = 30.0) -> Column:
    return F.abs(error) <= tolerance
