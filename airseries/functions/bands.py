"""Band labels, piecewise-linear index, label codes and value groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# PM2.5 bands as (upper bound inclusive, label); None is open-ended.
PM25_BANDS = [
    (12.0, "Good"),
    (35.4, "Moderate"),
    (55.4, "Unhealthy for Sensitive Groups"),
    (150.4, "Unhealthy"),
    (250.4, "Very Unhealthy"),
    (None, "Hazardous"),
]

# Index segments as (upper bound inclusive, intercept, origin, slope).
# The rounded slopes make this index jump down at 150.4; EPA_INDEX does not.
PM25_INDEX = [
    (12.0, 0.0, 0.0, 4.17),
    (35.4, 50.0, 12.0, 2.13),
    (55.4, 100.0, 35.4, 2.5),
    (150.4, 150.0, 55.4, 1.05),
    (250.4, 200.0, 150.4, 0.5),
    (None, 300.0, 250.4, 0.4),
]

# Five-band variant with Spanish labels for raw city readings.
FIVE_BANDS = [
    (12.0, "Bueno"),
    (35.4, "Moderado"),
    (55.4, "Dañino para grupos sensibles"),
    (150.4, "Dañino"),
    (None, "Muy dañino"),
]
FIVE_BAND_INDEX = [
    (12.0, 0.0, 0.0, 4.17),
    (35.4, 50.0, 12.0, 2.13),
    (55.4, 100.0, 35.4, 2.5),
    (150.4, 150.0, 55.4, 1.05),
    (None, 200.0, 150.4, 0.66),
]

# Three coarse classes and their numeric codes.
COARSE_BANDS = [(35.4, "Good"), (55.4, "Moderate"), (None, "Unhealthy")]
COARSE_CODES = {"Good": 0.0, "Moderate": 1.0, "Unhealthy": 2.0}

# Concentration and index breakpoints; the last segment goes on
# with the slope of the table's open band.
_EPA_CONCENTRATION = [0.0, 12.0, 35.4, 55.4, 150.4, 250.4]
_EPA_INDEX = [0.0, 50.0, 100.0, 150.0, 200.0, 300.0]
EPA_OPEN_SLOPE = 0.4


def interpolated_segments(
    concentration: Sequence[float], index: Sequence[float], open_slope: float
) -> list[tuple[float | None, float, float, float]]:
    """Segments that join the given breakpoints by straight lines."""
    joints = list(zip(concentration, index))
    segments: list[tuple[float | None, float, float, float]] = [
        (c1, i0, c0, (i1 - i0) / (c1 - c0)) for (c0, i0), (c1, i1) in zip(joints, joints[1:])
    ]
    segments.append((None, index[-1], concentration[-1], open_slope))
    return segments


EPA_INDEX = interpolated_segments(_EPA_CONCENTRATION, _EPA_INDEX, EPA_OPEN_SLOPE)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _missing(x: Column) -> Column:
    # The cast lets integer columns through; isnan alone accepts only floats.
    return x.isNull() | F.isnan(x.cast("double"))


def band(c: Column | str, bands: Sequence[tuple[float | None, str]] = PM25_BANDS) -> Column:
    """Label of the first band whose upper bound is not below the value; null for null and NaN."""
    x = _col(c)
    chain = F.when(_missing(x), F.lit(None).cast("string"))
    for upper, label in bands:
        if upper is None:
            return chain.otherwise(F.lit(label))
        chain = chain.when(x <= upper, F.lit(label))
    return chain


def piecewise(
    c: Column | str,
    segments: Sequence[tuple[float | None, float, float, float]] = PM25_INDEX,
    cap: float | None = None,
) -> Column:
    """Piecewise-linear value ``intercept + (x - origin) * slope``; null for null and NaN."""
    x = _col(c).cast("double")
    chain = F.when(_missing(x), F.lit(None).cast("double"))
    for upper, intercept, origin, slope in segments:
        value = F.lit(intercept) + (x - F.lit(origin)) * F.lit(slope)
        if cap is not None:
            value = F.least(value, F.lit(float(cap)))
        chain = chain.otherwise(value) if upper is None else chain.when(x <= upper, value)
    return chain


def encode_labels(c: Column | str, codes: Mapping[str, float]) -> Column:
    """Numeric code of a label; null where the label has none."""
    x = _col(c)
    chain = None
    for label, code in codes.items():
        hit, value = x == label, F.lit(float(code))
        chain = F.when(hit, value) if chain is None else chain.when(hit, value)
    return chain if chain is not None else F.lit(None).cast("double")


def group_values(c: Column | str, groups: Mapping[str, Sequence[str]]) -> Column:
    """Name of the first group that holds the value; null where none does."""
    x = _col(c)
    chain = None
    for name, members in groups.items():
        hit = x.isin(*members)
        chain = F.when(hit, F.lit(name)) if chain is None else chain.when(hit, F.lit(name))
    return chain if chain is not None else F.lit(None).cast("string")


# Role groups of the position codes, and their numeric labels.
PLAYER_ROLES = {
    "GK": ["GK"],
    "DEF": ["CB", "LB", "RB", "LWB", "RWB"],
    "MID": ["CDM", "CM", "LM", "RM"],
    "OFF": ["ST", "CF", "CAM", "LW", "RW", "LAM", "RAM", "LF", "RF"],
}
ROLE_CODES = {"GK": 0.0, "DEF": 1.0, "MID": 2.0, "OFF": 3.0}
