"""Six-character geohash cells as native expressions.

Jobs group by the cell *number* (one integer) and spell the geohash out only for
the rows they return.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the geohash alphabet.
_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"

# The alphabet rearranged for lookup by axis. A character interleaves three bits of
# one axis with two of the other; entry 4 * three + two has them unmixed.
_BY_AXIS = "".join(
    _ALPHABET[(a & 4) << 2 | (b & 2) << 2 | (a & 2) << 1 | (b & 1) << 1 | (a & 1)]
    for a in range(8)
    for b in range(4)
)

_BITS = 15
_HALF = 1 << (_BITS - 1)


def cell_number(latitude: Column, longitude: Column) -> Column:
    """Cell of a point: 15 longitude bits, then 15 latitude bits; null if either is null.

    A point on a boundary belongs to the lower cell, points beyond the range to
    the outermost cell, NaN to the lowest.
    """
    lon = _axis_index(longitude, 180)
    lat = _axis_index(latitude, 90)
    return F.when(latitude.isNotNull() & longitude.isNotNull(), lon * (1 << _BITS) + lat)


def _axis_index(value: Column, bound: int) -> Column:
    # 2**15 cells over [-bound, bound] are 45/2**n degrees wide, so scaling by 2**n
    # is exact and ceil(x / 45) == ceil(ceil(x) / 45) makes the division exact too.
    scale = float(45 * _HALF // bound)
    upper_edge = F.ceil(F.ceil(F.nanvl(value, F.lit(float(-bound))) * scale) / F.lit(45.0))
    index = upper_edge + F.lit(_HALF - 1)
    return F.greatest(F.lit(0), F.least(F.lit((1 << _BITS) - 1), index)).cast("int")


def geohash(cell: Column) -> Column:
    """Spell out a cell number."""
    axes = [F.shiftright(cell, _BITS), cell.bitwiseAND((1 << _BITS) - 1)]
    characters = []
    for left in range(_BITS, 0, -5):
        # Ten bits of geohash, five of each axis, make two characters: the first
        # leads with three longitude bits, the second with three latitude bits.
        characters.append(_character(axes[0], left - 3, axes[1], left - 2))
        characters.append(_character(axes[1], left - 5, axes[0], left - 5))
    return F.concat(*characters)


def _character(major: Column, major_shift: int, minor: Column, minor_shift: int) -> Column:
    three = F.shiftright(major, major_shift).bitwiseAND(7)
    two = F.shiftright(minor, minor_shift).bitwiseAND(3)
    return F.substring(F.lit(_BY_AXIS), three * 4 + two + 1, F.lit(1))
