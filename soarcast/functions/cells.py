"""Integer cell ids: a position as one bigint on a Z-order curve.

Latitude and longitude are indexed on a lattice of ``2**-21`` degrees (about 5 cm) and their
bits interleaved. Every grid whose step is a multiple of that (0.25, 0.5, 1 degree) lies on the
lattice exactly; other positions take the nearest lattice point, so two of them share an id only
when they are closer than a step. Ids that are near on the curve are near on the map: sorting by
id keeps neighbouring cells in one file, and a box is a few ranges of ids (``box_ranges``).

No position is without an id: NULL, NaN and values beyond the domain (|latitude| > 255,
|longitude| > 500, which no grid uses) have codes of their own for each coordinate, so grouping by
id equals grouping by the coordinates. ``-0.0`` and ``0.0`` are one position. Longitudes are taken
as they come: 190 and -170 are different cells, as they are different coordinates.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: lattice points per degree, and bits of an index
LATTICE_BITS, INDEX_BITS = 21, 31
LATTICE = 1 << LATTICE_BITS
_LATITUDE, _LONGITUDE = (256, 255), (512, 500)  # offset in degrees, largest absolute value
_NULL, _NAN, _ABOVE, _BELOW = ((1 << INDEX_BITS) - 1 - k for k in range(4))
#: the bits of four-bit numbers, spread to every second place
_SPREAD = [sum((i >> b & 1) << 2 * b for b in range(4)) for i in range(16)]

CELL = "cell_id"


def _index(c: Column, offset: int, limit: int) -> Column:
    c = c.cast("double")
    return (
        F.when(c.isNull(), F.lit(_NULL)).when(F.isnan(c), F.lit(_NAN)).when(c > limit, F.lit(_ABOVE)).when(c < -limit, F.lit(_BELOW))
        .otherwise(F.floor((c + offset) * LATTICE + 0.5))
        .cast("bigint")
    )


def _spread(index: Column) -> Column:
    """The bits of an index at every second place, four at a time by a small table."""
    table = F.lit(_SPREAD).cast("array<bigint>")
    parts = [F.shiftleft(F.get(table, F.shiftright(index, 4 * k).bitwiseAND(F.lit(15)).cast("int")), 8 * k) for k in range(8)]
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def cell_id(lat: str = "latitude", lon: str = "longitude") -> Column:
    """The id of a position as bigint."""
    return F.shiftleft(_spread(_index(F.col(lat), *_LATITUDE)), 1).bitwiseOR(_spread(_index(F.col(lon), *_LONGITUDE)))


def add_cell_id(df: DataFrame, lat: str = "latitude", lon: str = "longitude", name: str = CELL) -> DataFrame:
    """``df`` with the id of its position as column ``name`` (replaced if there is one)."""
    return df.withColumn(name, cell_id(lat, lon))


def with_cell_id(df: DataFrame) -> DataFrame:
    """``df`` with a ``cell_id``: the one it has, else made from its position."""
    return df if CELL in df.columns else add_cell_id(df)


def position(col: str) -> Column:
    """A coordinate of a group of rows with one cell id (``-0.0`` as ``0.0``)."""
    return (F.min(col) + F.lit(0.0)).alias(col)


def _encode(ilat: int, ilon: int) -> int:
    return sum((ilat >> b & 1) << 2 * b + 1 | (ilon >> b & 1) << 2 * b for b in range(INDEX_BITS))


def box_ranges(south: float, west: float, north: float, east: float, most: int = 32) -> list[tuple[int, int]]:
    """At most ``most`` ranges of ids, both ends included, that cover a box of positions.

    Quadrants of the curve that lie inside the box are taken whole; those on its border are cut
    into four as long as the number of ranges allows, the largest first, and taken whole after.
    """
    if not (-_LATITUDE[1] <= south <= north <= _LATITUDE[1] and -_LONGITUDE[1] <= west <= east <= _LONGITUDE[1]):
        raise ValueError("a box needs south <= north within 255 degrees and west <= east within 500 degrees")
    at = lambda value, offset: int((value + offset) * LATTICE + 0.5)
    lo, hi = (at(south, _LATITUDE[0]), at(west, _LONGITUDE[0])), (at(north, _LATITUDE[0]), at(east, _LONGITUDE[0]))
    inside, border = [], [(INDEX_BITS, 0, 0)]
    while border and len(inside) + len(border) + 3 <= most:
        bits, a, o = border.pop(0)  # in order of size
        half = 1 << bits - 1
        for x, y in ((a, o), (a, o + half), (a + half, o), (a + half, o + half)):
            if x > hi[0] or y > hi[1] or x + half <= lo[0] or y + half <= lo[1]:
                continue
            whole = x >= lo[0] and y >= lo[1] and x + half - 1 <= hi[0] and y + half - 1 <= hi[1]
            (inside if whole or bits == 1 else border).append((bits - 1, x, y))
    ranges = sorted((_encode(x, y), _encode(x, y) + (1 << 2 * bits) - 1) for bits, x, y in inside + border)
    merged = [list(ranges[0])]
    for start, end in ranges[1:]:
        if start == merged[-1][1] + 1:
            merged[-1][1] = end
        else:
            merged.append([start, end])
    return [(s, e) for s, e in merged]
