"""Quad grid cells as plain column arithmetic.

A cell of level k is the square of side 2**-k degrees with id ix * 2**20 + iy, ix = floor((lon + 180) * 2**k),
iy = floor((lat + 90) * 2**k). Negative levels are coarser than a degree. Everything stays in generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SHIFT = 1 << 20


def cell_of(lon: Column, lat: Column, level: int) -> Column:
    s = F.lit(2.0**level)
    return F.floor((lon + 180) * s).cast("long") * SHIFT + F.floor((lat + 90) * s).cast("long")


def pack(ix: Column, iy: Column) -> Column:
    return ix.cast("long") * SHIFT + iy.cast("long")


def ix_of(cell: Column) -> Column:
    return F.floor(cell / SHIFT).cast("long")


def iy_of(cell: Column) -> Column:
    return F.pmod(cell, F.lit(SHIFT)).cast("long")


def parent(cell: Column, levels: int = 1) -> Column:
    """The cell that many levels up; each has four children a level."""
    d = 1 << levels
    return pack(F.floor(ix_of(cell) / d), F.floor(iy_of(cell) / d))


def lon_of(cell: Column, level: int) -> Column:
    """Longitude of a cell's centre."""
    return (ix_of(cell) + 0.5) / F.lit(2.0**level) - 180


def lat_of(cell: Column, level: int) -> Column:
    return (iy_of(cell) + 0.5) / F.lit(2.0**level) - 90


def neighbours(cell: Column, k: int = 1, diagonal: bool = True) -> Column:
    """Array of the cells at most k steps away, without the cell itself."""
    steps = [(dx, dy) for dx in range(-k, k + 1) for dy in range(-k, k + 1) if (dx or dy) and (diagonal or abs(dx) + abs(dy) <= k)]
    return F.array(*[cell + F.lit(dx * SHIFT + dy) for dx, dy in steps])


def disk(cell: Column, k: int = 1) -> Column:
    return F.concat(F.array(cell), neighbours(cell, k))


def cells_in_box(west: Column, south: Column, east: Column, north: Column, level: int) -> Column:
    """Array of the cells that a box touches."""
    s = F.lit(2.0**level)
    xs = F.sequence(F.floor((west + 180) * s).cast("long"), F.floor((east + 180) * s).cast("long"))
    ys = F.sequence(F.floor((south + 90) * s).cast("long"), F.floor((north + 90) * s).cast("long"))
    return F.flatten(F.transform(xs, lambda x: F.transform(ys, lambda y: pack(x, y))))


def to_hex(cell: Column) -> Column:
    return F.lower(F.hex(cell))


def from_hex(text: Column) -> Column:
    return F.conv(text, 16, 10).cast("long")


def borders(cell: Column) -> Column:
    """The four sides of a cell as (ix, iy, upright): the corner at their lower left end, and whether they go north."""
    x, y = ix_of(cell), iy_of(cell)
    side = lambda dx, dy, up: F.struct((x + dx).alias("ix"), (y + dy).alias("iy"), F.lit(up).alias("upright"))
    return F.array(side(0, 0, False), side(0, 1, False), side(0, 0, True), side(1, 0, True))
