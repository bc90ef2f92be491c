"""Cells of a cube around the Earth, each split into four from level to level, and what a circle covers.

The six faces of the cube are level 0. Within a face a place is given by two angles, so that cells of a
level are of much the same size everywhere, also at the poles and where longitudes meet. A circle is
covered by cells about as wide as its radius, of which those at the rim are split twice: large cells
inside, small ones at the edge, some dozens for any radius.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitescout.functions.geo import EARTH_KM

FACES, DEEPEST = 6, 25
#: Levels between the cells that a covering starts with and its smallest.
RIM_LEVELS = 2
_QUARTER, _HALF = math.pi / 4, math.pi / 2
#: A cell reaches at most this part of its width from its middle, the most where three faces meet.
_REACH = 0.8166
#: Added to radii, in radians (about 60 cm), against rounding in distances.
_MARGIN = 1e-7


def unit_vector(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    phi, lam = F.radians(lat), F.radians(lon)
    return F.cos(phi) * F.cos(lam), F.cos(phi) * F.sin(lam), F.sin(phi)


def width(level: Column) -> Column:
    """Width of a cell in radians, seen from the middle of the Earth."""
    return F.lit(_HALF) / F.pow(F.lit(2.0), level)


def reach(level: Column) -> Column:
    """How far a cell reaches from its middle at most, in radians."""
    return width(level) * _REACH


def cell_id(face: Column, level: Column, i: Column, j: Column) -> Column:
    """A number for a cell; cells of different levels have different numbers."""
    high = F.shiftleft((level * FACES + face).cast("long"), 2 * DEEPEST + 2)
    return high.bitwiseOR(F.shiftleft(i.cast("long"), DEEPEST + 1)).bitwiseOR(j.cast("long"))


def _framed(xyz: tuple[Column, ...], face: int) -> tuple[Column, Column, Column]:
    """A vector's part towards the middle of a face, and its parts along the face."""
    axis, sign = face // 2, 1.0 if face % 2 == 0 else -1.0
    return xyz[axis] * sign, xyz[(axis + 1) % 3], xyz[(axis + 2) % 3]


def place(lat: Column, lon: Column) -> Column:
    """Struct (face, i, j) of the deepest cell a point lies in."""
    xyz = unit_vector(lat, lon)
    frames = F.array(*[
        F.struct(*[c.alias(n) for c, n in zip((towards, F.lit(face), first, second), ("towards", "face", "first", "second"))])
        for face in range(FACES) for towards, first, second in [_framed(xyz, face)]
    ])

    def number(along: Column, towards: Column) -> Column:
        at = F.floor((F.atan2(along, towards) + _QUARTER) / _HALF * 2.0**DEEPEST)
        return F.greatest(F.lit(0), F.least(at, F.lit((1 << DEEPEST) - 1))).cast("long")

    def in_face(f: Column) -> Column:
        numbers = (number(f[c], f["towards"]).alias(n) for c, n in (("first", "i"), ("second", "j")))
        return F.struct(f["face"].alias("face"), *numbers)

    # a lambda for one element, so that the frame is worked out once
    return F.transform(F.array(F.array_max(frames)), in_face)[0]


def ancestors(at: Column, levels: list[int]) -> Column:
    """Array of the cells of these levels that a ``place`` lies in."""
    if not levels:
        return F.array().cast("array<bigint>")
    return F.transform(F.array(at), lambda a: F.array(*[ancestor(a, level) for level in levels]))[0]


def ancestor(at: Column, level: int) -> Column:
    """The cell of a level that a ``place`` lies in."""
    shift = DEEPEST - level
    return cell_id(at["face"], F.lit(level), F.shiftright(at["i"], shift), F.shiftright(at["j"], shift))


def middle_distance(framed: tuple[Column, ...], level: Column, i: Column, j: Column) -> Column:
    """Angle between a vector, given by its parts in the frame of a face, and the middle of a cell there."""
    towards, first, second = framed
    scale = F.pow(F.lit(2.0), level)
    a, b = (F.tan((n + 0.5) / scale * _HALF - _QUARTER) for n in (i, j))
    cosine = (towards + first * a + second * b) / F.sqrt(1 + a * a + b * b)
    return F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine)))


def first_level(km: Column) -> Column:
    """The level whose cells are one to two radii wide, within what there is."""
    wanted = F.floor(F.log2(F.lit(_HALF * EARTH_KM) / km))
    return F.greatest(F.lit(0), F.least(wanted, F.lit(DEEPEST - 1 - RIM_LEVELS))).cast("int")


_FRAME = ("_face", "_towards", "_first", "_second")


def with_covering(
    circles: DataFrame, lat: str = "lat", lon: str = "lon", km: str = "km", rim_levels: int = RIM_LEVELS
) -> DataFrame:
    """The circles with ``level`` and ``cell``, on one row for each cell of their covering.

    The cells of a circle hold the whole of it. They are of ``first_level``, given as ``level``, and the
    next ``rim_levels`` levels, and none lies in another, so a place within the circle is in exactly one.
    Cells are made, tested and split as rows, so that all of it runs as compiled code.
    """
    xyz = unit_vector(F.col(lat), F.col(lon))
    frames = [F.struct(F.lit(f), *_framed(xyz, f)) for f in range(FACES)]
    framed = circles.select(
        "*", first_level(F.col(km)).alias("level"), (F.col(km) / EARTH_KM + _MARGIN).alias("_radius"),
        F.inline(F.array(*frames)).alias(*_FRAME),
    )
    level, radius, framing = F.col("_level"), F.col("_radius"), tuple(F.col(c) for c in _FRAME[1:])
    cells = framed.withColumn("_level", F.col("level"))
    for name, along in zip(("_i", "_j"), framing[1:]):
        # places of one angle are a half circle between the ends of the third axis
        from_axis = F.sqrt(framing[0] * framing[0] + along * along)
        half = F.when((radius >= _HALF) | (F.sin(radius) >= from_axis), F.lit(math.pi)).otherwise(
            F.asin(F.least(F.lit(1.0), F.try_divide(F.sin(radius), from_axis))) + _MARGIN
        )
        cells = cells.withColumns({"_at": F.atan2(along, framing[0]), "_half": half})
        low, high = F.greatest(F.col("_at") - F.col("_half"), F.lit(-_QUARTER)), F.least(F.col("_at") + F.col("_half"), F.lit(_QUARTER))
        cells = cells.withColumns({"_low": low, "_high": high}).where("_low <= _high")
        scale = F.pow(F.lit(2.0), level)
        ends = [F.greatest(F.lit(0), F.least(F.floor((F.col(e) + _QUARTER) / _HALF * scale), scale - 1)).cast("long") for e in ("_low", "_high")]
        cells = cells.withColumn(name, F.explode(F.sequence(*ends))).drop("_at", "_half", "_low", "_high")

    def touching(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("_apart", middle_distance(framing, level, F.col("_i"), F.col("_j")))
        return rows.where(F.col("_apart") - reach(level) <= radius)

    cells = touching(cells)
    for step in range(rim_levels):
        i, j = F.col("_i"), F.col("_j")
        is_split = (level == F.col("level") + step) & (F.col("_apart") + reach(level) > radius)
        quarters = F.array(*[F.struct((i * 2 + di).alias("i"), (j * 2 + dj).alias("j"), (level + 1).alias("level")) for di in (0, 1) for dj in (0, 1)])
        kept = F.array(F.struct(i.alias("i"), j.alias("j"), level.alias("level")))
        cells = cells.withColumn("_next", F.explode(F.when(is_split, quarters).otherwise(kept)))
        cells = cells.withColumns({"_i": F.col("_next.i"), "_j": F.col("_next.j"), "_level": F.col("_next.level")}).drop("_next")
        cells = touching(cells)
    found = cells.withColumn("cell", cell_id(F.col("_face"), level, F.col("_i"), F.col("_j")))
    return found.select(*circles.columns, "level", "cell")
