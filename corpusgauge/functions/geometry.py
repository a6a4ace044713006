"""Cameras, projection, axis conversion and rotations as column arithmetic."""

from __future__ import annotations

import math
from itertools import permutations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusgauge.functions.vectors import cross, inner, minus

# The camera grid, in degrees and in multiples of the derived radius.
GRID_AZIMUTHS = (0, 45, 90, 135, 180, 225, 270, 315)
GRID_ELEVATIONS = (-30, 0, 30, 60)
GRID_DISTANCES = (0.6, 1.0, 1.8)
# Keypoint states.
OUT_OF_FRAME, OCCLUDED, VISIBLE = 0, 1, 2


def camera_radius(fov_deg: float, distance: Column | float = 1.0) -> Column:
    """Radius at which a unit cube fills the field of view, times ``distance``."""
    return F.lit(math.sqrt(3) / 2 / math.sin(math.radians(fov_deg) / 2)) * distance


def camera_eye(yaw: Column, pitch: Column, radius: Column) -> tuple[Column, Column, Column]:
    """Eye position for yaw and pitch in radians."""
    return (
        F.cos(yaw) * F.cos(pitch) * radius,
        F.sin(yaw) * F.cos(pitch) * radius,
        F.sin(pitch) * radius,
    )


def radical_inverse_2(i: Column) -> Column:
    """Binary digits of ``i`` mirrored about the point."""
    bits = F.split(F.reverse(F.bin(i)), "")
    weighted = F.transform(bits, lambda b, k: b.cast("double") * F.pow(F.lit(0.5), k + 1))
    return F.aggregate(weighted, F.lit(0.0), lambda acc, x: acc + x)


def sphere_point(i: Column, n: Column) -> tuple[Column, Column]:
    """Yaw and pitch (radians) of member ``i`` of the ``n``-point low-discrepancy sequence."""
    share = i / n
    u = F.when(share < 0.25, 2 * share).otherwise(share * 2 / 3 + F.lit(1.0) / 3)
    return radical_inverse_2(i) * (2 * math.pi), F.acos(1 - 2 * u) - math.pi / 2


def camera_frame(point: tuple, eye: tuple) -> tuple[Column, Column, Column]:
    """Right, up and depth of ``point`` for a camera at ``eye`` looking at the origin, Z up."""
    length = F.sqrt(inner(eye, eye))
    forward = tuple(-c / length for c in eye)
    side = cross(forward, (F.lit(0.0), F.lit(0.0), F.lit(1.0)))
    width = F.sqrt(inner(side, side))
    side = tuple(c / width for c in side)
    upward = cross(side, forward)
    rel = minus(point, eye)
    return inner(side, rel), inner(upward, rel), inner(forward, rel)


def project(
    right: Column, up: Column, depth: Column, fov_deg: float, width: int, height: int
) -> tuple[Column, Column, Column]:
    """Pixel x, pixel y and in-frame flag of a camera-space point."""
    f = 1.0 / math.tan(math.radians(fov_deg) * 0.5)
    safe = F.nullif(depth, F.lit(0.0))
    px = (F.lit(f * height / width) * right / safe * 0.5 + 0.5) * width
    py = (F.lit(0.5) - F.lit(f) * up / safe * 0.5) * height
    seen = (px >= 0) & (px < width) & (py >= 0) & (py < height) & (depth > 0)
    return px, py, F.coalesce(seen, F.lit(False))


def y_up_cm_to_z_up_m(x: Column, y: Column, z: Column) -> tuple[Column, Column, Column]:
    return x / 100.0, -z / 100.0, y / 100.0


def rotate(point: tuple, degrees: tuple, order: str) -> tuple[Column, Column, Column]:
    """``point`` turned by intrinsic Euler angles (rx, ry, rz), composed in the declared order."""
    x, y, z = point
    turn = dict(zip("xyz", (F.radians(a) for a in degrees)))
    for axis in reversed(order):  # the last declared rotation acts on the point first
        c, s = F.cos(turn[axis]), F.sin(turn[axis])
        if axis == "x":
            y, z = c * y - s * z, s * y + c * z
        elif axis == "y":
            x, z = c * x + s * z, c * z - s * x
        else:
            x, y = c * x - s * y, s * x + c * y
    return x, y, z


def rotate_by(point: tuple, degrees: tuple, order: Column) -> tuple[Column, Column, Column]:
    """``rotate`` with each row's own order, as clips declare it per joint. An order that is no selection of
    different axes gives NULL."""
    known = ["".join(p) for n in range(4) for p in permutations("xyz", n)]
    by_order = {name: rotate(point, degrees, name) for name in known}
    pick = lambda i: F.coalesce(*[F.when(order == name, turned[i]) for name, turned in by_order.items()])
    return pick(0), pick(1), pick(2)
