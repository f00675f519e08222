"""Spherical distance, grid cells and point-in-polygon tests."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

KM_PER_DEGREE = 111.111


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Arc length from the spherical law of cosines; the argument is clamped to [-1, 1]."""
    a, b = F.radians(lat1), F.radians(lat2)
    cosine = F.cos(a) * F.cos(b) * F.cos(F.radians(lon1 - lon2)) + F.sin(a) * F.sin(b)
    cosine = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine))
    return F.lit(KM_PER_DEGREE) * F.degrees(F.acos(cosine))


def cell(value: Column, size: float) -> Column:
    """Grid index of a coordinate."""
    return F.floor(value / F.lit(size)).cast("long")


def inside_ring(x: Column, y: Column, ring: Column) -> Column:
    """Even-odd ray cast. ``ring`` is an array of ``struct(x, y)``, not closed."""
    shifted = F.concat(F.slice(ring, 2, F.size(ring) - 1), F.slice(ring, 1, 1))
    edges = F.zip_with(ring, shifted, lambda p, q: F.struct(p.alias("p"), q.alias("q")))

    def crosses(edge: Column) -> Column:
        p, q = edge["p"], edge["q"]
        straddles = (p["y"] > y) != (q["y"] > y)
        at = p["x"] + (y - p["y"]) / (q["y"] - p["y"]) * (q["x"] - p["x"])
        return F.when(straddles, F.when(x < at, 1).otherwise(0)).otherwise(0)

    hits = F.aggregate(edges, F.lit(0), lambda total, e: total + crosses(e))
    return hits % 2 == 1


def _touching(x: np.ndarray, y: np.ndarray, box: tuple[float, float, float, float]) -> np.ndarray:
    """Which edges (start and end in two rows each) meet a closed box, borders included."""
    low_x, low_y, high_x, high_y = box
    near = (x.max(axis=0) >= low_x) & (x.min(axis=0) <= high_x) & (y.max(axis=0) >= low_y) & (y.min(axis=0) <= high_y)
    sides = [(x[1] - x[0]) * (cy - y[0]) - (y[1] - y[0]) * (cx - x[0]) for cx in (low_x, high_x) for cy in (low_y, high_y)]
    return near & (np.min(sides, axis=0) <= 0) & (np.max(sides, axis=0) >= 0)


def ring_cells(ring: list[tuple[float, float]], size: float, most: int = 64, stride: int = 2) -> list[tuple[int, int, int, bool]]:
    """Cells (level, column, row, inner) that cover a ring; a cell of level l is ``size · 2**l`` wide.

    Inner cells lie inside the ring, so a point in one needs no test; the others meet its border. The widest cells that meet
    the border are split into 4**stride first, until more than ``most`` cells would be left or they would be too fine to
    matter. Levels are multiples of ``stride``.
    """
    points = np.array(ring, float)
    if not len(points) or not np.isfinite(points).all():
        return []
    after = np.roll(points, -1, axis=0)
    x, y = np.stack([points[:, 0], after[:, 0]]), np.stack([points[:, 1], after[:, 1]])
    span = max(np.ptp(points[:, 0]), np.ptp(points[:, 1]), size * 1e-6)
    top = math.ceil(math.log2(span / size) / stride) * stride
    lowest = top - 10 * stride

    def boxed(level: int, column: int, row: int) -> tuple[float, float, float, float]:
        wide = size * 2.0**level
        spare = wide * 1e-9  # rounding of a point's own cell
        return column * wide - spare, row * wide - spare, (column + 1) * wide + spare, (row + 1) * wide + spare

    def inside(px: float, py: float) -> bool:
        straddles = (y[0] > py) != (y[1] > py)
        with np.errstate(divide="ignore", invalid="ignore"):
            at = x[0] + (py - y[0]) / (y[1] - y[0]) * (x[1] - x[0])
        return bool((straddles & (px < at)).sum() % 2)

    def placed(level: int, column: int, row: int, edges: np.ndarray) -> tuple[str, np.ndarray]:
        own = edges[_touching(x[:, edges], y[:, edges], boxed(level, column, row))]
        if len(own):
            return "edge", own
        low_x, low_y, high_x, high_y = boxed(level, column, row)
        return ("inner" if inside((low_x + high_x) / 2, (low_y + high_y) / 2) else "out"), own

    inner, border, fine = [], [], []
    wide = size * 2.0**top
    whole = np.arange(x.shape[1])
    for column in range(math.floor(points[:, 0].min() / wide), math.floor(points[:, 0].max() / wide) + 1):
        for row in range(math.floor(points[:, 1].min() / wide), math.floor(points[:, 1].max() / wide) + 1):
            kind, own = placed(top, column, row, whole)
            if kind == "edge":
                border.append((top, column, row, own))
            elif kind == "inner":
                inner.append((top, column, row))
    while border:
        border.sort(key=lambda c: c[0])
        level, column, row, edges = border.pop()
        if level <= lowest:
            fine.append((level, column, row))
            continue
        parts = 1 << stride
        found = [(level - stride, column * parts + i, row * parts + j, *placed(level - stride, column * parts + i, row * parts + j, edges)) for i in range(parts) for j in range(parts)]
        kept = [c for c in found if c[3] != "out"]
        if len(inner) + len(border) + len(fine) + len(kept) > most:
            fine.append((level, column, row))
            continue
        inner += [c[:3] for c in kept if c[3] == "inner"]
        border += [(*c[:3], c[4]) for c in kept if c[3] == "edge"]
    return [(*c, True) for c in inner] + [(*c, False) for c in fine]
