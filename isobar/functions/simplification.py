"""Simplifying paths and rings: each vertex's significance is found once, after which any tolerance or budget is a filter.

A vertex's significance is the tolerance at which Douglas-Peucker drops it: its distance from the chord that it splits, and
no more than that of the vertices whose split led to it. It never grows from a split to the splits inside it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F


def _distances(x: np.ndarray, y: np.ndarray, at: np.ndarray, lo: np.ndarray, hi: np.ndarray, metric: str) -> np.ndarray:
    """From points ``at`` to the chords from ``lo`` to ``hi``."""
    scale = np.cos(np.radians((y[lo] + y[hi]) / 2)) if metric == "cosine" else 1.0
    dx, dy = (x[hi] - x[lo]) * scale, y[hi] - y[lo]
    px, py = (x[at] - x[lo]) * scale, y[at] - y[lo]
    length, along = np.hypot(dx, dy), px * dx + py * dy
    beside = np.divide(np.abs(dx * py - dy * px), length, out=np.hypot(px, py), where=length > 0)
    if metric == "line":
        return beside
    return np.where(along <= 0, np.hypot(px, py), np.where(along >= length * length, np.hypot(px - dx, py - dy), beside))


def _split_all(x: np.ndarray, y: np.ndarray, fixed: np.ndarray, metric: str) -> np.ndarray:
    """Significances of all points of paths that lie one after the other; ``fixed`` marks at least their ends.

    Every round splits each open chord of every path at its farthest point (the first of equal ones), so that a batch takes as
    many rounds as its deepest path, each an array operation over the points not placed yet.
    """
    done, worth = fixed.copy(), np.where(fixed, np.inf, 0.0)
    while True:
        left = np.flatnonzero(~done)
        if not len(left):
            return worth
        ends = np.flatnonzero(done)
        chord = np.cumsum(done)[left] - 1
        lo, hi = ends[chord], ends[chord + 1]
        d = _distances(x, y, left, lo, hi, metric)
        first = np.flatnonzero(np.r_[True, chord[1:] != chord[:-1]])
        group = np.cumsum(np.r_[False, chord[1:] != chord[:-1]])
        far = np.maximum.reduceat(d, first)
        hits = np.flatnonzero(d == far[group])
        hits = hits[np.r_[True, group[hits][1:] != group[hits][:-1]]]
        worth[left[hits]] = np.minimum(far, np.minimum(worth[lo[first]], worth[hi[first]]))
        done[left[hits]] = True
        done[left[far[group] == 0]] = True


def _significances(paths: pa.Array, metric: str, closed: bool) -> pa.Array:
    n = pc.fill_null(pc.list_value_length(paths), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    points = pc.list_flatten(paths)
    x, y = (points.field(c).to_numpy(zero_copy_only=False).astype(float) for c in ("x", "y"))
    starts = np.r_[0, np.cumsum(n)]
    has = n > 0
    if closed:
        # The first point again after the last; rings of three points or fewer have nothing to give.
        source = np.arange(len(x) + len(n)) - np.repeat(np.arange(len(n)), n + 1)
        begin = starts[:-1] + np.arange(len(n))
        last = begin + n
        source[last[has]] = starts[:-1][has]
        own = np.ones(len(source), bool)
        own[last] = False
        keep = np.ones(len(source), bool)
        keep[last[~has]] = False
        ring = np.repeat(np.arange(len(n)), n + 1)[keep]
        source, own = source[keep], own[keep]
        px, py = x[source], y[source]
        fixed = np.repeat(n <= 3, n + 1)[keep] | ~own
        shift = np.cumsum(keep) - keep
        head = shift[begin[has]]
        fixed[head] = True
        if len(px):
            away = np.hypot(px - px[np.repeat(head, n[has] + 1)], py - py[np.repeat(head, n[has] + 1)])
            farthest = np.maximum.reduceat(away, head)
            at = np.flatnonzero(away == np.repeat(farthest, n[has] + 1))
            fixed[at[np.r_[True, ring[at][1:] != ring[at][:-1]]]] = True
        worth = _split_all(px, py, fixed, metric)[own]
    else:
        fixed = np.zeros(len(x), bool)
        fixed[starts[:-1][has]] = fixed[starts[1:][has] - 1] = True
        worth = _split_all(x, y, fixed, metric)
    return pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(worth), mask=pc.is_null(paths))


def significance(path: Column, metric: str = "segment", closed: bool = False) -> Column:
    """The significance of each point of an array of (x, y), infinite for those that always stay.

    ``metric`` is the distance to the "segment", to the endless "line", or "cosine" for degrees. A path keeps its ends; a closed
    ring, given without its first point again, keeps its first point and the one farthest from it. Coordinates are finite
    numbers; a null path gives null, an empty one none.
    """

    @F.arrow_udf("array<double>")
    def run(paths: pa.Array) -> pa.Array:
        return _significances(paths, metric, closed)

    return run(path)


def above(path: Column, worth: Column, tolerance: Column | float) -> Column:
    """The points of ``path`` whose significance exceeds a tolerance."""
    limit = tolerance if isinstance(tolerance, Column) else F.lit(float(tolerance))
    return F.filter(F.zip_with(path, worth, lambda p, s: F.when(s > limit, p)), lambda p: p.isNotNull())


def simplify(path: Column, tolerance: float, metric: str = "segment") -> Column:
    """Douglas-Peucker of a path."""
    return above(path, significance(path, metric), tolerance)


def rounded_ring(ring: Column) -> Column:
    """Points to one decimal without a neighbour's repeat, the last not the first again; none if fewer than three are left."""
    one = lambda c: F.floor(c * 10 + 0.5) / 10
    points = F.transform(ring, lambda p: F.struct(one(p["x"]).alias("x"), one(p["y"]).alias("y")))
    apart = F.transform(F.array(points), lambda a: F.filter(a, lambda p, i: (i == 0) | (p != F.get(a, i - 1))))
    opened = F.transform(apart, lambda a: F.slice(a, F.lit(1), F.size(a) - F.when((F.size(a) > 1) & (F.get(a, F.size(a) - 1) == F.get(a, F.lit(0))), 1).otherwise(0)))
    return F.get(F.transform(opened, lambda a: F.when(F.size(a) >= 3, a).otherwise(F.slice(a, 1, 0))), F.lit(0))
