"""Axes of strong flow: ridge points of a wind field joined to lines, strongest first.

The order of joining matters, so one field is one group. A field's size is fixed by its grid, and fields are independent:
any number of runs and leads spread over tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

LINES = "line int, n int, lat double, lon double, speed double"


@dataclass(frozen=True)
class Options:
    least_speed: float = 80.0
    reach: float = 1.6
    absorb: float = 1.2
    least_km: float = 900.0


def between(a: np.ndarray, y: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Bilinear values; NaN outside."""
    j, i = np.floor(y).astype(int), np.floor(x).astype(int)
    ok = (j >= 0) & (i >= 0) & (j < a.shape[0] - 1) & (i < a.shape[1] - 1)
    j, i = np.where(ok, j, 0), np.where(ok, i, 0)
    fy, fx = y - j, x - i
    v = (a[j, i] * (1 - fx) + a[j, i + 1] * fx) * (1 - fy) + (a[j + 1, i] * (1 - fx) + a[j + 1, i + 1] * fx) * fy
    return np.where(ok, v, np.nan)


class Tracer:
    def __init__(self, u: np.ndarray, v: np.ndarray, speed: np.ndarray, south: float, west: float, step: float, options: Options) -> None:
        self.speed, self.o = speed, options
        self.south, self.west, self.step = south, west, step
        rows = np.maximum(np.cos(np.radians(south + step * np.arange(speed.shape[0]))), 0.2)[:, None]
        size = np.hypot(u / rows, v)
        size = np.where(size > 0, size, 1.0)
        self.along = np.stack([v / size, u / rows / size])
        j, i = np.nonzero(speed[1:-1, 1:-1] >= options.least_speed)
        j, i = j + 1, i + 1
        dy, dx = self.along[:, j, i]
        left, right = between(speed, j + dx, i - dy), between(speed, j - dx, i + dy)
        keep = ~(speed[j, i] < left) & ~(speed[j, i] < right)
        self.ridge = np.zeros(speed.shape, bool)
        self.ridge[j[keep], i[keep]] = True
        self.free = self.ridge.copy()

    def near(self, y: float, x: float, radius: float, among: np.ndarray) -> list[tuple[float, int, int]]:
        """Points of ``among`` within a radius, nearest first, then in order of rows and columns."""
        j0, j1 = max(int(np.floor(y - radius)), 0), min(int(np.ceil(y + radius)), among.shape[0] - 1)
        i0, i1 = max(int(np.floor(x - radius)), 0), min(int(np.ceil(x + radius)), among.shape[1] - 1)
        j, i = np.nonzero(among[j0 : j1 + 1, i0 : i1 + 1])
        found = [(float(np.hypot(a + i0 - x, b + j0 - y)), int(b + j0), int(a + i0)) for b, a in zip(j, i, strict=True)]
        return sorted(p for p in found if p[0] <= radius)

    def take(self, j: int, i: int) -> None:
        """Uses a point up, and its close neighbours, so that no second line runs beside it."""
        for _, b, a in self.near(j, i, self.o.absorb, self.free):
            self.free[b, a] = False
        self.free[j, i] = False

    def follow(self, j: int, i: int, sign: int) -> list[tuple[int, int]]:
        out: list[tuple[int, int]] = []
        while True:
            dy, dx = self.along[:, j, i]
            ahead = self.near(j + sign * dy, i + sign * dx, self.o.reach, self.free)
            if not ahead:
                return out
            _, j, i = ahead[0]
            self.take(j, i)
            out.append((j, i))

    def lines(self) -> list[list[tuple[float, float, float]]]:
        out = []
        j, i = np.nonzero(self.ridge)
        for k in np.argsort(-self.speed[j, i], kind="stable"):
            start = int(j[k]), int(i[k])
            if not self.free[start]:
                continue
            self.take(*start)
            upstream = self.follow(*start, -1)
            path = [*reversed(upstream), start, *self.follow(*start, 1)]
            line = [(self.south + b * self.step, self.west + a * self.step, float(self.speed[b, a])) for b, a in path]
            if path_km(line) >= self.o.least_km:
                out.append(line)
        return out


def path_km(line: list[tuple[float, float, float]]) -> float:
    p = np.array(line)[:, :2]
    middle = np.radians((p[1:, 0] + p[:-1, 0]) / 2)
    return float(np.hypot((p[1:, 1] - p[:-1, 1]) * np.cos(middle), p[1:, 0] - p[:-1, 0]).sum() * 111.2)


def axes(fields: DataFrame, keys: list[str], options: Options = Options()) -> DataFrame:  # noqa: B008
    """(keys, line, n, lat, lon, speed) in flow order, from rows of fields: u, v and speed as row-major arrays with nlat, nlon, south, west and step."""
    kinds = ", ".join(f"`{k}` {fields.schema[k].dataType.simpleString()}" for k in keys)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for f in group.itertuples(index=False):
            shape = (int(f.nlat), int(f.nlon))
            u, v, s = (np.array(getattr(f, c), float).reshape(shape) for c in ("u", "v", "speed"))
            for k, line in enumerate(Tracer(u, v, s, f.south, f.west, f.step, options).lines()):
                rows += [(*[getattr(f, c) for c in keys], k, n, *p) for n, p in enumerate(line)]
        return pd.DataFrame(rows, columns=[*keys, "line", "n", "lat", "lon", "speed"])

    return fields.groupBy(*keys).applyInPandas(run, f"{kinds}, {LINES}")
