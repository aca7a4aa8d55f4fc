"""Rasters as rows: tiles of values, their cells, stencils, block statistics and codes.

A tile of w x h values is an array in row-major order. Stencils over a tile are array expressions of its own row, so a
grid of any number of tiles needs no shuffle; statistics across tiles group by cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.binding import bound


def cells(tiles: DataFrame, values: str, keys: list[str], width: int) -> DataFrame:
    """(keys, p, j, i, v) per value of a tile."""
    rows = tiles.select(*keys, F.posexplode(values).alias("p", "v"))
    return rows.select(*keys, "p", F.floor(F.col("p") / width).cast("int").alias("j"), (F.col("p") % width).cast("int").alias("i"), F.col("v").cast("double").alias("v"))


def at(values: Column, j: Column, i: Column, width: int, height: int) -> Column:
    """The value at row j, column i; null outside."""
    inside = (j >= 0) & (j < height) & (i >= 0) & (i < width)
    return F.when(inside, F.get(values, (j * width + i).cast("int")))


def stencil(values: Column, width: int, height: int, work) -> Column:  # noqa: ANN001
    """A tile of ``work(get, j, i)``, where get(dj, di) reads a neighbour. The tile's own expression is made once."""

    def over(v: Column) -> Column:
        def one(_: Column, p: Column) -> Column:
            j, i = F.floor(p / width), p % width
            return work(lambda dj, di: at(v, j + dj, i + di, width, height), j, i)

        return F.transform(v, one)

    return bound(values, over)


def smooth(values: Column, width: int, height: int) -> Column:
    """The 1-2-1 filter in both directions; missing neighbours leave their weight to the others.

    The filter is one pass along the rows and one along the columns, over the values (0 where missing) and over their weights.
    A tile without missing values, the usual one, has the weights of its shape, which are a constant.
    """

    def passes(a: Column) -> Column:
        along = lambda r: F.transform(r, lambda x, p: 2 * x + F.when(p % width == 0, 0.0).otherwise(F.get(r, p - 1)) + F.when(p % width == width - 1, 0.0).otherwise(F.get(r, p + 1)))
        across = lambda r: F.transform(r, lambda x, p: 2 * x + F.coalesce(F.get(r, p - width), F.lit(0.0)) + F.coalesce(F.get(r, p + width), F.lit(0.0)))
        return bound(bound(a, along), across)

    one = lambda k, n: 4.0 - (k == 0) - (k == n - 1)
    shape = F.array(*(F.lit(one(j, height) * one(i, width)) for j in range(height) for i in range(width)))

    def over(v: Column) -> Column:
        weights = F.when(F.exists(v, lambda x: x.isNull()), passes(F.transform(v, lambda x: F.when(x.isNull(), 0.0).otherwise(1.0)))).otherwise(shape)
        return F.zip_with(passes(F.transform(v, lambda x: F.coalesce(x, F.lit(0.0)))), weights, lambda t, w: F.when(w > 0, t / w))

    return bound(values, over)


def gradient(values: Column, width: int, height: int, axis: str) -> Column:
    """Centred differences along "x" or "y" in units of a cell; null at the tile's edges."""

    def work(get, j: Column, i: Column) -> Column:  # noqa: ANN001
        inner = (j > 0) & (j < height - 1) & (i > 0) & (i < width - 1)
        return F.when(inner, (get(0, 1) - get(0, -1)) / 2 if axis == "x" else (get(1, 0) - get(-1, 0)) / 2)

    return stencil(values, width, height, work)


def metric_gradient(values: Column, width: int, height: int, axis: str, south: float, step: float) -> Column:
    """:func:`gradient` per kilometre on a grid of degrees: along "x" a degree shrinks with the cosine of the row's latitude."""
    km = 111.32 * step
    lat = lambda p: south + F.floor(p / width) * step
    return F.transform(gradient(values, width, height, axis), lambda g, p: g / (km * F.cos(F.radians(lat(p)))) if axis == "x" else g / km)


def resampled(values: Column, width: int, y: tuple[float, float, int], x: tuple[float, float, int], height: int) -> Column:
    """The nearest values at another frame's points, row by row: (first, step, count) along each axis in cells; null off the grid."""
    (y0, dy, ny), (x0, dx, nx) = y, x
    near = lambda first, step, k: F.floor(first + step * k + 0.5).cast("int")

    def at(p: Column) -> Column:
        j, i = near(y0, dy, F.floor(p / nx)), near(x0, dx, p % nx)
        return F.when((j >= 0) & (j < height) & (i >= 0) & (i < width), F.get(values, j * width + i))

    return F.transform(F.sequence(F.lit(0), F.lit(ny * nx - 1)), at)


def window_sums(values: Column, width: int, height: int, half: int) -> Column:
    """Sums over (2 half + 1) squares within the tile: along rows first, then the rows' sums along columns."""

    def along(axis: str):  # noqa: ANN202
        def work(get, j: Column, i: Column) -> Column:  # noqa: ANN001
            total = F.lit(0.0)
            for k in range(-half, half + 1):
                total = total + F.coalesce(get(0, k) if axis == "x" else get(k, 0), F.lit(0.0))
            return total

        return work

    return stencil(stencil(values, width, height, along("x")), width, height, along("y"))


def first_argmax(values: Column) -> Column:
    """The place of the first greatest value."""
    return F.array_position(values, F.array_max(values)) - 1


def nearest_index(x: Column, x0: float, step: float, n: int) -> Column:
    """The nearest grid index; null outside the grid."""
    k = F.floor((x - x0) / step + 0.5)
    return F.when((k >= 0) & (k < n), k.cast("int"))


def bilinear(values: Column, y: Column, x: Column, width: int, height: int) -> Column:
    """The value between four neighbours; null where one is missing."""

    def between(v: Column) -> Column:
        j, i = F.floor(y), F.floor(x)
        fy, fx = y - j, x - i
        a, b = at(v, j, i, width, height), at(v, j, F.least(i + 1, F.lit(width - 1)), width, height)
        jn = F.least(j + 1, F.lit(height - 1))
        c, d = at(v, jn, i, width, height), at(v, jn, F.least(i + 1, F.lit(width - 1)), width, height)
        return a * (1 - fy) * (1 - fx) + b * (1 - fy) * fx + c * fy * (1 - fx) + d * fy * fx

    return bound(values, between)
