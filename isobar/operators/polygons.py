"""Joins with tables of polygons: points in rings with holes, cells covered, areas touched.

A polygon is an array of rings, the first its outline and the others holes; a ring is an array of (x, y).
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructType

from ..functions import geometry as Geo
from ..functions.binding import bound
from .places import HELD, edge_list, held_pairs, meet, usable


def inside(x: Column, y: Column, rings: Column) -> Column:
    """Within the outline and in none of the holes."""
    holes = F.slice(rings, F.lit(2), F.greatest(F.size(rings) - 1, F.lit(0)))
    return (F.size(rings) > 0) & Geo.in_ring(x, y, F.get(rings, F.lit(0))) & ~F.exists(holes, lambda r: Geo.in_ring(x, y, r))


def points_in(points: DataFrame, polygons: DataFrame, *, x: str = "x", y: str = "y", rings: str = "rings", cell: float = 1.0) -> DataFrame:
    """Every pair of a point and a polygon that holds it, with the columns of both except the place and the rings.

    Each polygon is listed once for every square of ``cell`` that its box touches and meets the points of that square, in blocks
    of bounded size that NumPy tests: only pairs that hold are rows. Squares about as large as a usual polygon keep the lists
    short. Points without a place and polygons without an outline are in no pair.
    """
    own, names = points.drop(x, y).columns, polygons.drop(rings).columns
    placed = points.select(*own, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    edges = edge_list(F.filter(rings, lambda r: r.isNotNull()))
    shapes = usable(polygons, rings).select(*names, edges.alias("edges"), Geo.box(F.get(rings, F.lit(0))).alias("_o"))

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        p, q = held_pairs(left, right)
        return pa.table({c: t[c].take(k) for t, columns, k in ((left, own, p), (right, names, q)) for c in columns})

    schema = StructType([*points.select(*own).schema, *polygons.select(*names).schema])
    return meet(placed, shapes, cell, work, schema, polygons_at_once=HELD)


def shifted(rings: Column, by: int) -> Column:
    return F.transform(rings, lambda r: F.transform(r, lambda p: F.struct((p["x"] + by).alias("x"), p["y"].alias("y"))))


def covered_cells(polygons: DataFrame, keys: list[str], *, rings: str = "rings", x0: float, y0: float, step: float, nx: int, ny: int) -> DataFrame:
    """(keys, j, i) for each cell of a grid whose centre a polygon holds, once however many polygons of one key do.

    Only the cells within a polygon's box are made and tested: no cell meets a polygon elsewhere. A polygon that reaches
    beyond 180 degrees also counts one turn further west. Rings of decimals meet centres of decimals (six places).
    """
    places = polygons.schema[rings].dataType
    exact = isinstance(places.elementType.elementType["x"].dataType, DecimalType)
    east = F.exists(F.get(rings, F.lit(0)), lambda p: p["x"] > 180)
    turned = F.when(east, F.array(F.col(rings), shifted(F.col(rings), -360).cast(places))).otherwise(F.array(F.col(rings)))
    copies = polygons.where(F.size(rings) > 0).select(*keys, F.explode(turned).alias("_r")).withColumn("_o", Geo.box(F.get("_r", F.lit(0))))
    place = lambda v, o, n: F.least(F.greatest(F.floor((F.col(v) - o) / step), F.lit(-1)), F.lit(n)).cast("int")
    lists = copies.select(
        *keys, "_r",
        F.greatest(place("_o.s", y0, ny), F.lit(0)).alias("_j0"), F.least(place("_o.n", y0, ny), F.lit(ny - 1)).alias("_j1"),
        F.greatest(place("_o.w", x0, nx), F.lit(0)).alias("_i0"), F.least(place("_o.e", x0, nx), F.lit(nx - 1)).alias("_i1"),
    ).where("_j0 <= _j1 and _i0 <= _i1")
    cells = lists.withColumn("j", F.explode(F.sequence("_j0", "_j1"))).withColumn("i", F.explode(F.sequence("_i0", "_i1")))
    centre = lambda c, o: (o + (F.col(c) + 0.5) * step).cast("decimal(18,6)" if exact else "double")
    return cells.where(inside(centre("i", x0), centre("j", y0), F.col("_r"))).select(*keys, "j", "i").distinct()


def cell_percentages(polygons: DataFrame, samples: DataFrame, *, day: str, sample: str, kind: str, rings: str = "rings", **grid: float) -> DataFrame:
    """(day, kind, j, i, percent): of a day's samples the share in which polygons of a kind cover a cell, rounded, zeros left out.

    ``samples`` lists (day, sample) that were read, those without any polygon too.
    """
    read = samples.select(day, sample).distinct().groupBy(day).agg(F.count("*").alias("_n"))
    hits = covered_cells(polygons, [day, sample, kind], rings=rings, **grid).groupBy(day, kind, "j", "i").agg(F.count("*").alias("_c"))
    shares = hits.join(read, day).withColumn("percent", F.floor(100.0 * F.col("_c") / F.col("_n") + 0.5).cast("int"))
    return shares.where("percent > 0").select(day, kind, "j", "i", "percent")


def touched(ring: Column, areas: list[tuple[str, float, float, float, float]]) -> Column:
    """The names of areas (name, west, south, east, north) that a ring reaches, copies one turn east and west included.

    The areas are a constant array that one expression goes through: what the driver builds doesn't grow with their number, and
    a ring is clipped to the boxes that its own box touches only.
    """
    edge = lambda v: F.lit(float(v))
    copies = [F.struct(F.lit(name).alias("name"), edge(w + t).alias("w"), edge(s).alias("s"), edge(e + t).alias("e"), edge(n).alias("n")) for name, w, s, e, n in areas for t in (0, -360, 360)]

    def names(b: Column) -> Column:
        r, own = b["ring"], b["box"]
        reached = F.filter(b["areas"], lambda a: Geo.boxes_touch(own, a) & (F.size(Geo.clip_to_box(r, a["w"], a["s"], a["e"], a["n"])) >= 3))
        return F.array_distinct(F.transform(reached, lambda a: a["name"]))

    return bound(F.struct(ring.alias("ring"), Geo.box(ring).alias("box"), F.array(*copies).alias("areas")), names)


def area_inside(ring: Column, w: float, s: float, e: float, n: float) -> Column:
    """Square kilometres of a ring within a box, on a local plane at the clipped part's own latitude; 0 outside."""
    part = lambda c: F.when(F.size(c) >= 3, Geo.area_km2(c, Geo.vertex_mean(c)["y"])).otherwise(F.lit(0.0))
    return bound(Geo.clip_to_box(ring, w, s, e, n), part)
