"""What a satellite above the equator sees: scan angles as expressions, and the seen columns of a grid's rows as runs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Kilometres: the Earth as a sphere, and a geostationary orbit from its centre.
EARTH, ORBIT = 6371.0, 42164.0


def scan_angles(lat: Column, lon: Column, under: float = 0.0) -> tuple[Column, Column]:
    """Degrees east and north at which a place is seen from above the equator at longitude ``under``."""
    p, t = F.radians(lat), F.radians(lon - under)
    dx, dy, dz = EARTH * F.cos(p) * F.cos(t) - ORBIT, EARTH * F.cos(p) * F.sin(t), EARTH * F.sin(p)
    return F.degrees(F.atan2(dy, -dx)), F.degrees(F.atan2(dz, F.hypot(dx, dy)))


def on_disk(lat: Column, lon: Column, under: float = 0.0) -> Column:
    """Whether the place lies on the half of the Earth that is seen."""
    return F.cos(F.radians(lat)) * F.cos(F.radians(lon - under)) > EARTH / ORBIT


@dataclass(frozen=True)
class View:
    """A field of view: a box in degrees, the visible disk, and a band of scan angles along the diagonal."""

    south: float
    north: float
    west: float
    east: float
    band: float
    under: float = 0.0

    def sees(self, lat: Column, lon: Column) -> Column:
        x, y = scan_angles(lat, lon, self.under)
        within = lat.between(self.south, self.north) & lon.between(self.west, self.east)
        return within & on_disk(lat, lon, self.under) & (F.abs((y - x) / 2**0.5) <= self.band)


@dataclass(frozen=True)
class Grid:
    """Cells of ``step`` degrees from the south-west corner."""

    lat0: float
    lon0: float
    step: float
    nlat: int
    nlon: int

    def row(self, lat: Column) -> Column:
        return F.floor((lat - self.lat0) / self.step).cast("int")

    def column(self, lon: Column) -> Column:
        return F.floor((lon - self.lon0) / self.step).cast("int")


def seen_runs(spark: SparkSession, view: View, grid: Grid) -> DataFrame:
    """(j, first, last): for each row of ``grid`` the runs of columns whose centres ``view`` sees; a few rows for each of the grid's."""
    rows = spark.range(grid.nlat).select(F.col("id").cast("int").alias("j"))
    lat = lambda j: grid.lat0 + (j + 0.5) * grid.step
    lon = lambda i: grid.lon0 + (i + 0.5) * grid.step
    seen = rows.select("j", F.filter(F.sequence(F.lit(0), F.lit(grid.nlon - 1)), lambda i: view.sees(lat(F.col("j")), lon(i))).alias("s"))
    # A run begins where the column before isn't seen and ends where the next one isn't: the k-th begin belongs to the k-th end.
    begins = F.filter("s", lambda i, k: (k == 0) | (F.get("s", k - 1) != i - 1))
    ends = F.filter("s", lambda i, k: (k == F.size("s") - 1) | (F.get("s", k + 1) != i + 1))
    runs = seen.select("j", F.explode(F.arrays_zip(begins.alias("first"), ends.alias("last"))).alias("r"))
    return runs.select("j", F.col("r.first").alias("first"), F.col("r.last").alias("last"))


def with_seen(points: DataFrame, lat: str, lon: str, view: View, grid: Grid, into: str = "seen") -> DataFrame:
    """``points`` with whether the cell that holds them is seen; places off the grid and null places aren't.

    The runs are at most a few for each row of the grid, so that they go to every task; no table of cells is made.
    """
    by_row = seen_runs(points.sparkSession, view, grid).groupBy("j").agg(F.collect_list(F.struct("first", "last")).alias("_runs"))
    placed = points.withColumn("_j", grid.row(F.col(lat))).withColumn("_i", grid.column(F.col(lon)))
    found = placed.join(F.broadcast(by_row), placed["_j"] == by_row["j"], "left")
    seen = F.coalesce(F.exists("_runs", lambda r: F.col("_i").between(r["first"], r["last"])), F.lit(False))
    return found.select(*points.columns, seen.alias(into))
