"""Near locations: all pairs of places within a distance, by a grid join.

Coordinates become points of the unit sphere in three dimensions, where two
places within a distance are within a chord of each other; a grid of cubes with
that chord as side needs no special case at the poles or the date line.  Places
are joined on their cube, each visiting the half of its 26 neighbours that comes
after it, so a pair meets once; the exact great-circle distance decides.

Rows of one place (equal coordinates) are one place with a count first, combined
in the map tasks, so copies never multiply.  Cubes that hold many places are
split: the places that stay are dealt into blocks and the visitors go to every
block, so no task holds a whole cube.
"""

from __future__ import annotations

import math
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_METRES = 6_371_000.0
#: Places of a cube that one task joins.
BLOCK_PLACES = 4096
_SHIFTS = [s for s in product((-1, 0, 1), repeat=3) if s > (0, 0, 0)]


def places(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """``(place, lat, lon, rows)``: distinct coordinates with their row counts.

    Degrees; longitudes are taken modulo 360, and all longitudes of a pole are one
    place.  Rows without a latitude from -90 to 90 or without a finite longitude
    are no places."""
    la, lo = F.col(f"`{lat}`").cast("double"), F.col(f"`{lon}`").cast("double")
    good = df.where(la.between(-90, 90) & (F.abs(lo) < 1e6)).select(la.alias("lat"), lo.alias("lon"))
    around = F.when(F.abs("lat") == 90, F.lit(0.0)).otherwise(F.pmod(F.col("lon") + 180, F.lit(360.0)) - 180)
    found = good.select("lat", around.alias("lon")).groupBy("lat", "lon").agg(F.count(F.lit(1)).alias("rows"))
    return found.select(F.xxhash64("lat", "lon").alias("place"), "lat", "lon", "rows")


def metres(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    """Great-circle distance (haversine)."""
    a, b = F.radians(lat_a), F.radians(lat_b)
    h = (F.pow(F.sin((b - a) / 2), F.lit(2))
         + F.cos(a) * F.cos(b) * F.pow(F.sin(F.radians(lon_b - lon_a) / 2), F.lit(2)))
    return F.lit(2 * EARTH_METRES) * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def near_locations(df: DataFrame, lat: str, lon: str, distance: float) -> DataFrame:
    """``(lat, lon, rows, near_lat, near_lon, near_rows, metres)``: every pair of
    distinct places at most ``distance`` metres apart, once (the place with the
    smaller coordinates first), and the rows of both.  Rows at the same place are
    counted in ``rows``."""
    # a hair more than the chord, so that rounding puts no pair outside its cubes
    side = 2 * math.sin(min(distance / (2 * EARTH_METRES), math.pi / 2)) * (1 + 1e-9) + 1e-12
    found = places(df, lat, lon)
    la, lo = F.radians("lat"), F.radians("lon")
    axis = [F.cos(la) * F.cos(lo), F.cos(la) * F.sin(lo), F.sin(la)]
    cubes = found.select("*", *[F.floor(x / F.lit(side)).alias(n) for x, n in zip(axis, ("x", "y", "z"), strict=True)]).checkpoint()
    # blocks of the crowded cubes: at most places / BLOCK_PLACES of them, joined like any table
    crowded = (cubes.groupBy("x", "y", "z").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK_PLACES)
               .select("x", "y", "z", F.ceil(F.col("n") / BLOCK_PLACES).cast("int").alias("blocks")))

    def blocked(rows: DataFrame) -> DataFrame:
        return rows.join(crowded, ["x", "y", "z"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))

    home = blocked(cubes).select("x", "y", "z", F.pmod("place", F.col("blocks")).cast("int").alias("block"),
                                 *[F.col(c).alias(f"a_{c}") for c in ("place", "lat", "lon", "rows")])
    shifts = F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(s, ("x", "y", "z"), strict=True)])
                       for s in [(0, 0, 0), *_SHIFTS]])
    out = cubes.select("place", "lat", "lon", "rows", "x", "y", "z", F.explode(shifts).alias("s"))
    same = (F.col("s.x") == 0) & (F.col("s.y") == 0) & (F.col("s.z") == 0)
    visits = blocked(out.select("place", "lat", "lon", "rows", same.alias("same"), *[(F.col(n) + F.col(f"s.{n}")).alias(n) for n in ("x", "y", "z")]))
    visits = visits.select("x", "y", "z", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
                           "same",
                           *[F.col(c).alias(f"b_{c}") for c in ("place", "lat", "lon", "rows")])
    pairs = home.join(visits, ["x", "y", "z", "block"])
    first = F.struct("a_lat", "a_lon") < F.struct("b_lat", "b_lon")
    gap = metres(F.col("a_lat"), F.col("a_lon"), F.col("b_lat"), F.col("b_lon"))
    pairs = pairs.where(~F.col("same") | first).withColumn("metres", gap).where(F.col("metres") <= distance)

    def of(c: str, swap: bool) -> Column:
        return F.when(first, F.col(f"{'b' if swap else 'a'}_{c}")).otherwise(F.col(f"{'a' if swap else 'b'}_{c}"))

    return pairs.select(*[of(c, False).alias(c) for c in ("lat", "lon", "rows")],
                        *[of(c, True).alias(f"near_{c}") for c in ("lat", "lon", "rows")], "metres")
