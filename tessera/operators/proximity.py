"""Points near other points, and regions that contain them.

Regions are covered adaptively: a cell that no border crosses and that lies inside is interior and
accepts every point in it by an equi-join alone; a cell that a border crosses is split until it is small
beside the region, and points in what remains get an exact even-odd test. For that a boundary cell holds
the border lines near it; of all lines further east it holds only at which latitudes the parity of their
number changes. Nearness uses the same idea with the disc around a point: the grid is fine enough for
points of one cell always to be near each other, so they are accepted at once; only points in the
cells that the disc's edge may reach are measured.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import cut

EARTH_M = 6_371_000.0  # fixed value: the sphere on which distances are taken
FINE = 12  # cells of the finest level that a region is wide, at least
STEP, FINEST = 2, 22  # levels from one size of cell (360 / 2**level degrees) to the next, and the last one
BROADCAST_BYTES = 32 << 20  # cells are sent to all tasks up to this size, and joined by a shuffle beyond it
SLACK = 1e-9


def usable(lat: Column, lon: Column) -> Column:
    """Both coordinates present, on the globe, and not (0, 0)."""
    return F.coalesce(lat.between(-90, 90) & lon.between(-180, 180) & ~((lat == 0) & (lon == 0)), F.lit(False))


def parse_polygon(text: str | None) -> np.ndarray | None:
    """Corner points of "lat lon,lat lon,..." as an n x 2 array; entries that are not two numbers are skipped; fewer than three points are no polygon."""
    points = []
    for entry in (text or "").split(","):
        parts = entry.split()
        if len(parts) == 2:
            try:
                p = (float(parts[0]), float(parts[1]))
            except ValueError:
                continue
            if all(map(math.isfinite, p)):
                points.append(p)
    return np.array(points) if len(points) >= 3 else None


def edges(polygon: np.ndarray) -> np.ndarray:
    """Border lines as rows (lat1, lon1, lat2, lon2); the last corner is joined to the first."""
    return np.hstack([polygon, np.roll(polygon, -1, axis=0)])


def even_odd(e: np.ndarray, lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    """Whether each point has an odd number of border lines to its east."""
    y1, x1, y2, x2 = (e[:, i][None, :] for i in range(4))
    y, x = lat[:, None], lon[:, None]
    spans = (y1 > y) != (y2 > y)
    with np.errstate(divide="ignore", invalid="ignore"):
        east = x < (x2 - x1) * (y - y1) / (y2 - y1) + x1
    return (spans & east).sum(axis=1) % 2 == 1


def _touched(e: np.ndarray, south: np.ndarray, west: np.ndarray, size: float) -> np.ndarray:
    """Which border lines (columns) may meet which cells (rows): by the bounding box, then by the side of the line on which the corners lie."""
    y1, x1, y2, x2 = (c[None, :] for c in e.T)
    n, east = (south + size + SLACK)[:, None], (west + size + SLACK)[:, None]
    south, west = (south - SLACK)[:, None], (west - SLACK)[:, None]
    box = (np.minimum(y1, y2) <= n) & (np.maximum(y1, y2) >= south) & (np.minimum(x1, x2) <= east) & (np.maximum(x1, x2) >= west)
    side = [(x2 - x1) * (cy - y1) - (y2 - y1) * (cx - x1) for cy, cx in ((south, west), (south, east), (n, west), (n, east))]
    return box & ~(np.minimum.reduce(side) > SLACK) & ~(np.maximum.reduce(side) < -SLACK)


def levels_of(polygon: np.ndarray) -> list[int]:
    """Levels of the cells that cover a polygon, by its size: the finest is small beside it, the coarsest about as large."""
    height, width = np.ptp(polygon, axis=0)
    extent = max(min(height, width), max(height, width) / 8, 360 / 2**FINEST)
    fine = min(FINEST, -STEP * (-math.ceil(math.log2(360 / extent * FINE)) // STEP))
    return [lv for lv in range(fine - 3 * STEP, fine + 1, STEP) if lv >= 0] or [0]


def cover(polygon: np.ndarray) -> Iterator[tuple[int, int, int, np.ndarray | None, bool, np.ndarray | None]]:
    """Cells (level, row, column, lines near it, parity further east, latitudes where that changes); no lines mean an interior cell."""
    e = edges(polygon)
    levels = levels_of(polygon)
    size = 360 / 2 ** levels[0]
    (lat0, lon0), (lat1, lon1) = np.floor((polygon.min(0) + (90, 180)) / size).astype(int), np.floor((polygon.max(0) + (90, 180)) / size).astype(int)
    rows, cols = (x.ravel() for x in np.meshgrid(np.arange(lat0, lat1 + 1), np.arange(lon0, lon1 + 1), indexing="ij"))
    y_low, y_high = np.minimum(e[:, 0], e[:, 2]), np.maximum(e[:, 0], e[:, 2])
    x_low, x_high = np.minimum(e[:, 1], e[:, 3]), np.maximum(e[:, 1], e[:, 3])
    for k, level in enumerate(levels):
        size = 360 / 2**level
        split_r, split_c = [], []
        for i in range(0, len(rows), max(1, (1 << 21) // len(e))):
            r, c = rows[i : i + max(1, (1 << 21) // len(e))], cols[i : i + max(1, (1 << 21) // len(e))]
            south, west = r * size - 90, c * size - 180
            crossed = _touched(e, south, west, size).any(1)
            inside = ~crossed
            inside[inside] = even_odd(e, south[inside] + size / 2, west[inside] + size / 2)
            yield from ((level, a, b, None, False, None) for a, b in zip(r[inside].tolist(), c[inside].tolist()))
            if k + 1 < len(levels):
                split_r.append(r[crossed])
                split_c.append(c[crossed])
                continue
            for a, b, s, w in zip(r[crossed].tolist(), c[crossed].tolist(), south[crossed], west[crossed]):
                n, east = s + size + SLACK, w + size + SLACK
                s, w = s - SLACK, w - SLACK
                near = (y_high >= s) & (y_low <= n) & (x_high >= w) & (x_low <= east)
                # A line wholly to the east counts for latitudes from its lower end up to below its upper end.
                beyond = x_low > east
                ends = np.concatenate([y_low[beyond], y_high[beyond]])
                change, times = np.unique(ends[(ends >= s) & (ends <= n)], return_counts=True)
                yield level, a, b, e[near], bool((ends < s).sum() % 2), change[times % 2 == 1]
        if k + 1 < len(levels):
            f = 2 ** (levels[k + 1] - level)
            r, c = np.concatenate(split_r), np.concatenate(split_c)
            sub_r, sub_c = (x.ravel() for x in np.meshgrid(np.arange(f), np.arange(f), indexing="ij"))
            rows, cols = (r[:, None] * f + sub_r).ravel(), (c[:, None] * f + sub_c).ravel()


def _cell(level: Column | int, row: Column, column: Column) -> Column:
    level = F.lit(level) if isinstance(level, int) else level
    return F.shiftleft(level.cast("long"), 48) + F.shiftleft(row.cast("long"), 24) + column.cast("long")


def region_cells(regions: DataFrame, region: str, polygon: str) -> DataFrame:
    """Cells that cover the regions: ``cell``, ``region_id``, ``lines``, ``odd``, ``changes``; interior cells have no lines."""

    def covers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for rid, text in zip(b["region_id"], b["polygon"]):
                p = parse_polygon(text)
                out = [] if p is None else [((lv << 48) + (r << 24) + c, rid, None if e is None else e.tolist(), odd, None if ch is None else ch.tolist()) for lv, r, c, e, odd, ch in cover(p)]
                yield pd.DataFrame(out, columns=["cell", "region_id", "lines", "odd", "changes"])

    shapes = regions.select(F.col(region).cast("string").alias("region_id"), F.col(polygon).cast("string").alias("polygon")).where("region_id IS NOT NULL AND polygon IS NOT NULL").distinct()
    # Few bytes, but much work: they are not put together into few tasks.
    return shapes.repartition(regions.sparkSession.sparkContext.defaultParallelism).mapInPandas(covers, "cell long, region_id string, lines array<array<double>>, odd boolean, changes array<double>")


def regions_of(points: DataFrame, regions: DataFrame, key: str, lat: str, lon: str, region: str, polygon: str, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Regions that hold each point: distinct rows (``point_key``, ``region_id``).

    Points that are not usable and regions without a polygon are left out; keys may be null-free text
    or numbers and are given as text; a point in several overlapping regions gives a row for each;
    repeated points or regions give one row; empty tables give none. Only the named columns are read.
    The cover is written down and measured; it is sent to all tasks if it is small, and joined by a shuffle otherwise.
    """
    cells = cut(region_cells(regions, region, polygon))
    measured = cells.groupBy(F.shiftright("cell", 48).alias("level")).agg((F.count(F.lit(1)) * 64 + F.sum(F.coalesce(F.size("lines"), F.lit(0)) * 64 + F.coalesce(F.size("changes"), F.lit(0)) * 8)).alias("bytes")).collect()  # one row for each level
    levels = sorted(r["level"] for r in measured)
    place = _places(points, key, lat, lon)
    at = [_cell(lv, F.floor((F.col("lat") + 90) * (2**lv / 360)), F.floor((F.col("lon") + 180) * (2**lv / 360))) for lv in levels]
    small = sum(r["bytes"] or 0 for r in measured) <= broadcast_bytes
    met = place.withColumn("cell", F.explode(F.array(*at) if at else F.array().cast("array<long>"))).join(F.broadcast(cells) if small else cells, "cell")
    y, x = F.col("lat"), F.col("lon")

    def crosses(e: Column) -> Column:
        y1, x1, y2, x2 = e[0], e[1], e[2], e[3]
        return ((y1 > y) != (y2 > y)) & (x < (x2 - x1) * (y - y1) / F.when(y2 == y1, F.lit(1.0)).otherwise(y2 - y1) + x1)

    east = F.size(F.filter("changes", lambda c: c <= y)) + F.col("odd").cast("int")
    odd = (F.size(F.filter("lines", crosses)) + east) % 2 == 1
    return met.where(F.col("lines").isNull() | odd).select("point_key", "region_id").distinct()


def _places(points: DataFrame, key: str, lat: str, lon: str) -> DataFrame:
    y, x = F.col(lat).cast("double"), F.col(lon).cast("double")
    return points.where(usable(y, x)).select(F.col(key).cast("string").alias("point_key"), y.alias("lat"), x.alias("lon")).where("point_key IS NOT NULL")


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.lit(2 * EARTH_M) * F.asin(F.least(F.sqrt(a), F.lit(1.0)))


def near_places(points: DataFrame, key: str, lat: str, lon: str, metres: float) -> tuple[DataFrame, DataFrame]:
    """Nearness without pairs of keys: the keys of each place (``point_key``, ``lat``, ``lon``), and links of different places.

    A place is a point that one or more keys share; links (``lat``, ``lon``, ``lat2``, ``lon2``) are places at most
    ``metres`` apart, each pair once. Points that are not usable or have no key are left out; keys delivered twice
    count once; the date line and the poles need no care by the caller; empty tables give neither.
    """
    keys = cut(_places(points, key, lat, lon).distinct())
    places = keys.select("lat", "lon").distinct()
    # Cell sides of metres / 1.5, so that the diagonal is below metres.
    side = metres / 1.5
    high = math.degrees(side / EARTH_M)  # height of a row
    reach = math.degrees(metres / EARTH_M) * 1.000001
    row_of = lambda y: F.floor((y + 90) / high)

    def columns(row: Column) -> Column:
        """Cells in a row: as many as keep their width at the row's widest latitude below the side."""
        south = row * high - 90
        widest = F.when(south > 0, south).when(south + high < 0, south + high).otherwise(F.lit(0.0))
        return F.greatest(F.lit(1.0), F.ceil(F.cos(F.radians(widest)) * (2 * math.pi * EARTH_M / side)))

    col_of = lambda x, n: F.floor((x + 180) / 360 * n)
    cell = lambda row, col, n: F.shiftleft(row.cast("long"), 32) + F.pmod(col, n).cast("long")
    row = row_of(F.col("lat"))
    n = columns(row)
    home = places.select("lat", "lon", row.alias("row"), n.alias("n"), col_of(F.col("lon"), n).alias("col"))
    homes = home.select(F.col("lat").alias("lat2"), F.col("lon").alias("lon2"), cell(F.col("row"), F.col("col"), F.col("n")).alias("cell"))
    # Each pair is looked for from the southern row, in one row from the western cell.
    steps = math.ceil(reach / high)
    wide = F.when(F.abs("lat") + reach >= 89.9, F.lit(360.0)).otherwise(F.degrees(F.asin(F.least(F.lit(1.0), F.sin(F.lit(math.radians(reach))) / F.cos(F.radians(F.abs(F.col("lat")) + reach))))))

    def probes(k: int) -> Column:
        r = F.col("row") + k
        m = columns(r)
        first = F.col("col") + 1 if k == 0 else col_of(F.col("lon") - wide, m)
        last = F.least(col_of(F.col("lon") + wide, m), first + m - 1)
        return F.transform(F.when(last >= first, F.sequence(first.cast("long"), last.cast("long"))).otherwise(F.array().cast("array<long>")), lambda c: cell(r, c, m))

    probe = home.select("lat", "lon", F.explode(F.concat(*(probes(k) for k in range(steps + 1)))).alias("cell"))
    measured = probe.join(homes, "cell").where(haversine_m(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2")) <= metres)
    own = home.select("lat", "lon", cell(F.col("row"), F.col("col"), F.col("n")).alias("cell"))
    ordered = (F.col("lat") < F.col("lat2")) | ((F.col("lat") == F.col("lat2")) & (F.col("lon") < F.col("lon2")))
    polar = F.abs("lat") > 89
    inner = own.join(homes, "cell").where(ordered & (~polar | (haversine_m(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2")) <= metres)))
    return keys, measured.select("lat", "lon", "lat2", "lon2").unionByName(inner.select("lat", "lon", "lat2", "lon2"))


def near_pairs(points: DataFrame, key: str, lat: str, lon: str, metres: float) -> DataFrame:
    """Pairs of different keys at most ``metres`` apart: distinct rows (``left_key``, ``right_key``), the smaller first.

    The places and links of ``near_places`` written out; keys that share a point are near each other. A place with very
    many keys has very many pairs; what goes on with nearness should take places and links.
    """
    keys, links = near_places(points, key, lat, lon, metres)
    a = keys.select(F.col("point_key").alias("a"), "lat", "lon")
    b = keys.select(F.col("point_key").alias("b"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))
    apart = links.join(a, ["lat", "lon"]).join(b, ["lat2", "lon2"]).where("a != b").select(F.least("a", "b").alias("left_key"), F.greatest("a", "b").alias("right_key"))
    same = a.join(b.withColumnsRenamed({"lat2": "lat", "lon2": "lon"}), ["lat", "lon"]).where("a < b").select(F.col("a").alias("left_key"), F.col("b").alias("right_key"))
    return apart.unionByName(same).distinct()


def points_within(left: DataFrame, left_key: str, right: DataFrame, right_key: str, metres: float, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Left and right keys at most ``metres`` apart: distinct (``left_key``, ``right_key``).

    Points are put into cells about ``metres`` high and wide; a right point is in one cell, a left point looks into the
    cells that its disc may reach, some nine. Equal points are measured once. Points that are not usable or have no key
    are left out, the date line and the poles need no care; empty tables give no rows. Keys are given as text.
    """
    a, b = (_places(df, key, lat, lon).distinct() for df, key in ((left, left_key), (right, right_key)))
    reach = math.degrees(metres / EARTH_M) * 1.000001
    rows = max(1, math.floor(180 / reach))
    high = 180 / rows

    def columns(row: Column) -> Column:
        """Cells in a row: as wide as the reach where the row is narrowest in degrees, one cell near the poles."""
        far = F.greatest(F.abs(row * high - 90), F.abs((row + 1) * high - 90)) + reach
        return F.when(far >= 89.9, F.lit(1.0)).otherwise(F.greatest(F.lit(1.0), F.floor(F.lit(360.0) / F.degrees(F.asin(F.least(F.lit(1.0), F.sin(F.lit(math.radians(min(reach, 90.0)))) / F.cos(F.radians(far))))))))

    row_of = lambda y: F.least(F.floor((y + 90) / high), F.lit(rows - 1))
    col_of = lambda x, n: F.floor((x + 180) / 360 * n)
    cell = lambda r, c, n: F.shiftleft(r.cast("long"), 32) + F.pmod(c, n).cast("long")
    y, x = F.col("lat"), F.col("lon")
    held = b.select("lat", "lon").distinct().withColumn("row", row_of(y)).withColumn("n", columns(F.col("row")))
    held = held.select(F.col("lat").alias("lat2"), F.col("lon").alias("lon2"), cell(F.col("row"), col_of(x, F.col("n")), F.col("n")).alias("cell"))
    looks = []
    for k in (-1, 0, 1):
        r = row_of(y) + k
        n = columns(r)
        # A row has few cells near the poles; each is looked into once.
        beside = F.array_distinct(F.array(*(cell(r, col_of(x, n) + d, n) for d in (-1, 0, 1))))
        looks.append(F.when(r.between(0, rows - 1), beside).otherwise(F.array().cast("array<long>")))
    probe = a.select("lat", "lon").distinct().select("lat", "lon", F.explode(F.concat(*looks)).alias("cell"))
    links = probe.join(held, "cell").where(haversine_m(y, x, F.col("lat2"), F.col("lon2")) <= metres).select("lat", "lon", "lat2", "lon2")
    one = a.withColumnRenamed("point_key", "left_key")
    two = b.select(F.col("point_key").alias("right_key"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))
    return links.join(one, ["lat", "lon"]).join(two, ["lat2", "lon2"]).select("left_key", "right_key").distinct()


def regions_overlap(regions: DataFrame, region: str, polygon: str) -> DataFrame:
    """Pairs of regions (``a`` < ``b``) that have at least a cell in common that lies wholly within both.

    Cells are about a fiftieth of a region wide at the finest; narrower overlaps, such as those of borders drawn unevenly,
    do not count. Cells are joined to cells and to the larger ones around them; no two regions are held against each other.
    """
    cells = cut(region_cells(regions, region, polygon).where("lines IS NULL").select("cell", "region_id"))
    levels = sorted(r[0] for r in cells.select(F.shiftright("cell", 48)).distinct().collect())  # some ten
    level, row, column = F.shiftright("cell", 48), F.shiftright("cell", 24).bitwiseAND((1 << 24) - 1), F.col("cell").bitwiseAND((1 << 24) - 1)
    around = [F.when(level >= lv, _cell(lv, F.call_function("shiftright", row, (level - lv).cast("int")), F.call_function("shiftright", column, (level - lv).cast("int")))) for lv in levels]
    wider = cells.select(F.col("region_id").alias("x"), F.explode(F.array_compact(F.array(*around)) if around else F.array().cast("array<long>")).alias("cell")).distinct()
    pairs = wider.join(cells.withColumnRenamed("region_id", "y"), "cell").where("x != y")
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


NEAREST_LEVELS = (3, 6, 9, 12, 15)  # cells of 360 / 2**level degrees that the search for the nearest goes down


def nearest(left: DataFrame, left_key: str, right: DataFrame, right_key: str, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """The nearest right point for each left key: ``left_key``, ``right_key``, ``metres``; of equally near ones the smallest key.

    Cells of right points are searched from coarse to fine: of the cells known to hold a point only those go on that may
    hold one no farther than the nearest is known to be. So a left point meets a few cells on each level and the
    points of a few cells in the end, however the points are spread; only the coarsest level, of at most 32 cells, is sent
    to all tasks. Points that are not usable are left out; a left key with several points takes the nearest of any of
    them; without right points there are no rows. Keys are given as text.
    """
    a = _places(left, left_key, lat, lon).distinct()
    b = cut(_places(right, right_key, lat, lon).groupBy("lat", "lon").agg(F.min("point_key").alias("right_key")))
    row = lambda lv, y: F.least(F.floor((y + 90) * (2**lv / 360)), F.lit(2**lv // 2 - 1))
    col = lambda lv, x: F.least(F.floor((x + 180) * (2**lv / 360)), F.lit(2**lv - 1))
    y, x = F.col("lat"), F.col("lon")

    def bounds(df: DataFrame, lv: int) -> DataFrame:
        """How near and how far a point of the cell may be at most; cells that cannot hold the nearest are left out."""
        size = 360 / 2**lv
        south, west = F.col("row") * size - 90, F.col("col") * size - 180
        up = F.greatest(F.lit(0.0), south - y, y - (south + size))
        over = F.abs(x - west - size / 2)
        aside = F.greatest(F.lit(0.0), F.least(over, 360 - over) - size / 2)
        across = F.when(aside < 90, F.asin(F.sin(F.radians(aside)) * F.cos(F.radians(y)))).otherwise(F.radians(90 - F.abs(y)))
        low = F.lit(EARTH_M) * F.greatest(F.radians(up), across) * (1 - 1e-9) - 1e-3
        high = haversine_m(y, x, south + size / 2, west + size / 2) + EARTH_M * math.radians(size) + 1e-3
        w = Window.partitionBy("point_key", "lat", "lon")
        return df.withColumn("low", low).withColumn("most", F.min(high).over(w)).where("low <= most").select("point_key", "lat", "lon", "row", "col")

    top = NEAREST_LEVELS[0]
    cells = b.select(row(top, y).alias("row"), col(top, x).alias("col")).distinct()
    some = bounds(a.join(F.broadcast(cells)), top)  # 2**top * 2**top / 2 cells at most
    for before, lv in zip(NEAREST_LEVELS, NEAREST_LEVELS[1:]):
        step = lv - before
        fine = b.select(row(lv, y).alias("r"), col(lv, x).alias("c")).distinct().withColumn("row", F.shiftright("r", step)).withColumn("col", F.shiftright("c", step))
        some = bounds(some.join(fine, ["row", "col"]).drop("row", "col").withColumnsRenamed({"r": "row", "c": "col"}), lv)
    last = NEAREST_LEVELS[-1]
    held = b.select("right_key", F.col("lat").alias("lat2"), F.col("lon").alias("lon2"), row(last, y).alias("row"), col(last, x).alias("col"))
    met = some.join(held, ["row", "col"]).select("point_key", "right_key", haversine_m(y, x, F.col("lat2"), F.col("lon2")).alias("metres"))
    best = met.groupBy("point_key").agg(F.min(F.struct("metres", "right_key")).alias("b"))
    return best.select(F.col("point_key").alias("left_key"), "b.right_key", "b.metres")
