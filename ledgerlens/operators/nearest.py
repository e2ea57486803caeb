"""Nearest reference point within a radius (X2: coordinates -> postcode).

The original enrichment asked a web geocoder, once per incident row, for the
postcode at the incident's coordinates.  Given a table of postcode
coordinates the same question is a join: each point takes the key of the
closest reference point no farther than ``radius``, or null when there is
none.

Plan.  The plane is cut into square cells of side ``radius``; a cell's
candidates are the reference points that may be the nearest to some place in
it.  A cell with more than ``chunk`` candidates is refined into 4x4 cells,
each with the candidates for its own places, and so on: the grid is as fine
as the reference is dense.  That work is on the reference side, a dimension
table, and its result is an index of one row per cell.  A point looks up how
far its cell is refined (a join with the few refined cells per level, none
where no cell is dense) and then meets exactly one candidate row in an
equi-join; the nearest candidate is picked inside the row by array functions.
The large side is neither multiplied nor regrouped.

A candidate is left out of a cell where another reference point is nearer to
every place of the cell.  For two reference points the difference of the
squared distances is linear in the place, so the cell's corners decide.  Each
cell tests its candidates against five of them: the nearest to each corner
and to the middle.

The index can be stored (:func:`store_index`) and opened by any number of
jobs (:func:`open_index`), each micro-batch of a stream included.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators.joins import DEFAULT_MAX_BROADCAST_BYTES, DEFAULT_MAX_BROADCAST_ROWS
from ledgerlens.session import shared_folder

# A cell side a hair over the radius: the rounding of ``x / side`` (about
# 1e-16 of ``x / side``) can then never put a point within ``radius`` two
# cells away, for coordinates up to ~1e9 radii from the origin.
_SIDE_MARGIN = 1.0 + 1e-6
# Relative slack of comparisons that leave a candidate out: far above the
# rounding of the distances that are compared in the end.
_SLACK = 1e-9
_NEIGHBOURS = [(dx, dy) for dx in (-1, 0, 1) for dy in (-1, 0, 1)]
# Candidates of a cell that is not refined.
DEFAULT_CHUNK = 256
# A refined cell has SPLIT x SPLIT children; cells of the last level, and
# those that keep most of their parent's candidates, stay as they are.
SPLIT, MAX_LEVEL, HELPED = 4, 6, 0.75


@dataclass
class NearestIndex:
    """Candidate cells of a reference table.

    ``leaves`` has ``level, cx, cy, cands`` (``cands``: ``struct(x, y, k)`` of
    every candidate), ``refined`` per level the refined cells ``cx, cy``.
    """

    radius: float
    stretch: float
    degrees: bool
    leaves: DataFrame
    entries: int
    size: int
    refined: list[DataFrame] = field(default_factory=list)
    refined_rows: list[int] = field(default_factory=list)
    path: str | None = None

    def sides(self, level: int) -> tuple[float, float]:
        side = self.radius * _SIDE_MARGIN / SPLIT ** level
        return side * self.stretch, side


def _cell(coord: Column, side: float) -> Column:
    return F.floor(coord / F.lit(side))


def _copies(reference: DataFrame, key: str, x: str, y: str, index: NearestIndex) -> DataFrame:
    """``cx, cy, x, y, k``: each distinct reference location (smallest key)
    once per cell of the 3x3 block around its own."""
    wide, high = index.sides(0)
    located = (reference
               .filter(F.col(key).isNotNull() & F.col(x).isNotNull() & F.col(y).isNotNull())
               .groupBy(F.col(x).alias("x"), F.col(y).alias("y"))
               .agg(F.min(key).alias("k")))
    offsets = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy"))
                        for dx, dy in _NEIGHBOURS])
    return located.select("x", "y", "k", F.explode(offsets).alias("o")).select(
        (_cell(F.col("x"), wide) + F.col("o.dx")).alias("cx"),
        (_cell(F.col("y"), high) + F.col("o.dy")).alias("cy"),
        "x", "y", "k",
    )


class _Box:
    """A cell's edges as columns, and what distances to its places can be."""

    def __init__(self, index: NearestIndex, level: int) -> None:
        wide, high = index.sides(level)
        # a hair wider than the cell, as floor() may round a place across its edge
        self.x0, self.x1 = ((F.col("cx") + o) * F.lit(wide) for o in (-_SLACK, 1 + _SLACK))
        self.y0, self.y1 = ((F.col("cy") + o) * F.lit(high) for o in (-_SLACK, 1 + _SLACK))
        if index.degrees:  # least and greatest squared scale of longitude in the cell
            far = F.greatest(F.abs(self.y0), F.abs(self.y1))
            near = F.when((self.y0 <= 0) & (self.y1 >= 0), 0.0).otherwise(
                F.least(F.abs(self.y0), F.abs(self.y1)))
            self.least, self.most = (F.pow(F.cos(F.radians(F.least(v, F.lit(90.0)))), 2)
                                     for v in (far, near))
        else:
            self.least = self.most = F.lit(1.0)

    def places(self) -> list[tuple[Column, Column]]:
        middle = ((self.x0 + self.x1) / 2, (self.y0 + self.y1) / 2)
        return [middle, *[(x, y) for x in (self.x0, self.x1) for y in (self.y0, self.y1)]]

    def distance(self, x: Column, y: Column, place: tuple[Column, Column]) -> Column:
        dx, dy = x - place[0], y - place[1]
        return self.least * dx * dx + dy * dy

    def in_reach(self, x: Column, y: Column, radius: float) -> Column:
        dx = F.greatest(self.x0 - x, x - self.x1, F.lit(0.0))
        dy = F.greatest(self.y0 - y, y - self.y1, F.lit(0.0))
        return self.least * dx * dx + dy * dy <= F.lit(radius * radius * (1 + _SLACK))

    def farther(self, x: Column, y: Column, other: Column) -> Column:
        """Whether (x, y) is farther than ``other`` from every place of the cell."""
        ox, oy = other["x"], other["y"]
        # d2(other) - d2(own) = scale * a(place x) + b(place y), both linear
        a = [ox * ox - x * x - 2 * edge * (ox - x) for edge in (self.x0, self.x1)]
        b = [oy * oy - y * y - 2 * edge * (oy - y) for edge in (self.y0, self.y1)]
        along_x = F.greatest(*[scale * v for scale in (self.least, self.most) for v in a])
        size = F.greatest(F.abs(self.x0), F.abs(self.x1), F.abs(x), F.abs(ox))
        high = F.greatest(F.abs(self.y0), F.abs(self.y1), F.abs(y), F.abs(oy))
        # rounding of the products, relative to the coordinates themselves
        slack = (size * size + high * high) * F.lit(1e-14)
        return along_x + F.greatest(*b) < -slack


def _pruned(copies: DataFrame, index: NearestIndex, level: int) -> DataFrame:
    """``copies`` without those farther than a champion of their cell from all of it."""
    box = _Box(index, level)
    own = F.struct("x", "y", "k")
    best = [F.min(F.struct(box.distance(F.col("x"), F.col("y"), place).alias("d"), own.alias("r")))
            ["r"].alias(f"best{i}") for i, place in enumerate(box.places())]
    champions = copies.groupBy("cx", "cy").agg(*best).withColumnsRenamed({"cx": "_cx", "cy": "_cy"})
    kept = copies.join(champions, F.expr("cx = _cx AND cy = _cy"))
    gone = F.lit(False)
    for i in range(len(best)):
        gone |= box.farther(F.col("x"), F.col("y"), F.col(f"best{i}"))
    return kept.filter(~gone).select(*copies.columns)


def _children(copies: DataFrame, index: NearestIndex, level: int) -> DataFrame:
    """``copies`` once per child of their cell that they can be within the radius of."""
    offsets = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy"))
                        for dx in range(SPLIT) for dy in range(SPLIT)])
    d = copies.select("*", F.explode(offsets).alias("o")).select(
        (F.col("cx") * SPLIT + F.col("o.dx")).alias("cx"),
        (F.col("cy") * SPLIT + F.col("o.dy")).alias("cy"), "x", "y", "k", "parent")
    return d.filter(_Box(index, level).in_reach(F.col("x"), F.col("y"), index.radius))


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _build(reference: DataFrame, path: str, key: str, x: str, y: str, radius: float, chunk: int,
           degrees: bool) -> NearestIndex:
    if radius <= 0:
        raise ValueError("radius must be positive")
    ref = reference.select(F.col(key).alias("k"), F.col(x).cast("double").alias("x"),
                           F.col(y).cast("double").alias("y"))
    stretch = 1.0
    if degrees:
        far = ref.agg(F.max(F.abs("y"))).first()[0] or 0.0
        # cells wide enough for the radius at the highest latitude a match can have
        stretch = 1.0 / math.cos(math.radians(min(89.9, far + radius)))
    index = NearestIndex(float(radius), float(stretch), degrees, ref, 0, 0, path=path)
    copies = _copies(ref, "k", "x", "y", index).withColumn("parent", F.lit(None).cast("bigint"))
    width = F.octet_length(F.col("k").cast("string")) + 24
    on = F.expr("cx = _cx AND cy = _cy")
    parts: list[DataFrame] = []

    def sizes(copies: DataFrame) -> DataFrame:
        return copies.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("size"), F.max("parent").alias("parent"))

    def store(copies: list[DataFrame], level: int) -> None:
        """The leaves of a level."""
        for i, part in enumerate(copies):
            leaves = part.groupBy("cx", "cy").agg(F.collect_list(F.struct("x", "y", "k")).alias("cands"))
            parts.append(_written(leaves.select(F.lit(level).alias("level"), "cx", "cy", "cands"), f"{path}/leaves/part={2 * level + i}"))

    def split(copies: DataFrame, more: Column, name: str) -> tuple[DataFrame, int]:
        """The cells for which ``more`` holds (written) and their number; the others' entries are counted."""
        cells = sizes(copies)
        found = cells.agg(F.count_if(more), F.sum(F.when(~more, F.col("n"))), F.sum(F.when(~more, F.col("size")))).first()
        index.entries += found[1] or 0
        index.size += found[2] or 0
        if not found[0]:
            return cells, 0
        named = cells.filter(more).select(F.col("cx").alias("_cx"), F.col("cy").alias("_cy"), F.col("n").alias("_n"))
        return _written(named, f"{path}/{name}"), found[0]

    for level in range(MAX_LEVEL + 1):
        crowded, n = split(copies, F.col("n") > chunk, f"crowded/level={level}")
        if not n:
            store([copies], level)
            break
        cells = [copies.join(crowded, on, "left_anti")]
        kept = _written(_pruned(copies.join(crowded, on, "left_semi"), index, level), f"{path}/kept/level={level}")
        dense = F.lit(False) if level == MAX_LEVEL else (F.col("n") > chunk) & (
            F.col("parent").isNull() | (F.col("n") <= HELPED * F.col("parent")))
        refined, n = split(kept, dense, f"refined/level={level}")
        store([*cells, kept.join(refined, on, "left_anti") if n else kept], level)
        if not n:
            break
        index.refined.append(refined.select(F.col("_cx").alias("cx"), F.col("_cy").alias("cy")))
        index.refined_rows.append(n)
        parents = kept.drop("parent").join(refined, on).select("cx", "cy", "x", "y", "k", F.col("_n").alias("parent"))
        copies = _written(_children(parents, index, level + 1), f"{path}/copies/level={level + 1}")
    index.leaves = parts[0] if len(parts) == 1 else reduce(DataFrame.unionAll, parts)
    return index


def store_index(
    reference: DataFrame,
    path: str,
    key: str = "postcode",
    x: str = "longitude",
    y: str = "latitude",
    radius: float = 0.01,
    chunk: int = DEFAULT_CHUNK,
    degrees: bool = False,
) -> NearestIndex:
    """Build the candidate index of ``reference`` for ``radius`` and store it in ``path``.

    ``path`` is a folder that all executors share.  Cells of at most ``chunk``
    candidates are rows of the index; the candidates of the others are pruned,
    and cells that still have more are refined for the next level.  A cell's
    champions are partial aggregates, and a dense cell's copies are dealt over
    tasks by AQE, as the join that prunes them is between two plain shuffles.
    """
    index = _build(reference, path, key, x, y, radius, chunk, degrees)
    spark = reference.sparkSession
    facts = spark.range(1).select(
        F.lit(index.radius).alias("radius"), F.lit(index.stretch).alias("stretch"), F.lit(degrees).alias("degrees"),
        F.lit(index.entries).cast("bigint").alias("entries"), F.lit(index.size).cast("bigint").alias("size"),
        F.array(*[F.lit(n).cast("bigint") for n in index.refined_rows]).cast("array<bigint>").alias("refined"))
    facts.coalesce(1).write.mode("overwrite").parquet(f"{path}/facts")
    return open_index(spark, path)


def open_index(spark: SparkSession, path: str) -> NearestIndex:
    """The index that :func:`store_index` left in ``path``."""
    facts = spark.read.parquet(f"{path}/facts").first()
    leaves = spark.read.parquet(f"{path}/leaves").select("level", "cx", "cy", "cands")
    refined = [spark.read.parquet(f"{path}/refined/level={i}").select(F.col("_cx").alias("cx"), F.col("_cy").alias("cy"))
               for i in range(len(facts["refined"]))]
    return NearestIndex(facts["radius"], facts["stretch"], facts["degrees"], leaves, facts["entries"], facts["size"],
                        refined, list(facts["refined"]), path)


def nearest_point(
    points: DataFrame,
    reference: DataFrame | NearestIndex,
    x: str = "longitude",
    y: str = "latitude",
    key: str = "postcode",
    radius: float | None = None,
    ref_x: str | None = None,
    ref_y: str | None = None,
    out: str | None = None,
    distance_out: str | None = None,
    broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    chunk: int = DEFAULT_CHUNK,
    degrees: bool = False,
    broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Every row of ``points`` plus ``out``: the ``key`` of the nearest
    ``reference`` row within ``radius`` (X2).

    Distance is Euclidean in the coordinates' own units.  With ``degrees``,
    ``x`` is a longitude and ``y`` a latitude: differences of longitude are
    scaled by the cosine of the point's latitude, so distances and
    ``radius`` are degrees of latitude (no wrap at 180 degrees).  A reference
    point at exactly ``radius`` counts; equal distances go to the smallest
    key; no reference point within ``radius``, or a null coordinate, gives
    null.  ``distance_out`` adds the distance.

    ``reference`` is a table, indexed first in the shared folder (``radius``,
    0.01 by default, ``chunk`` and ``degrees`` are those of
    :func:`store_index`), or an index that is stored already and brings its
    own.  ``points`` may be a stream: every micro-batch reads the index only.
    The index is broadcast where its measured entries and bytes are under the
    bounds; otherwise points and cells are shuffled on the cell, and AQE
    splits a cell that holds many points.
    """
    out = out or key
    if isinstance(reference, NearestIndex):
        index = reference
    else:
        folder = f"{shared_folder(points.sparkSession)}/nearest-{uuid.uuid4().hex}"
        index = _build(reference, folder, key, ref_x or x, ref_y or y, 0.01 if radius is None else radius, chunk, degrees)
    px, py = F.col(x), F.col(y)

    def small(rows: int, size: int) -> bool:
        return rows <= broadcast_rows and size <= broadcast_bytes

    def at(level: int) -> tuple[Column, Column]:
        wide, high = index.sides(level)
        cx, cy = _cell(px, index.sides(0)[0]), _cell(py, index.sides(0)[1])
        for deeper in range(level):  # a child lies within its parent, however the division rounds
            wide, high = index.sides(deeper + 1)
            cx = F.least(F.greatest(_cell(px, wide), cx * SPLIT), cx * SPLIT + (SPLIT - 1))
            cy = F.least(F.greatest(_cell(py, high), cy * SPLIT), cy * SPLIT + (SPLIT - 1))
        return cx, cy

    keyed = points.withColumn("_level", F.lit(0))
    for level, cells in enumerate(index.refined):
        cells = cells.select(F.col("cx").alias("_rx"), F.col("cy").alias("_ry"))
        cells = F.broadcast(cells) if small(index.refined_rows[level], 16 * index.refined_rows[level]) else cells.hint("merge")
        cx, cy = at(level)
        # a refined cell lies in refined cells only, so every match is one level more
        keyed = keyed.withColumns({"_cx": cx, "_cy": cy}).join(cells, F.expr("_cx = _rx AND _cy = _ry"), "left")
        keyed = keyed.withColumn("_level", F.when(F.col("_rx").isNotNull(), level + 1).otherwise(F.col("_level")))
        keyed = keyed.drop("_cx", "_cy", "_rx", "_ry")
    cx, cy = at(0)
    for level in range(1, len(index.refined) + 1):
        deep = F.col("_level") == level
        cx, cy = F.when(deep, at(level)[0]).otherwise(cx), F.when(deep, at(level)[1]).otherwise(cy)
    leaves = index.leaves.select(F.col("level").alias("_l"), F.col("cx").alias("_lx"), F.col("cy").alias("_ly"), "cands")
    leaves = leaves.withColumnRenamed("cands", "_cands")
    leaves = F.broadcast(leaves) if small(index.entries, index.size) else leaves.hint("merge")
    joined = keyed.withColumns({"_cx": cx, "_cy": cy}).join(leaves, F.expr("_cx = _lx AND _cy = _ly AND _level = _l"), "left")

    scale = F.cos(F.radians(py)) if index.degrees else F.lit(1.0)

    def scored(c: Column) -> Column:
        dx, dy = (c["x"] - px) * scale, c["y"] - py
        d = F.sqrt(dx * dx + dy * dy)
        return F.struct(d.alias("d"), c["k"].alias("k"))

    within = F.filter(F.transform("_cands", scored), lambda s: s["d"] <= F.lit(index.radius))
    cols = [c for c in points.columns if c not in (out, distance_out)]
    # Smallest (distance, key) of the row's candidates; null when none.
    best = joined.select(*cols, F.array_min(within).alias("_best"))
    extra = [best["_best.k"].alias(out)]
    if distance_out:
        extra.append(best["_best.d"].alias(distance_out))
    return best.select(*cols, *extra)
