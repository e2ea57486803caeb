"""Nearest reference point within a radius (X2) against brute force."""

import math
import os
import uuid

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF001
from ledgerlens.operators import nearest_point, open_index, store_index
from ledgerlens.plans.inspect import plan_text, scan_ancestors, slow_operators
from ledgerlens.streaming import checkpoint_path, start_memory

POINTS = "id long, longitude double, latitude double"
REFS = "postcode string, longitude double, latitude double"
SETTINGS = settings(max_examples=10, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def brute_force(points, refs, radius):
    """id -> (postcode, distance) of the nearest reference within radius."""
    out = {}
    for i, x, y in points:
        best = None
        if x is not None and y is not None:
            for k, rx, ry in refs:
                if k is None or rx is None or ry is None:
                    continue
                d = math.sqrt((rx - x) * (rx - x) + (ry - y) * (ry - y))
                if d <= radius and (best is None or (d, k) < best):
                    best = (d, k)
        out[i] = (best[1], best[0]) if best else (None, None)
    return out


def run(spark, points, refs, radius, **kw):
    res = nearest_point(spark.createDataFrame(points, POINTS), spark.createDataFrame(refs, REFS),
                        radius=radius, distance_out="dist", **kw)
    return {r.id: (r.postcode, r.dist) for r in res.collect()}


# Half-unit lattice coordinates make equal distances and points at exactly
# the radius common.
coord = st.one_of(st.none(), st.integers(-12, 12).map(lambda v: v * 0.5))
point_lists = st.lists(st.tuples(coord, coord), min_size=1, max_size=30)
ref_lists = st.lists(st.tuples(st.sampled_from(["A", "B", "C", "D", None]), coord, coord),
                     max_size=25)


@SETTINGS
@given(point_lists, ref_lists, st.sampled_from([0.5, 1.0, 1.5, 2.5, 7.0]))
def test_random_layouts_equal_brute_force(spark, pts, refs, radius):
    points = [(i, x, y) for i, (x, y) in enumerate(pts)]
    want = brute_force(points, refs, radius)
    assert run(spark, points, refs, radius) == want
    assert run(spark, points, refs, radius, broadcast_rows=0) == want  # shuffle join


@SETTINGS
@given(point_lists, ref_lists, st.sampled_from([1.0, 2.5, 7.0]), st.sampled_from([1, 2, 3]))
def test_dense_cells_split_into_chunks_equal_brute_force(spark, pts, refs, radius, chunk):
    """Cells with more than ``chunk`` candidates are refined; a point meets the
    cell of its own place."""
    points = [(i, x, y) for i, (x, y) in enumerate(pts)]
    want = brute_force(points, refs, radius)
    assert run(spark, points, refs, radius, chunk=chunk) == want
    assert run(spark, points, refs, radius, chunk=chunk, broadcast_rows=0) == want


def test_duplicate_point_rows_are_kept_in_dense_cells(spark):
    refs = [(f"K{i}", 0.1 * i, 0.0) for i in range(8)]
    points = [(1, 0.33, 0.0), (1, 0.33, 0.0), (2, 0.33, 0.0)]
    res = nearest_point(spark.createDataFrame(points, POINTS), spark.createDataFrame(refs, REFS),
                        radius=1.0, chunk=2)
    assert sorted(tuple(r) for r in res.collect()) == [(1, 0.33, 0.0, "K3"), (1, 0.33, 0.0, "K3"),
                                                       (2, 0.33, 0.0, "K3")]


def test_edge_cases(spark):
    refs = [("B", 1.0, 0.0), ("A", -1.0, 0.0),      # equidistant from the origin: A wins
            ("Z", 5.0, 5.0), ("Y", 5.0, 5.0),        # one location, two keys: Y
            ("C", 10.0, 0.0), (None, 0.1, 0.1), ("N", None, 3.0)]
    points = [(1, 0.0, 0.0), (2, 5.0, 4.0), (3, 9.0, 0.0), (4, 20.0, 20.0),
              (5, None, 0.0), (6, 0.0, 3.0), (7, 12.0, 0.0)]
    got = run(spark, points, refs, 2.0)
    assert got == {1: ("A", 1.0), 2: ("Y", 1.0), 3: ("C", 1.0), 4: (None, None),
                   5: (None, None), 6: (None, None), 7: ("C", 2.0)}  # 7: exactly at the radius
    assert got == brute_force(points, refs, 2.0)


def test_reference_columns_may_differ(spark):
    refs = spark.createDataFrame([("A", 1.0, 1.0)], "pc string, e double, n double")
    pts = spark.createDataFrame([(1, 1.5, 1.0)], POINTS)
    res = nearest_point(pts, refs, key="pc", ref_x="e", ref_y="n", radius=1.0, out="postcode")
    assert [tuple(r) for r in res.collect()] == [(1, 1.5, 1.0, "A")]


def derived_layout(spark):
    """Points and references the data gives: events at a location derived
    from their user, customers at a location derived from their key (a few
    customers share a spot, so ties occur), one user holding a third of the
    events (a hot spot)."""
    events = spark.read.parquet(f"{SF001}/events.parquet")
    hot = F.when(F.col("event_id") % 3 == 0, F.lit(7)).otherwise(F.col("user_id"))
    pts = events.select(
        F.col("event_id").alias("id"),
        ((hot % 40) * 0.25 + (F.col("event_id") % 5) * 0.01).alias("longitude"),
        (F.floor(hot / 40) * 0.25 + (F.col("event_id") % 7) * 0.01).alias("latitude"))
    refs = spark.read.parquet(f"{SF001}/customer.parquet").select(
        F.col("c_custkey").cast("string").alias("postcode"),
        ((F.col("c_custkey") % 40) * 0.25 + 0.02).alias("longitude"),
        (F.floor(F.col("c_custkey") / 37) * 0.25).alias("latitude"))
    return pts, refs


@pytest.mark.parametrize("broadcast_rows", [2_000_000, 0])
def test_derived_layout_with_hot_spot_equals_brute_force(spark, broadcast_rows):
    pts, refs = derived_layout(spark)
    got = {r.id: (r.postcode, r.dist) for r in nearest_point(
        pts, refs, radius=0.2, distance_out="dist", broadcast_rows=broadcast_rows).collect()}
    want = brute_force([tuple(r) for r in pts.collect()], [tuple(r) for r in refs.collect()], 0.2)
    assert got == want
    assert sum(1 for v in want.values() if v[0] is not None) > len(want) // 2


def test_point_side_is_not_shuffled_when_reference_is_small(spark):
    """The events feed a broadcast hash join straight from their scan: no
    exchange, no keyless join, no Python on the large side."""
    pts, refs = derived_layout(spark)
    res = nearest_point(pts, refs, radius=0.2)
    plan = plan_text(res)
    above = scan_ancestors(plan, "events.parquet")
    assert any(op.startswith("BroadcastHashJoin LeftOuter") for op in above)
    assert not any("Exchange" in op for op in above)
    assert slow_operators(plan) == []


def test_stream_equals_batch(spark, scratch):
    pts, refs = derived_layout(spark)
    path = os.path.join(scratch, f"points_{uuid.uuid4().hex[:6]}")
    pts.repartition(3).write.parquet(path)
    stream = spark.readStream.schema(pts.schema).option("maxFilesPerTrigger", 1).parquet(path)
    name = "q_" + uuid.uuid4().hex[:10]
    q = start_memory(nearest_point(stream, refs, radius=0.2), name, "append",
                     checkpoint_path(spark, name), {"availableNow": True})
    q.awaitTermination(300)
    assert q.exception() is None
    got = sorted(tuple(r) for r in spark.table(name).collect())
    assert got == sorted(tuple(r) for r in nearest_point(pts, refs, radius=0.2).collect())


def test_stream_over_a_stored_index_with_dense_cells_equals_batch(spark, scratch):
    """Cells are refined for two candidates; the stream opens the stored index,
    and its micro-batches read nothing of the reference."""
    pts, refs = derived_layout(spark)
    folder = os.path.join(scratch, f"ref_{uuid.uuid4().hex[:6]}")
    refs.write.parquet(f"{folder}/refs")
    built = store_index(spark.read.parquet(f"{folder}/refs"), f"{folder}/index", radius=0.2, chunk=2)
    assert built.refined_rows
    pts.limit(3000).repartition(3).write.parquet(f"{folder}/points")
    stream = spark.readStream.schema(pts.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/points")
    name = "q_" + uuid.uuid4().hex[:10]
    q = start_memory(nearest_point(stream, open_index(spark, f"{folder}/index"), distance_out="d"), name, "append",
                     checkpoint_path(spark, name), {"availableNow": True})
    q.awaitTermination(300)
    assert q.exception() is None
    plan = q._jsq.lastProgress()
    assert q.lastProgress["batchId"] >= 2 and plan is not None
    assert "/refs" not in q._jsq.explainInternal(False)
    got = sorted(tuple(r) for r in spark.table(name).collect())
    points = spark.read.parquet(f"{folder}/points")
    assert got == sorted(tuple(r) for r in nearest_point(points, refs, radius=0.2, distance_out="d").collect())


def test_hot_cells_are_split(spark, scratch):
    """A third of the reference and a third of the points in one cell: the
    reference's copies and the points are both dealt over several tasks."""
    pts, refs = derived_layout(spark)
    key = F.col("postcode").cast("long")
    refs = refs.select("postcode", F.when(key % 3 == 0, 1.75 + (key % 97) * 0.0009).otherwise(F.col("longitude")).alias("longitude"),
                       F.when(key % 3 == 0, (key % 89) * 0.001).otherwise(F.col("latitude")).alias("latitude"))
    index = store_index(refs, os.path.join(scratch, f"index_{uuid.uuid4().hex[:6]}"), radius=0.2, chunk=32)
    most = index.leaves.agg(F.max(F.size("cands"))).first()[0]
    dense = refs.count() // 3
    assert index.refined_rows and most < dense / 4
    low = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
           "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    before = {k: spark.conf.get(k) for k in low}
    try:
        for k, v in low.items():
            spark.conf.set(k, v)
        res = nearest_point(pts.repartition(8), index, broadcast_rows=0)
        res.collect()
        plan = plan_text(res)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "coalesced and skewed" in plan
    assert "Union" not in plan and "Aggregate" not in plan


def test_refining_shrinks_candidate_lists(spark, scratch):
    """Ten thousand places in one cell: every leaf keeps a few, and answers stay exact."""
    rows = [(f"K{i}", (i * 37 % 10007) / 10007, (i * 61 % 9973) / 9973) for i in range(10_000)]
    refs = spark.createDataFrame(rows, REFS)
    index = store_index(refs, os.path.join(scratch, f"index_{uuid.uuid4().hex[:6]}"), radius=1.0, chunk=64)
    sizes = index.leaves.select(F.size("cands").alias("n")).agg(F.max("n"), F.avg("n")).first()
    assert sizes[0] <= 64 and index.entries < 60 * len(rows)
    points = [(i, (i % 31) / 31 * 1.4 - 0.2, (i % 29) / 29 * 1.4 - 0.2) for i in range(200)]
    got = {r.id: (r.postcode, r.dist) for r in nearest_point(spark.createDataFrame(points, POINTS), index, distance_out="dist").collect()}
    assert got == brute_force(points, rows, 1.0)


def test_degrees_with_refined_cells_equal_brute_force(spark, scratch):
    rows = [(f"K{i}", -3 + (i * 37 % 101) / 500, 58 + (i * 61 % 97) / 500) for i in range(400)]
    points = [(i, -3.2 + (i % 17) / 30, 57.9 + (i % 13) / 30) for i in range(150)]
    index = store_index(spark.createDataFrame(rows, REFS), os.path.join(scratch, f"index_{uuid.uuid4().hex[:6]}"),
                        radius=0.05, chunk=8, degrees=True)
    assert index.refined_rows
    want = {}
    for i, x, y in points:
        near = [(math.sqrt(((rx - x) * math.cos(math.radians(y))) ** 2 + (ry - y) ** 2), k) for k, rx, ry in rows]
        best = min(near)
        want[i] = best[1] if best[0] <= 0.05 else None
    got = {r.id: r.postcode for r in nearest_point(spark.createDataFrame(points, POINTS), index).collect()}
    assert got == want and None in want.values()


def test_large_reference_is_shuffle_joined_not_broadcast(spark):
    """Above the measured bound the candidate table is never broadcast, even
    when the planner's size estimate (which misses the ninefold copy) is
    under its threshold."""
    pts, refs = derived_layout(spark)
    res = nearest_point(pts, refs, radius=0.2, broadcast_rows=0)
    res.write.format("noop").mode("overwrite").save()
    above = scan_ancestors(plan_text(res), "events.parquet")
    assert any(op.startswith("SortMergeJoin LeftOuter") for op in above)
    assert not any(op.startswith("BroadcastHashJoin") for op in above)


@pytest.mark.parametrize("broadcast_rows", [2_000_000, 0])
def test_third_of_reference_in_one_cell_equals_brute_force(spark, broadcast_rows):
    """A third of the postcodes at distinct spots inside one cell, at the
    spot of the user holding a third of the events: that cell is
    refined until 64 candidates fit a row."""
    pts, refs = derived_layout(spark)
    key = F.col("postcode").cast("long")
    hot = key % 3 == 0
    refs = refs.select(
        "postcode",
        F.when(hot, 1.75 + (key % 97) * 0.0009).otherwise(F.col("longitude")).alias("longitude"),
        F.when(hot, (key % 89) * 0.001).otherwise(F.col("latitude")).alias("latitude"))
    got = {r.id: (r.postcode, r.dist) for r in nearest_point(
        pts, refs, radius=0.2, distance_out="dist", broadcast_rows=broadcast_rows,
        chunk=64).collect()}
    want = brute_force([tuple(r) for r in pts.collect()], [tuple(r) for r in refs.collect()], 0.2)
    assert got == want
    assert any(v[0] is not None and int(v[0]) % 3 == 0 for v in want.values())


def test_degrees_scale_longitude(spark):
    """At 53 degrees north 0.008 degrees east is nearer than 0.006 degrees north."""
    refs = [("E", -1.5 + 0.008, 53.0), ("N", -1.5, 53.006), ("W", -1.5 - 0.016, 53.0)]
    assert run(spark, [(1, -1.5, 53.0)], refs, 0.01)[1][0] == "N"
    assert run(spark, [(1, -1.5, 53.0)], refs, 0.01, degrees=True)[1][0] == "E"
    # a match whose longitude differs by more than the radius is found across cells
    got = run(spark, [(1, -1.5, 53.0)], refs[2:], 0.01, degrees=True)
    assert got[1][0] == "W" and abs(got[1][1] - 0.016 * math.cos(math.radians(53.0))) < 1e-12
