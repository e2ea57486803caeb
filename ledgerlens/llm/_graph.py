"""Connected components of links kept as a table (never on the driver)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ledgerlens.llm._tables import materialize


def _stored(links: DataFrame) -> tuple[DataFrame, tuple]:
    """``links`` written, and a mark of its rows (number, sum of hashes) observed while they are written."""
    seen = Observation()
    rows = links.observe(seen, F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"))
    table = materialize(rows, "links")
    return table, (seen.get["n"], seen.get["h"])


def _large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the smallest of its neighbourhood."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    return (both.join(least, "a").filter("b > a")
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a")
    return (moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select("a", F.col("m").alias("b"))).filter("a > b").distinct())


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in ``links`` (a, b); component is the smallest reachable id.

    Alternating large-star and small-star rounds; each round is one written
    table, and a round that changes nothing ends the loop.  Aggregates are
    partial, so a node with very many links costs one row per task.
    Self-links and nulls are ignored; without links the result is empty.
    """
    now, mark = _stored(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while mark[0]:
        after, new = _stored(_small_star(_large_star(now)))
        if new == mark:
            break
        now, mark = after, new
    stars = now.select(F.col("a").alias("id"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return stars.union(roots)
