"""Line dedup over overlapping three-line windows (operator 10), DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm._tables import materialize, pick, text_or_empty, with_side

#: ASCII white space around a line, ignored when lines are compared.
EDGE = r"^[ \t-\r]+|[ \t-\r]+$"


def _lines(text: Column) -> Column:
    return F.split(text_or_empty(text), "\n")


def line_windows(docs: DataFrame, size: int = 3) -> DataFrame:
    """(doc_id, row, at, lines, key): each run of ``size`` consecutive non-blank lines.

    ``row`` is the hash of the text, which tells apart rows that share an id,
    ``at`` counts non-blank lines from 0, ``lines`` are their numbers among
    all lines and ``key`` is the 128-bit hash of the trimmed lines.  Documents
    with fewer lines, a null text or a null id have no windows.
    """
    d = pick(docs, "doc_id", "text").filter("doc_id IS NOT NULL").select(
        "doc_id", F.xxhash64("text").alias("row"), F.filter(F.transform(_lines(F.col("text")), lambda x, i: F.struct(
            i.alias("i"), F.regexp_replace(x, EDGE, "").alias("x"))), lambda s: s["x"] != "").alias("a"))
    d = d.filter(F.size("a") >= size)
    windows = F.transform(F.sequence(F.lit(0), F.size("a") - size), lambda j: F.struct(
        j.alias("at"),
        F.transform(F.slice("a", j + 1, size), lambda s: s["i"]).alias("lines"),
        F.unhex(F.md5(F.array_join(F.transform(F.slice("a", j + 1, size), lambda s: s["x"]), "\n"))).alias("key")))
    return d.select("doc_id", "row", F.explode_outer(windows).alias("s")).select("doc_id", "row", "s.*")


def repeated_lines(docs: DataFrame, size: int = 3) -> DataFrame:
    """(doc_id, row, lines): line numbers covered by a later occurrence of a window.

    The first occurrence of a window is the one with the smallest (doc_id,
    row, at); all others cover their lines.  First occurrences come from a partial
    aggregate, and only repeated keys are joined back (AQE splits a key that
    very many documents share, as both join sides are plain shuffles).  The
    repeated keys grow with the documents, so they are never broadcast: the
    plan is the same at every size.
    """
    windows = line_windows(docs, size)
    first = materialize(
        windows.groupBy("key").agg(F.min(F.struct("doc_id", "row", "at")).alias("first"), F.count("*").alias("n"))
        .filter("n > 1").select(F.col("key").alias("k"), F.col("first.doc_id").alias("d"), F.col("first.row").alias("r"), F.col("first.at").alias("p")),
        "line-windows")
    later = windows.join(first.hint("merge"), F.expr("key = k")).filter("NOT (doc_id = d AND row = r AND at = p)")
    return later.groupBy("doc_id", "row").agg(F.array_distinct(F.flatten(F.collect_list("lines"))).alias("lines"))


def dedup_lines(docs: DataFrame, size: int = 3) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_removed (non-blank lines) and the kept text.

    Lines are compared without surrounding ASCII white space; blank lines
    belong to no window and stay.  A removed line's text always stays at the
    first occurrence of its window, or where that line itself is first.  Null
    text: no lines, the kept text is null.  Null id: nothing removed.  Rows
    that share an id but not the text are documents of their own, in the
    order of their texts' hashes; exactly repeated rows share one first
    occurrence and stay alike.
    """
    side = materialize(repeated_lines(docs, size), "covered-lines").hint("merge")
    joined, own, (_, _, covered) = with_side(pick(docs, "doc_id", "text"), side, "doc_id", text_col="text")
    doc_id, text = own
    d = joined.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), _lines(F.col(text)).alias("x"),
                      F.coalesce(F.col(covered), F.array().cast("array<int>")).alias("c"))
    keep = F.array_except(F.sequence(F.lit(0), F.size("x") - 1), F.col("c"))
    kept = F.array_join(F.transform(keep, lambda i: F.coalesce(F.get("x", i), F.lit(""))), "\n")
    return d.select(
        "doc_id", F.size(F.filter("x", lambda s: s.rlike(r"[^ \t-\r]"))).cast("long").alias("n_lines"),
        F.size("c").cast("long").alias("n_removed"),
        F.when(F.size("c") == 0, F.col("text")).otherwise(kept).alias("text"))


def replace_lines(docs: DataFrame, size: int = 3) -> DataFrame:
    """``docs`` with repeated lines cut from its text (see :func:`dedup_lines`) and n_chars set anew; columns and rows unchanged."""
    side = materialize(repeated_lines(docs, size), "covered-lines").hint("merge")
    joined, own, (_, _, covered) = with_side(docs, side, "doc_id", text_col="text")
    text = own[docs.columns.index("text")]
    lines = _lines(F.col(text))
    keep = F.array_except(F.sequence(F.lit(0), F.size("_x") - 1), F.col(covered))
    cut = F.array_join(F.transform(keep, lambda i: F.coalesce(F.get("_x", i), F.lit(""))), "\n")
    d = joined.withColumn("_x", lines).withColumn(
        text, F.when(F.col(covered).isNull(), F.col(text)).otherwise(cut))
    if "n_chars" in docs.columns:
        n = own[docs.columns.index("n_chars")]
        d = d.withColumn(n, F.when(F.col(covered).isNull(), F.col(n)).otherwise(F.length(text).cast("long")))
    return d.select(*own).toDF(*docs.columns)
