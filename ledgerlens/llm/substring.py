"""Substring dedup by level-wise doubling (operator 2).

Level 0 looks at short windows, and at one of them per neighbourhood only:
the smallest hash among the short windows of each full window (a repeated full
window repeats its smallest short window too).  Short windows met in one
document alone end there; full windows are built around the others only, at
about twice the length.  :func:`longest_repeats` goes on doubling until
nothing survives.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm._tables import materialize, pick, text_or_empty, with_side
from ledgerlens.llm._words import PLAIN, U64, WordHasher, parts, whole, windows


def _least_short(words: np.ndarray, first: np.ndarray, window: int, short: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all short windows, the least one inside each full window, and which full windows lie in one text."""
    grams = windows(words, short)
    m = max(0, len(words) - window + 1)
    least = grams[:m].copy()
    for j in range(1, window - short + 1):
        np.minimum(least, grams[j:j + m], out=least)
    return grams, least, whole(first, window, m)


def _anchors(docs: DataFrame, window: int, short: int) -> DataFrame:
    """(doc_id, h): per document the distinct least short windows of its full windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(PLAIN)
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for part in parts(texts):
                words, first = hasher.words(texts[part])
                _, least, ok = _least_short(words, first, window, short)
                at = np.flatnonzero(ok)
                doc, least = np.searchsorted(first, at, side="right") - 1, least[at]
                order = np.lexsort((least, doc))
                doc, least = doc[order], least[order]
                new = np.ones(len(doc), bool)
                new[1:] = (doc[1:] != doc[:-1]) | (least[1:] != least[:-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[part][doc[new]], pa.int64()), pa.array(least[new].view(np.int64))], ["doc_id", "h"])

    return docs.mapInArrow(run, "doc_id long, h long")


def _candidates(marked: DataFrame, window: int, short: int) -> DataFrame:
    """(doc_id, at, h1, h2): full windows (96-bit hash) whose least short window is among the document's ``hs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, other = WordHasher(PLAIN), WordHasher(PLAIN, seed=2)
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            marks = batch.column("hs")
            for part in parts(texts):
                words, first = hasher.words(texts[part])
                second, _ = other.words(texts[part])
                _, least, ok = _least_short(words, first, window, short)
                h1, h2 = windows(words, window), windows(second, window)
                at = np.flatnonzero(ok)
                doc = np.searchsorted(first, at, side="right") - 1
                mine = np.zeros(len(at), bool)
                begin = np.searchsorted(doc, np.arange(part.stop - part.start + 1))
                for i in range(part.stop - part.start):  # each document against its own marks
                    span = slice(begin[i], begin[i + 1])
                    own = marks[part.start + i].values.to_numpy().view(U64)
                    mine[span] = np.isin(least[at[span]], own)
                at, doc = at[mine], doc[mine]
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids[part][doc], pa.int64()), pa.array((at - first[doc]).astype(np.int32)),
                    pa.array(h1[at].view(np.int64)), pa.array((h2[at] >> U64(32)).astype(np.uint32).view(np.int32))], ["doc_id", "at", "h1", "h2"])

    return marked.mapInArrow(run, "doc_id long, at int, h1 long, h2 int")


def repeated_windows(docs: DataFrame, window: int = 13) -> DataFrame:
    """(doc_id, at, h1, h2, first): windows that start in two documents or more; ``first`` is the smallest of those.

    Per level one partial aggregate finds the repeated hashes and one join
    marks their rows; only marked rows reach the next level.  Every document
    gives a short window once, so a key holds one row per document at most;
    the joins are of plain shuffles, which AQE splits where a passage is very
    common.  Windows are compared by 96 bits of hash: among n different ones
    about n^2 / 2^97 pairs agree by chance (1e-3 at 1.5e13 windows, 100 TB).
    """
    d = pick(docs, "doc_id", "text").filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("long"), text_or_empty(F.col("text")).alias("text"))
    short = (window + 1) // 2
    anchors = _anchors(d, window, short)
    twice = materialize(anchors.groupBy("h").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
                        .filter("low < high").select(F.col("h").alias("_h")), "short-windows")
    marks = materialize(anchors.join(twice, F.expr("h = _h")).groupBy("doc_id").agg(F.collect_set("h").alias("hs")), "marks")
    marked = d.join(marks.withColumnRenamed("doc_id", "_id"), F.expr("doc_id = _id")).select("doc_id", "text", "hs")
    full = materialize(_candidates(marked, window, short), "windows")
    again = materialize(full.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("high"))
                        .filter("first < high").select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), "first"), "repeated")
    return full.join(again, F.expr("h1 = _h1 AND h2 = _h2")).select("doc_id", "at", "h1", "h2", "first")


def longest_repeats(docs: DataFrame, window: int = 13) -> DataFrame:
    """(doc_id, n_words): the longest level (window, 2 * window, ...) at which a window of the document repeats.

    A window of twice the length survives if both halves did and the pair of
    their hashes starts in two documents; levels go on until none survives.
    """
    level = materialize(repeated_windows(docs, window).select("doc_id", "at", "h1", "h2"), "level")
    found, length = level.select("doc_id").distinct().withColumn("n_words", F.lit(window)), window
    while not level.isEmpty():
        tail = level.select(F.col("doc_id").alias("_id"), (F.col("at") - length).alias("_at"), F.col("h1").alias("t1"), F.col("h2").alias("t2"))
        pairs = materialize(level.join(tail, F.expr("doc_id = _id AND at = _at")).select(
            "doc_id", "at", F.xxhash64("h1", "t1").alias("h1"), F.hash("h2", "t2", "h1").alias("h2")), "level")
        again = materialize(pairs.groupBy("h1", "h2").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
                            .filter("low < high").select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2")), "repeated")
        level = materialize(pairs.join(again, F.expr("h1 = _h1 AND h2 = _h2"), "left_semi"), "level")
        length *= 2
        found = found.union(level.select("doc_id").distinct().withColumn("n_words", F.lit(length)))
    return found.groupBy("doc_id").agg(F.max("n_words").alias("n_words"))


def _own(marks: np.ndarray, hashes: np.ndarray, begin: int, end: int, window: int) -> np.ndarray:
    """Starts of those marks (start, 32 bits of hash) that are windows of the text with words begin to end."""
    at = marks >> 32
    inside = at <= end - begin - window
    marks, at = marks[inside], at[inside]
    return at[(hashes[begin + at] & U64(0xFFFFFFFF)) == (marks & 0xFFFFFFFF).astype(U64)]


def _kept(raw: bytes, starts: np.ndarray | None, window: int) -> tuple[int, int, bytes]:
    """Number of words, number of removed words, and the kept words joined by one space."""
    words = raw.split()
    n = len(words)
    if starts is None or not len(starts):
        return n, 0, b" ".join(words)
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, np.minimum(starts, n), 1)
    np.subtract.at(edge, np.minimum(starts + window, n), 1)
    keep = np.cumsum(edge[:n]) == 0
    return n, int(n - keep.sum()), b" ".join(w for w, k in zip(words, keep.tolist()) if k)


def dedup_substrings(docs: DataFrame, window: int = 13) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept (the text left, words joined by one space).

    A word (``[^ \\t-\\r]+``, unchanged) is removed if a window of ``window``
    words that covers it also starts in a document with a smaller doc_id, as
    the input stands.  Null texts have no words.  Rows with a null id lose
    nothing and count for no other row.  Rows that repeat an id are cut each
    by its own windows: a start counts for a row only if 32 bits of the hash of
    the row's window there agree.  Empty tables give empty results.
    """
    starts = materialize(repeated_windows(docs, window).filter("doc_id > first").groupBy("doc_id").agg(F.collect_set(
        F.shiftleft(F.col("at").cast("long"), 32).bitwiseOR(F.col("h1").bitwiseAND(0xFFFFFFFF))).alias("at")), "starts")
    d = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    joined, (doc_id, text), (_, at) = with_side(d, starts, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(PLAIN)
        for batch in batches:
            texts, marks = batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2)
            for part in parts(texts):
                own: dict[int, np.ndarray] = {}
                marked = [i for i in range(part.start, part.stop) if marks[i].is_valid]
                if marked:
                    words, first = hasher.words([texts[i] for i in marked])
                    hashes = windows(words, window)
                    for n, i in enumerate(marked):
                        own[i] = _own(marks[i].values.to_numpy(), hashes, first[n], first[n + 1], window)
                rows = [_kept(texts[i] or b"", own.get(i), window) for i in range(part.start, part.stop)]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(part.start, len(rows)), pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([r[2] for r in rows], pa.binary()).cast(pa.string())],
                    ["doc_id", "n_words", "n_removed", "kept"])

    return joined.select(doc_id, text, at).mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")
