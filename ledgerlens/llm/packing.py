"""Optimal length buckets and token-budget batches (operator 1).

The lengths of all documents become one exact histogram; dynamic programming
over it places the bucket boundaries that waste the least padding; batches of a token budget are then numbered inside each bucket
without ever gathering a bucket in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm._tables import materialize, pick, text_or_empty

#: Rows numbered by one task; a bucket of n rows is dealt over n / CHUNK_ROWS tasks.
CHUNK_ROWS = 100_000


def word_count(text: Column) -> Column:
    """Words ``[^ \\t-\\r]+`` of a text (null: 0): the default token count."""
    return F.size(F.filter(F.split(text_or_empty(text), r"[ \t-\r]+"), lambda w: w != "")).cast("long")


def histogram(lengths: DataFrame) -> DataFrame:
    """(length, n): documents per distinct length.

    m distinct lengths add up to m * m / 2 at least, so a corpus of T words
    has at most ``sqrt(2 * T)`` of them (5.7 million at 100 TB, if every
    length up to there occurred once).
    """
    return lengths.groupBy("length").agg(F.count("*").alias("n"))


def _layer(best: np.ndarray, top: np.ndarray, count: np.ndarray, mass: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
    """Least waste of the first j lengths in ``b`` buckets, and where the last of these begins, from ``best`` for b - 1.

    The earliest best split does not fall as j grows (the waste of a bucket
    meets the quadrangle inequality), so the split of a middle j bounds those
    of both halves: m * log(m) comparisons, all ranges of a round at once.
    """
    m = len(top)
    now, split = np.zeros_like(best), np.zeros(m + 1, np.int32)
    a, z, low, high = (np.array([x]) for x in (b, m, b - 1, m - 1))
    while len(a):
        mid = (a + z) // 2
        size = np.minimum(high, mid - 1) - low + 1
        begin = np.cumsum(size) - size
        owner = np.repeat(np.arange(len(mid)), size)
        i, j = np.arange(len(owner)) - (begin - low)[owner], mid[owner]
        total = best[i] + top[j - 1] * (count[j] - count[i]) - (mass[j] - mass[i])
        least = np.minimum.reduceat(total, begin)
        hit = np.flatnonzero(total == least[owner])
        at = i[hit[np.unique(owner[hit], return_index=True)[1]]]
        now[mid], split[mid] = least, at
        left, right = a < mid, mid < z
        a, z, low, high = (np.concatenate([x[left], y[right]]) for x, y in ((a, mid + 1), (mid - 1, z), (low, at), (at, high)))
    return now, split


def best_boundaries(lengths: Sequence[int], n: Sequence[int], buckets: int) -> list[int]:
    """Bucket upper lengths that minimise the padded positions, at most ``buckets`` of them.

    ``lengths`` is increasing, with ``n`` documents each; a bucket pads its
    documents to its longest, so lengths i..j in one bucket cost
    ``sum(n[k] * (lengths[j] - lengths[k]))``.
    cost[b][j] = min over i of cost[b - 1][i] + waste(i + 1, j): exact dynamic
    programming over all splits.  Ties take the smaller split.
    """
    m = len(lengths)
    if not m:
        return []
    # whole numbers, unless they would leave 64 bits
    kind = np.int64 if int(lengths[-1]) * sum(map(int, n)) < 1 << 62 else np.float64
    top = np.array(lengths, kind)
    count = np.concatenate([[0], np.cumsum(np.array(n, kind))]).astype(kind)
    mass = np.concatenate([[0], np.cumsum(np.array(n, kind) * top)]).astype(kind)
    # best[j]: the least waste of the first j lengths with the buckets so far
    best = np.concatenate([[0], top * count[1:] - mass[1:]]).astype(kind)
    splits = []
    for b in range(2, min(buckets, m) + 1):
        best, split = _layer(best, top, count, mass, b)
        splits.append(split)
    ends, j = [], m
    for split in reversed(splits):
        ends.append(int(lengths[j - 1]))
        j = int(split[j])
    ends.append(int(lengths[j - 1]))
    return ends[::-1]


def pack(lengths: DataFrame, buckets: int = 16, token_budget: int = 16_384,
         chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Bucket and batch every row of ``lengths`` (doc_id, length).

    Returns doc_id, n_tokens, bucket (0 is the shortest), bucket_length (what
    its documents are padded to), batch and slot (from 0 inside the bucket),
    padding (bucket_length - n_tokens) and over_budget.  A batch holds
    ``max(1, token_budget // bucket_length)`` documents, so its padded size is
    within the budget unless a single document is longer (over_budget); only
    the last batch of a bucket may be short.  Whole documents are packed, none
    is cut or dropped.

    A null length counts as 0, and so does a negative one.  Null ids and
    repeated rows are packed like any other row.  Empty input gives an empty
    result.  The driver sees the histogram only (see :func:`histogram`).
    """
    spark = lengths.sparkSession
    d = materialize(pick(lengths, "doc_id", "length").select(
        "doc_id", F.greatest(F.coalesce(F.col("length"), F.lit(0)), F.lit(0)).cast("long").alias("length")), "lengths")
    seen = histogram(d).toArrow().sort_by("length")
    known, n = (seen[c].to_numpy() for c in ("length", "n"))
    ends = best_boundaries(known, n, buckets) or [0]
    # documents per bucket, for the number of chunks each bucket is dealt into
    held = np.bincount(np.searchsorted(ends, known), weights=n, minlength=len(ends)).astype(np.int64).tolist()
    table = spark.createDataFrame(
        [(i, int(e), max(1, -(-held[i] // chunk_rows)), max(1, token_budget // max(1, int(e)))) for i, e in enumerate(ends)],
        "bucket int, bucket_length long, chunks long, per_batch long")

    lower = F.array(*[F.lit(int(e)).cast("long") for e in ends])
    d = d.withColumn("bucket", F.size(F.filter(lower, lambda e: e < F.col("length"))))
    d = d.join(F.broadcast(table), "bucket")  # at most `buckets` rows
    d = d.withColumn("chunk", F.expr("pmod(xxhash64(doc_id, length), chunks)"))
    sizes = materialize(d.groupBy("bucket", "chunk").agg(F.count("*").alias("n")), "chunk-sizes")
    offsets = sizes.select(
        F.col("bucket").alias("_bucket"), F.col("chunk").alias("_chunk"),
        F.expr("sum(n) OVER (PARTITION BY bucket ORDER BY chunk) - n").alias("offset"))
    d = d.withColumn("rank", F.expr(
        "row_number() OVER (PARTITION BY bucket, chunk ORDER BY doc_id, length) - 1").cast("long"))
    d = d.join(offsets, F.expr("bucket = _bucket AND chunk = _chunk"))
    at = F.expr("offset + rank")
    return d.select(
        "doc_id", F.col("length").alias("n_tokens"), "bucket", "bucket_length",
        F.expr("(offset + rank) DIV per_batch").alias("batch"), (at % F.col("per_batch")).alias("slot"),
        (F.col("bucket_length") - F.col("length")).alias("padding"),
        (F.col("length") > token_budget).alias("over_budget"))


def pack_documents(docs: DataFrame, buckets: int = 16, token_budget: int = 16_384) -> DataFrame:
    """:func:`pack` with every document's word count as its length (null text: 0)."""
    d = pick(docs, "doc_id", "text").select("doc_id", word_count(F.col("text")).alias("length"))
    return pack(d, buckets, token_budget)
