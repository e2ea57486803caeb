"""Results that outlive a micro-batch, kept as small stored tables (R1, R4, A9 on streams).

A stream's window state belongs to the engine; what is told from its output
(which alarms have fired, the best row so far) is folded per epoch into a
table in a shared folder.  Epoch N reads the table of epoch N - 1 and writes
its own, in two slots by turns.  A replayed epoch reads the same table and
overwrites what it wrote, so nothing is counted or fired twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions.time import as_event_time
from ledgerlens.streaming.jobs import BatchWriter

#: (what is stored, the batch) to (what to store, what to put out or None)
Fold = Callable[[DataFrame | None, DataFrame], tuple[DataFrame, DataFrame | None]]


def drop_replays(
    df: DataFrame,
    keys: Sequence[str],
    ts: str = "timestamp",
    watermark: str = "1 second",
) -> DataFrame:
    """``df`` with one row per ``keys``: a replayed message counts once.

    ``keys`` name a message: ``("topic", "partition", "offset")`` where the
    same log is read again, or the source's own id where a producer sends
    twice.  On a stream a key is held until the watermark (``watermark``
    behind the newest ``ts``) passes it, so state is bounded by the replays'
    delay, not by the stream's length; a copy that comes later than that is
    late data.  A batch frame is deduplicated as a whole.
    """
    if not df.isStreaming:
        return df.dropDuplicates(list(keys))
    return as_event_time(df, ts).withWatermark(ts, watermark).dropDuplicatesWithinWatermark(list(keys))


def stored(df: DataFrame, path: str, epoch: int) -> DataFrame | None:
    """The table that ``epoch`` stored in ``path``, if it did."""
    if epoch < 0:
        return None
    try:
        table = df.sparkSession.read.parquet(f"{path}/slot={epoch % 2}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return table.filter(F.col("_epoch") == epoch).drop("_epoch")


def folded(path: str, fold: Fold, out: str | None = None) -> BatchWriter:
    """A batch writer that folds every epoch into the table stored in ``path``.

    ``fold`` gets the table of the epoch before (None for the first) and the
    batch; it returns the new table and, for ``out``, rows that go to
    ``<out>/epoch=N``.  Both are written whole before the epoch is committed.
    """
    def write(batch: DataFrame, epoch_id: int) -> None:
        state, rows = fold(stored(batch, path, epoch_id - 1), batch)
        if out is not None and rows is not None:
            rows.write.mode("overwrite").parquet(f"{out}/epoch={epoch_id}")
        state.withColumn("_epoch", F.lit(epoch_id).cast("bigint")).write.mode("overwrite").parquet(f"{path}/slot={epoch_id % 2}")

    return write


def best_row(path: str, order: Sequence, out: str | None = None) -> BatchWriter:
    """A batch writer that keeps the first row by ``order`` of all it has met.

    With update mode a window comes again whenever its count grows, so the
    stored row is the complete-mode top row after every epoch, in the space of
    one row: neither the sink nor the engine keeps closed windows.
    """
    def fold(before: DataFrame | None, batch: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        rows = batch if before is None else before.unionByName(batch)
        best = rows.orderBy(*order).limit(1)
        return best, best

    return folded(path, fold, out)


def first_alarms(
    path: str,
    out: str,
    keys: Sequence[str] = ("start", "end"),
    flag: str | None = None,
    delay: str = "1 second",
) -> BatchWriter:
    """A batch writer that puts each alarm out once, in the epoch it first appears.

    Alarms are rows of ``batch`` (those whose ``flag`` is true) in update
    mode: as soon as a window passes the threshold, and not again when its
    count grows, when an epoch is replayed or after a restart.  The fired
    ``keys`` (with ``start`` and ``end``) are held while their window can
    still change: until its end is ``delay``, the stream's watermark, behind
    the newest window that an earlier epoch had.
    """
    names = list(keys)

    def fold(before: DataFrame | None, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
        alarms = batch.filter(flag) if flag else batch
        kind = batch.schema["start"].dataType
        newest = F.lit(batch.agg(F.max("start")).first()[0]).cast(kind)  # one value
        held = alarms.limit(0).select(*names, F.lit(None).cast(kind).alias("_newest")) if before is None else before
        fired = held.select(*[F.col(k).alias(f"_{k}") for k in names])
        same = F.lit(True)
        for k in names:
            same &= F.col(k).eqNullSafe(F.col(f"_{k}"))
        fresh = alarms.join(fired, same, "left_anti")
        # how far the stream is, as of the epoch before: the engine's watermark is never behind that by more than the delay
        open_still = F.col("_newest").isNull() | (F.col("end") > F.col("_newest") - F.expr(f"INTERVAL {delay}"))
        kept = held.filter(open_still).select(*names, "_newest").unionByName(
            fresh.select(*names, F.lit(None).cast(kind).alias("_newest")))
        state = kept.select(*names, F.greatest("_newest", newest).alias("_newest"))
        return state, fresh

    return folded(path, fold, out)


def read_epochs(df: DataFrame, out: str, schema: T.StructType | None = None) -> DataFrame:
    """All rows of the epoch folders below ``out`` (of Parquet), without the epoch."""
    reader = df.sparkSession.read
    reader = reader.schema(schema) if schema is not None else reader
    return reader.parquet(out).drop("epoch")
