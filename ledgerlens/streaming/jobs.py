"""Starting streaming queries and their sinks.

Every durable sink takes a checkpoint folder: on restart the query resumes
from the last committed offsets and state, and an epoch that is replayed
overwrites its own output instead of appending a second copy.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ledgerlens.session import checkpoint_root

BatchWriter = Callable[[DataFrame, int], None]


def checkpoint_path(spark: SparkSession, name: str) -> str:
    """``<spark.checkpoint.dir>/streams/<name>``."""
    return f"{checkpoint_root(spark)}/streams/{name}"


def _writer(df: DataFrame, mode: str, checkpoint: str | None, trigger: dict | None,
            name: str | None):
    w = df.writeStream.outputMode(mode)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    if name:
        w = w.queryName(name)
    return w


def start_console(
    df: DataFrame,
    mode: str = "complete",
    rows: int = 20,
    trigger: dict | None = None,
    checkpoint: str | None = None,
) -> StreamingQuery:
    """Print each micro-batch result (K3); ``rows`` bounds what reaches the driver."""
    return (_writer(df, mode, checkpoint, trigger, None).format("console")
            .option("truncate", "false").option("numRows", str(rows)).start())


def start_memory(
    df: DataFrame,
    name: str,
    mode: str = "complete",
    checkpoint: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """In-memory table ``name`` (for tests and small interactive results)."""
    return _writer(df, mode, checkpoint, trigger, name).format("memory").start()


def epoch_files(
    path: str,
    fmt: str = "csv",
    files_per_batch: int | None = None,
    **options: str,
) -> BatchWriter:
    """A batch writer putting epoch ``N`` in ``<path>/epoch=N`` (K4).

    The folder is overwritten, so a replayed epoch (after a failure between
    writing and committing) leaves one copy, not two.  ``files_per_batch``
    coalesces each batch to that many files; unset, every task writes its
    own file, so no single task receives the whole batch.
    """
    if fmt == "csv":
        options = {"header": "true", **options}

    def write(batch: DataFrame, epoch_id: int) -> None:
        out = batch.coalesce(files_per_batch) if files_per_batch else batch
        out.write.mode("overwrite").format(fmt).options(**options).save(f"{path}/epoch={epoch_id}")

    return write


def console_rows(rows: int = 20) -> BatchWriter:
    """A batch writer printing up to ``rows`` rows of each micro-batch (only
    those rows reach the driver)."""
    def show(batch: DataFrame, epoch_id: int) -> None:
        print(f"-- epoch {epoch_id}")
        batch.show(rows, truncate=False)

    return show


def alarm_rows(on_alarm: Callable[[object], None], flag: str = "alarm") -> BatchWriter:
    """A batch writer calling ``on_alarm(row)`` on the executors for each row whose ``flag`` is true (K5)."""
    def fire(batch: DataFrame, epoch_id: int) -> None:
        batch.filter(flag).foreach(on_alarm)

    return fire


def start_fan_out(
    df: DataFrame,
    writers: Sequence[BatchWriter],
    checkpoint: str,
    mode: str = "complete",
    trigger: dict | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """One query feeding several sinks.

    Two ``start()`` calls on the same frame run the source, the state and
    every operator twice; here each micro-batch is computed once, cached,
    and handed to every writer.
    """
    def fan_out(batch: DataFrame, epoch_id: int) -> None:
        batch.persist()
        try:
            for write in writers:
                write(batch, epoch_id)
        finally:
            batch.unpersist()

    return _writer(df, mode, checkpoint, trigger, name).foreachBatch(fan_out).start()


def start_files(
    df: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "complete",
    fmt: str = "csv",
    files_per_batch: int | None = None,
    trigger: dict | None = None,
    **options: str,
) -> StreamingQuery:
    """Each micro-batch result as files under ``<path>/epoch=N`` (K4)."""
    return start_fan_out(df, [epoch_files(path, fmt, files_per_batch, **options)],
                         checkpoint, mode, trigger)


def start_alarm(
    alarms: DataFrame,
    on_alarm: Callable[[object], None],
    checkpoint: str,
    mode: str = "update",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Call ``on_alarm(row)`` for every alarm row (K5), on the executors.

    ``alarms`` is e.g. ``threshold_alarm(...)``.  In update mode an alarm
    fires when its window's count changes; in append mode once, when the
    window closes; in complete mode every alarm fires again each trigger.
    """
    return _writer(alarms, mode, checkpoint, trigger, None).foreach(on_alarm).start()


def materialize(df: DataFrame) -> DataFrame:
    """Compute a static frame once and cut its lineage (reliable checkpoint
    under ``spark.checkpoint.dir``), so every micro-batch joining it reads
    the stored result instead of recomputing it.  Lost executors do not lose
    it: it lives in the shared folder, not in executor memory or local disk.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(f"{checkpoint_root(spark)}/frames")
    return df.checkpoint(eager=True)


def await_any(spark: SparkSession, timeout: float | None = None) -> bool | None:
    """Block until any active query ends (K6)."""
    return spark.streams.awaitAnyTermination(timeout)
