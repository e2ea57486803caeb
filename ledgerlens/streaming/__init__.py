from ledgerlens.streaming.jobs import (
    alarm_rows,
    await_any,
    checkpoint_path,
    console_rows,
    epoch_files,
    materialize,
    start_alarm,
    start_console,
    start_fan_out,
    start_files,
    start_memory,
)
from ledgerlens.streaming.state import best_row, drop_replays, first_alarms, folded, read_epochs, stored

__all__ = [
    "alarm_rows",
    "await_any",
    "best_row",
    "checkpoint_path",
    "console_rows",
    "drop_replays",
    "epoch_files",
    "first_alarms",
    "folded",
    "materialize",
    "read_epochs",
    "start_alarm",
    "start_console",
    "start_fan_out",
    "start_files",
    "start_memory",
    "stored",
]
