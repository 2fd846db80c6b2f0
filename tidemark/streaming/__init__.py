from tidemark.streaming.changes import CHANGE, first_changes
from tidemark.streaming.lake import read_compacted_lake, to_compacted_lake
from tidemark.streaming.late import split_late
from tidemark.streaming.queries import (
    await_any,
    await_query,
    latest_per_key,
    run_to_table,
    scratch_folder,
    settled,
    word_count_per_batch,
)
from tidemark.streaming.result_table import read_result, run_to_result
from tidemark.streaming.session_state import event_time_sessions, open_sessions, processing_time_sessions
from tidemark.streaming.state import open_gap_sessions, open_groups, state_variable
from tidemark.streaming.sinks import to_console, to_memory, to_parquet_lake, write_lake

__all__ = [
    "CHANGE",
    "await_any",
    "await_query",
    "event_time_sessions",
    "first_changes",
    "latest_per_key",
    "open_gap_sessions",
    "open_groups",
    "open_sessions",
    "processing_time_sessions",
    "read_compacted_lake",
    "read_result",
    "run_to_result",
    "run_to_table",
    "scratch_folder",
    "settled",
    "split_late",
    "state_variable",
    "to_compacted_lake",
    "to_console",
    "to_memory",
    "to_parquet_lake",
    "word_count_per_batch",
    "write_lake",
]
