from tidemark.sources.areas import malformed_areas, read_areas
from tidemark.sources.kafka import kafka_options, pack_envelope, read_kafka
from tidemark.sources.lines import read_lines, read_socket
from tidemark.sources.replay import replay_by_number, replay_by_time, replay_together
from tidemark.sources.tables import (
    FILES_PER_BATCH,
    as_instants,
    as_wall_clock,
    read_table,
    read_table_stream,
)

__all__ = [
    "FILES_PER_BATCH",
    "as_instants",
    "as_wall_clock",
    "kafka_options",
    "malformed_areas",
    "pack_envelope",
    "read_areas",
    "read_kafka",
    "read_lines",
    "read_socket",
    "read_table",
    "read_table_stream",
    "replay_by_number",
    "replay_by_time",
    "replay_together",
]
