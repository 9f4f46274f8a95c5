"""Structured Streaming jobs: incremental landing, running moments, nearest sites."""

from aerocorr.streaming.ingest import (  # noqa: F401
    read_snapshot, start_landing, start_position_moments, stream_readings, with_month,
)
from aerocorr.streaming.nearest import read_nearest, start_nearest  # noqa: F401
from aerocorr.streaming.settlement import settlement_matrix, start_settlement  # noqa: F401
