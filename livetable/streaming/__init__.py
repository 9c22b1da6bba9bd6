"""Structured Streaming: event-time operators, sinks, triggers, checkpoints,
stream–static joins and two-stage de-duplication."""

from livetable.streaming.dedup import read_batch_distinct, start_batch_distinct
from livetable.streaming.eventtime import (dedup_counts, dedup_within,
                                           windowed_count, with_event_time)
from livetable.streaming.joins import (read_join_output,
                                       start_stream_static_join, stream_static_join)
from livetable.streaming.progress import ProgressLog
from livetable.streaming.sinks import (foreach_batch_outputs, jdbc_append_idempotent,
                                       jdbc_snapshot, latest_updates, read_snapshot,
                                       run_available_now, start_query, wait_query)

__all__ = ["dedup_counts", "dedup_within", "windowed_count", "with_event_time",
           "foreach_batch_outputs", "jdbc_append_idempotent", "jdbc_snapshot",
           "latest_updates", "read_snapshot", "run_available_now", "start_query", "wait_query",
           "read_batch_distinct", "start_batch_distinct", "ProgressLog",
           "read_join_output", "start_stream_static_join", "stream_static_join"]
