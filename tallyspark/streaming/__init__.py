from tallyspark.streaming.runner import (
    BatchReport,
    drain,
    events_stream,
    observed,
    read_complete,
    read_update,
    run_batch_sizes,
    run_complete,
    run_state,
    run_until_threshold,
    run_update,
)
from tallyspark.streaming.staging import events_in_batches, events_in_steps, stage_steps, stream_steps
from tallyspark.streaming.stats import (
    stream_batch_sizes,
    stream_count_sketch,
    stream_distinct_items,
    stream_histogram_and_sketch,
    stream_interval_histogram,
    stream_length,
    stream_until_threshold,
)

__all__ = [
    "BatchReport",
    "drain",
    "events_in_batches",
    "events_in_steps",
    "events_stream",
    "observed",
    "read_complete",
    "read_update",
    "run_batch_sizes",
    "run_complete",
    "run_state",
    "run_until_threshold",
    "run_update",
    "stage_steps",
    "stream_batch_sizes",
    "stream_count_sketch",
    "stream_distinct_items",
    "stream_histogram_and_sketch",
    "stream_interval_histogram",
    "stream_length",
    "stream_steps",
    "stream_until_threshold",
]
