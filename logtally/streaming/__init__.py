from logtally.streaming.pacing import Pace, run_paced
from logtally.streaming.progress import BatchMetrics, batch_timings
from logtally.streaming.redelivery import without_redelivered
from logtally.streaming.sinks import start_archive, start_console, start_fan_out, start_parquet_sink, start_preview
from logtally.streaming.starting import StopRequest
from logtally.streaming.state import start_running_count, start_state_summary, start_stored_batches, state_summary, state_totals, stored_rows
from logtally.streaming.summary import start_summary
from logtally.streaming.watermark import daily_counts

__all__ = [
    "BatchMetrics",
    "Pace",
    "StopRequest",
    "batch_timings",
    "daily_counts",
    "run_paced",
    "start_archive",
    "start_console",
    "start_fan_out",
    "start_parquet_sink",
    "start_preview",
    "start_running_count",
    "start_state_summary",
    "start_stored_batches",
    "start_summary",
    "state_summary",
    "state_totals",
    "stored_rows",
    "without_redelivered",
]
