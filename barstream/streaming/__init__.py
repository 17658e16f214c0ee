"""Continuous jobs built from the operators and sinks."""

from .dashboard import dashboard_stream, read_dashboard
from .fanout import OUTPUT_MODES, await_queries, run_pipeline, start_once, start_pipeline
from .metrics import FlowMetrics, flow_counters, listening, observe_flow
from .replay import replay_messages, stage_replay
from .report import read_report, read_report_ticks, report_stream
from .resample import late_rows, resample_stream

__all__ = [
    "FlowMetrics",
    "OUTPUT_MODES",
    "await_queries",
    "dashboard_stream",
    "flow_counters",
    "late_rows",
    "listening",
    "observe_flow",
    "read_dashboard",
    "read_report",
    "read_report_ticks",
    "replay_messages",
    "report_stream",
    "resample_stream",
    "run_pipeline",
    "stage_replay",
    "start_once",
    "start_pipeline",
]
