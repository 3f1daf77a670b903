"""Materialise query results as analytics tables, whole or above a high-water mark."""

from tidemark.operators.runlog import run_transfers, transfer_status
from tidemark.operators.stats import table_sizes, table_stats
from tidemark.operators.steps import apply_steps
from tidemark.operators.transfer import TransferResult, transfer
from tidemark.plans.spec import JdbcSource, Layout, Step, TransferSpec
from tidemark.streaming.append import repeat_transfer, stream_append

__all__ = [
    "JdbcSource", "Layout", "Step", "TransferResult", "TransferSpec", "apply_steps", "repeat_transfer",
    "run_transfers", "stream_append", "table_sizes", "table_stats", "transfer", "transfer_status",
]
