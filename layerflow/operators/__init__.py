"""Row-set operators: dedup, upsert, publish, updates and table snapshots."""

from layerflow.operators.dedup import dedup_latest
from layerflow.operators.publish import MergeCardinalityError, WriteResult, merge_into, publish
from layerflow.operators.update import add_column_with_backfill, update_rows, update_table
from layerflow.operators.upsert import duplicate_keys, merged

__all__ = [
    "MergeCardinalityError", "WriteResult", "add_column_with_backfill", "dedup_latest",
    "duplicate_keys", "merge_into", "merged", "publish", "update_rows", "update_table",
]
