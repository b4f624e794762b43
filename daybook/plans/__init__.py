"""Composite jobs (backfill, daily, table creation) and their command line."""

from daybook.plans.jobs import (
    create_table,
    merge_dimension,
    merge_into_bucketed_dimension,
    refresh_bucketed_dimension,
    refresh_dimension,
    run_backfill,
    run_catch_up,
    run_daily,
    run_repair,
    run_repair_in_buckets,
    yesterday,
)

__all__ = [
    "create_table",
    "merge_dimension",
    "merge_into_bucketed_dimension",
    "refresh_bucketed_dimension",
    "refresh_dimension",
    "run_backfill",
    "run_catch_up",
    "run_daily",
    "run_repair",
    "run_repair_in_buckets",
    "yesterday",
]
