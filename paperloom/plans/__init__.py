"""User-level jobs, composed from sources, operators and sinks."""

from paperloom.plans.embedding import backlog_and_split, embed_whole, merge_artifacts, merge_history, run_ledgered, run_tasks
from paperloom.plans.harvest import harvest_feed, harvest_window, harvest_years
from paperloom.plans.merge import merge_increment, upsert_years

__all__ = [
    "backlog_and_split",
    "embed_whole",
    "harvest_feed",
    "harvest_window",
    "harvest_years",
    "merge_artifacts",
    "merge_history",
    "merge_increment",
    "run_ledgered",
    "run_tasks",
    "upsert_years",
]
