"""Reading, writing and publishing tables."""

from .commits import (
    Written,
    commit,
    commits,
    discard,
    published,
    published_runs,
    remove_unpublished,
)
from .layout import layer_path, log_path, new_run_id
from .readers import read_layer, read_run, read_transactions_csv
from .scratch import scratch_path
from .writers import stage_layer, write_layer

__all__ = [
    "Written",
    "commit",
    "commits",
    "discard",
    "layer_path",
    "log_path",
    "new_run_id",
    "published",
    "published_runs",
    "read_layer",
    "read_run",
    "read_transactions_csv",
    "remove_unpublished",
    "scratch_path",
    "stage_layer",
    "write_layer",
]
