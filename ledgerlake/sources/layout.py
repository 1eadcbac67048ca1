"""Where the layers of a run are stored."""

from __future__ import annotations

import re
import uuid
from datetime import datetime, timezone

# What readers of a folder must not take for data begins with an underscore.
LOG, _ATTEMPT = "_commits", "_attempt-"


def new_run_id() -> str:
    """A run id that sorts by start time and that no other run gets."""
    now = datetime.now(timezone.utc)
    return f"{now:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"


def new_commit_id() -> str:
    """Sorts by the time it was made, to the microsecond."""
    return f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def layer_path(base: str, layer: str, run_id: str) -> str:
    """``<base>/<layer>/run_id=<run_id>``, the place of a run's layer.

    Works on any file system Spark can reach. Runs do not touch each other;
    repeating a run id replaces what readers of this place see.
    """
    return f"{base.rstrip('/')}/{layer}/run_id={run_id}"


def attempt_path(target: str) -> str:
    """A new folder for the data of one write to ``target``.

    Its name is hidden from readers of the folders above it, so that data which
    was never published is not found by chance.
    """
    return f"{target.rstrip('/')}/{_ATTEMPT}{new_commit_id()}"


def is_attempt(name: str) -> bool:
    return name.startswith(_ATTEMPT)


def log_path(target: str) -> str:
    """The log whose commits publish a place: its lake's for a run's layer, else its own."""
    lake = re.fullmatch(r"(.+)/[^/]+/run_id=[^/]+", target.rstrip("/"))
    return f"{lake[1] if lake else target.rstrip('/')}/{LOG}"
