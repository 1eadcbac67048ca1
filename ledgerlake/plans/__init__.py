"""Plans that chain sources, operators and sinks."""

from .arrivals import run_arrivals
from .medallion import (
    MALFORMED,
    REASONS,
    ChecksFailed,
    LayerRun,
    MedallionRun,
    Staging,
    clean_layer,
    ingest_layer,
    layer_checks,
    metrics_layer,
    quarantine_reasons,
    run_medallion,
    states_layer,
)
from .reports import metrics_over_runs, rows_by_type
from .sizing import shuffle_partitions, sized_session

__all__ = [
    "MALFORMED",
    "REASONS",
    "ChecksFailed",
    "LayerRun",
    "MedallionRun",
    "Staging",
    "clean_layer",
    "ingest_layer",
    "layer_checks",
    "metrics_layer",
    "metrics_over_runs",
    "quarantine_reasons",
    "rows_by_type",
    "run_arrivals",
    "run_medallion",
    "shuffle_partitions",
    "sized_session",
    "states_layer",
]
