"""Append-only log of runs: a row when a run starts, another when it ends."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchgrain import schemas as S
from pitchgrain.operators.scope import Scope

RUNNING, SUCCESS, FAILED = "running", "success", "failed"


def _row(warehouse, values: dict) -> None:
    names = S.columns(S.RUNS)
    full = {"source": S.DATA_SOURCE, "logged_at": datetime.now(timezone.utc), **values}
    row = tuple(full.get(n) for n in names)
    warehouse.append("ingestion_runs", warehouse.spark.createDataFrame([row], S.RUNS))


def start(warehouse, scope: Scope) -> str:
    run_id = uuid.uuid4().hex
    _row(
        warehouse,
        {
            "run_id": run_id,
            "competition_id": scope.competition_id,
            "season_id": scope.season_id,
            "started_at": datetime.now(timezone.utc),
            "status": RUNNING,
        },
    )
    return run_id


def finish(
    warehouse,
    scope: Scope,
    run_id: str,
    status: str,
    matches: int = 0,
    events: int = 0,
    error: str | None = None,
) -> None:
    _row(
        warehouse,
        {
            "run_id": run_id,
            "competition_id": scope.competition_id,
            "season_id": scope.season_id,
            "finished_at": datetime.now(timezone.utc),
            "status": status,
            "matches_processed": matches,
            "events_processed": events,
            "error_message": error,
        },
    )


def run_states(log: DataFrame) -> DataFrame:
    """Current state of each run: its latest row, with the time its first row started."""
    latest = F.struct(
        "source", "competition_id", "season_id", "finished_at", "status", "matches_processed",
        "events_processed", "error_message",
    )
    order = F.struct("logged_at", F.col("finished_at").isNotNull())
    return (
        log.groupBy("run_id")
        .agg(F.min("started_at").alias("started_at"), F.max_by(latest, order).alias("last"))
        .select("run_id", "started_at", "last.*")
    )
