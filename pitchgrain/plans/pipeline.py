"""The whole run: landing files to staging tables to derived tables, with a run log."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession

from pitchgrain.operators.scope import Scope
from pitchgrain.plans import ingest, runlog
from pitchgrain.sources.landing import Landing
from pitchgrain.sources.warehouse import Warehouse


def run(
    spark: SparkSession,
    source: str,
    warehouse: str,
    competition_id: int = Scope.competition_id,
    season_id: int = Scope.season_id,
    match_ids: Iterable[int] | None = None,
    skip_staging: bool = False,
    skip_analytics: bool = False,
    file_format: str = "json",
    log_run: bool = True,
) -> dict[str, int]:
    """Rows per step. A failure is logged and raised again, and leaves all tables as they were."""
    if skip_staging and skip_analytics:
        raise ValueError("cannot skip both staging and analytics")
    scope = Scope(competition_id, season_id)
    landing = Landing(spark, source, file_format)
    target = Warehouse(spark, warehouse)
    ids = None if match_ids is None else list(match_ids)
    run_id = runlog.start(target, scope) if log_run and not skip_staging else None
    done: dict[str, int] = {}
    try:
        with target.publishing():
            if not skip_staging:
                done |= ingest.run(landing, target, scope, "all", ids)
            if not skip_analytics:
                done |= ingest.aggregate(target, scope, "all", ids)
    except Exception as exc:
        if run_id is not None:
            runlog.finish(target, scope, run_id, runlog.FAILED, error=str(exc))
        raise
    if run_id is not None:
        runlog.finish(
            target, scope, run_id, runlog.SUCCESS, done.get("matches", 0), done.get("events", 0)
        )
    return done
