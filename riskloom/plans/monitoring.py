"""Monitoring and retraining cycles as run-once-per-day jobs.

A cycle is a chain of steps. The result of each finished step is kept in a journal, so a run that is cut
off goes on behind its last finished step; a step that was cut off itself runs again and leaves what
one run would have left.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import date, datetime
from typing import Any

from pyspark.sql import DataFrame, functions as F

from riskloom.operators import cleaning as CL, decisions as DC, drift as DR, ordered as R
from riskloom.plans import training as T
from riskloom.sources import files as FS
from riskloom.sources.registry import Registry, log_run
from riskloom.sources.tables import TableStore, utc_now


class Interrupted(RuntimeError):
    """A drill has stopped the job behind a step."""


class Journal:
    """Finished steps of one job and day. ``stop_after`` names the step behind which a drill stops."""

    def __init__(self, store: TableStore, job: str, at: datetime, stop_after: str | None = None):
        self.store, self.job, self.at, self.stop_after, self.position = store, job, at, stop_after, 0

    @property
    def run_id(self) -> str:
        """The same for every attempt of the job on its day."""
        return f"{self.job}-{self.at:%Y-%m-%d}"

    def finished(self) -> DataFrame:
        rows = self.store.read("job_step")
        return rows.where((F.col("job") == self.job) & (F.col("day") == F.lit(self.at.date())))

    def step(self, name: str, action: Callable[[], dict[str, Any]]) -> dict[str, Any]:
        """The step's result: from the journal, or from running it now."""
        self.position += 1
        known = self.finished().where(F.col("step") == name).agg(F.min("result_json")).first()[0]
        if known is None:
            known = json.dumps(action(), default=str)
            self.store.append_row(
                "job_step", job=self.job, day=self.at.date(), step=name, position=self.position, result_json=known, finished_at=utc_now()
            )
            if name == self.stop_after:
                raise Interrupted(name)
        return json.loads(known)


def once_per_day(
    store: TableStore, job: str, action: Callable[[Journal], dict[str, Any]], now: datetime | None = None, stop_after: str | None = None,
) -> dict[str, Any]:
    """Run a job unless it already succeeded that UTC day; store the outcome."""
    at = now or utc_now()
    wanted = store.spark.createDataFrame([(job, at.date())], "job string, day date")
    if DC.due_jobs(wanted, store.read("job_run")).isEmpty():
        return {"job": job, "status": "skipped", "reason": "already_succeeded_today"}
    result = action(Journal(store, job, at, stop_after))
    store.append_row(
        "job_run", job=job, day=at.date(), status="succeeded",
        result_json=json.dumps(result, default=str), finished_at=at,
    )
    return {"job": job, "status": "succeeded", **result}


def drift_report(reference: DataFrame, current: DataFrame, columns=None) -> tuple[DataFrame, DataFrame]:
    """(features, summary) of two tables, stored so that several sinks share one run."""
    features = R.kept(DR.drift_features(reference, current, columns))
    return features, R.kept(DR.drift_summary(features, reference, current))


def last_alert(store: TableStore, subject: str, before: datetime) -> DataFrame:
    """The newest state written before a moment, so a repeated run doesn't see its own."""
    return (
        store.read("alert_state").where((F.col("subject") == subject) & (F.col("written_at") < F.lit(before)))
        .orderBy(F.col("written_at").desc()).limit(1).select("triggered_at", "resolved_at")
    )


def monitoring_cycle(
    store: TableStore, reference: DataFrame, current: DataFrame, report_path: str,
    now: datetime | None = None, subject: str = "drift", batch_id: str | None = None,
    notify: Callable[[dict[str, Any]], None] | None = None, stop_after: str | None = None,
) -> dict[str, Any]:
    """Clean both sides, measure drift, apply the alert rule, store report and state."""
    at = now or utc_now()

    def measure() -> dict[str, Any]:
        features, summary = drift_report(R.kept(CL.clean(reference)), R.kept(CL.clean(current)))
        FS.write_report(features, summary, report_path)
        affected = DC.affected_features(features).first()
        return {"status": summary.first()["status"], "affected_features": affected["affected_features"], "max_psi": affected["max_psi"]}

    def keep(run_id: str) -> dict[str, Any]:
        document = store.spark.read.schema(FS.REPORT).option("multiLine", True).json(report_path)
        store.save_drift_report(batch_id, document, run_id=run_id)
        return {"batch_id": batch_id}

    def decide(measured: dict[str, Any]) -> dict[str, Any]:
        previous = last_alert(store, subject, at)
        row = DC.alert_step(
            store.spark.range(1).select(
                F.lit(measured["status"]).alias("status"), F.lit(at).alias("now"),
                previous.select("triggered_at").scalar().alias("triggered_at"),
                previous.select("resolved_at").scalar().alias("resolved_at"),
            )
        ).first()
        if row["should_alert"] or row["should_resolve"]:
            _write_state(store, subject, at, row)
        return {
            "status": row["status"], "should_alert": row["should_alert"], "should_resolve": row["should_resolve"],
            "affected_features": measured["affected_features"] if row["status"] == "alert" else [],
            "max_psi": measured["max_psi"],
        }

    def tell(decision: dict[str, Any]) -> dict[str, Any]:
        if decision["should_alert"] or decision["should_resolve"]:
            _tell(notify, {"event": "drift_alert" if decision["should_alert"] else "drift_resolved", **decision})
        return {}

    def action(journal: Journal) -> dict[str, Any]:
        measured = journal.step("report", measure)
        if batch_id:
            journal.step("store_report", lambda: keep(journal.run_id))
        decision = journal.step("alert", lambda: decide(measured))
        journal.step("notify", lambda: tell(decision))
        return {"report_path": report_path, "drift_status": decision["status"], "alert": decision}

    return once_per_day(store, "monitoring", action, at, stop_after)


def _write_state(store: TableStore, subject: str, at: datetime, row) -> None:
    triggered = at if row["should_alert"] else row["triggered_at"]
    store.append_row(
        "alert_state", subject=subject, triggered_at=triggered,
        resolved_at=None if row["should_alert"] else at, written_at=at,
    )


def _tell(notify: Callable[[dict[str, Any]], None] | None, event: dict[str, Any]) -> None:
    """A failing notification never fails the job that has already done its work."""
    if notify is None:
        return
    try:
        notify(event)
    except Exception as error:  # noqa: BLE001
        print(f"notification failed: {error}")


def retraining_cycle(
    store: TableStore, raw: DataFrame, catalogue: DataFrame, report_path: str, bundle_path: str,
    trained_on: date, labels_available: bool, performance_alert: bool = False,
    now: datetime | None = None, model_name: str = "cohort-risk",
    notify: Callable[[dict[str, Any]], None] | None = None, stop_after: str | None = None, **train_options,
) -> dict[str, Any]:
    """Decide on retraining; when due, fit a candidate and register it for review."""
    at = now or utc_now()
    registry = Registry(store, model_name)

    def decide() -> dict[str, Any]:
        _, summary = FS.read_report(store.spark, report_path)
        newest = registry.versions().agg(F.max("created_at").cast("date")).scalar()
        row = DC.retraining_decision(
            summary.select(
                F.coalesce("status", F.lit("missing")).alias("drift_status"),
                F.coalesce(newest, F.lit(trained_on)).alias("trained_on"), F.lit(at.date()).alias("as_of"),
                F.lit(labels_available).alias("labels_available"),
                F.lit(performance_alert).alias("performance_alert"),
            )
        ).first()
        return {k: row[k] for k in ("action", "should_train_candidate", "requires_human_review", "reasons")}

    def fit() -> dict[str, Any]:
        result = T.train(raw, catalogue, **train_options)
        result.bundle.save(bundle_path)
        return result.metrics

    def register(metrics: dict[str, Any], run_id: str) -> dict[str, Any]:
        return {"candidate_version": registry.register(metrics, bundle_path, run_id), "run_id": run_id}

    def action(journal: Journal) -> dict[str, Any]:
        decision = journal.step("decide", decide)
        if not decision["should_train_candidate"]:
            return {"decision": decision}
        metrics = journal.step("train", fit)
        journal.step("log", lambda: {"run_id": log_run(store, metrics, journal.run_id)})
        registered = journal.step("register", lambda: register(metrics, journal.run_id))
        payload = {"decision": decision, **registered, "promotion": "human_approval_required"}
        journal.step("notify", lambda: _tell(notify, {"event": "candidate_ready_for_review", "model": model_name, **payload}) or {})
        return payload

    return once_per_day(store, "retraining", action, at, stop_after)
