"""Retraining, promotion, alerting and run-once rules, for many subjects at a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom import constants as K
from riskloom.operators.cohort import latest_per


def _reasons(*candidates: Column) -> Column:
    return F.array_compact(F.array(*candidates))


def retraining_decision(
    df: DataFrame,
    status: str = "drift_status",
    trained_on: str = "trained_on",
    as_of: str = "as_of",
    labels: str = "labels_available",
    performance: str = "performance_alert",
    interval_days: int = K.ANNUAL_INTERVAL_DAYS,
) -> DataFrame:
    """Action per row from drift, performance, calendar and label availability."""
    due = F.datediff(F.col(as_of), F.col(trained_on)) >= interval_days
    triggers = _reasons(
        F.when(F.col(status) == "alert", F.lit("data_drift_alert")),
        F.when(F.col(performance), F.lit("performance_alert")),
        F.when(due, F.lit("annual_review_due")),
    )
    any_trigger = F.size("_triggers") > 0
    ready = any_trigger & F.col(labels)
    return (
        df.withColumn("_triggers", triggers)
        .withColumns(
            {
                "action": F.when(~any_trigger, "monitor")
                .when(ready, "train_candidate")
                .otherwise("investigate_and_collect_labels"),
                "should_train_candidate": ready,
                "requires_human_review": any_trigger,
                "reasons": F.when(~any_trigger, F.array(F.lit("no_trigger")))
                .when(ready, F.col("_triggers"))
                .otherwise(F.concat("_triggers", F.array(F.lit("fresh_labels_unavailable")))),
            }
        )
        .drop("_triggers")
    )


def promotion_decision(
    df: DataFrame,
    production_recall: str = "production_recall",
    approved: str = "human_approved",
    min_auc: float = K.MIN_AUC,
    min_recall: float = K.MIN_RECALL,
    max_gap: float = K.MAX_FAIRNESS_GAP,
) -> DataFrame:
    """Technical gate per candidate row, then the mandatory human approval.

    Candidate metrics are columns; a NULL is a missing metric and hides the other checks.
    """
    auc, recall, gap = (F.col(c) for c in K.GATE_METRICS)
    absent = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in K.GATE_METRICS]))
    checks = _reasons(
        F.when(auc < min_auc, F.lit(f"auc_below_{min_auc:.2f}")),
        F.when(recall < min_recall, F.lit(f"recall_below_{min_recall:.2f}")),
        F.when(gap > max_gap, F.lit(f"fairness_gap_above_{max_gap:.2f}")),
        F.when(recall < F.col(production_recall), F.lit("recall_regression_vs_production")),
    )
    failed = F.when(
        F.size("_absent") > 0, F.array(F.concat(F.lit("missing_metrics:"), F.array_join("_absent", ",")))
    ).otherwise(checks)
    eligible = F.size("_failed") == 0
    return (
        df.withColumn("_absent", absent)
        .withColumn("_failed", failed)
        .withColumns(
            {
                "eligible_for_review": eligible,
                "approved_for_production": eligible & F.col(approved),
                "human_approval_required": F.lit(True),
                "reasons": F.when(
                    eligible & ~F.col(approved), F.array(F.lit("human_approval_required"))
                ).otherwise(F.col("_failed")),
            }
        )
        .drop("_absent", "_failed")
    )


def alert_step(
    df: DataFrame,
    status: str = "status",
    now: str = "now",
    triggered_at: str = "triggered_at",
    resolved_at: str = "resolved_at",
    cooldown_hours: int = K.ALERT_COOLDOWN_HOURS,
) -> DataFrame:
    """One step of the alert rule: fire once, repeat after the cooldown, resolve on ``ok``."""
    open_alert = F.col(triggered_at).isNotNull() & F.col(resolved_at).isNull()
    waited = F.col(now) >= F.col(triggered_at) + F.make_dt_interval(F.lit(0), F.lit(cooldown_hours))
    return df.withColumns(
        {
            "should_alert": (F.col(status) == "alert") & (~open_alert | F.coalesce(waited, F.lit(True))),
            "should_resolve": (F.col(status) == "ok") & open_alert,
        }
    )


def affected_features(features: DataFrame) -> DataFrame:
    """Alerting features and largest PSI of a report; a schema-wide table, so one row."""
    hit = F.when(F.col("status") == "alert", F.struct("position", "feature"))
    listed = F.array_sort(F.collect_list(hit))
    return features.agg(
        F.transform(listed, lambda s: s["feature"]).alias("affected_features"),
        F.coalesce(F.max("psi"), F.lit(0.0)).alias("max_psi"),
    )


def due_jobs(wanted: DataFrame, runs: DataFrame) -> DataFrame:
    """Requested (job, day) pairs without a successful run that day."""
    done = runs.where(F.col("status") == "succeeded").select("job", "day").distinct()
    return wanted.join(done, ["job", "day"], "left_anti")


def job_outcomes(wanted: DataFrame, runs: DataFrame) -> DataFrame:
    """Requested pairs marked ``run`` or ``skipped``."""
    done = (
        runs.where(F.col("status") == "succeeded").select("job", "day").distinct()
        .withColumn("_done", F.lit(True))
    )
    return wanted.join(done, ["job", "day"], "left").select(
        *wanted.columns, F.when(F.col("_done"), "skipped").otherwise("run").alias("outcome")
    )


def current_aliases(events: DataFrame) -> DataFrame:
    """Version each alias points to: its latest move."""
    return latest_per(events, ["alias"], [F.col("moved_at").desc(), F.col("event_id").desc()]).select(
        "alias", "version", "moved_at"
    )


def pending_runs(
    buckets: DataFrame, keys: list[str], minute: str, breached: str, minutes: int = 5, no_data_fires: bool = False
) -> DataFrame:
    """Stretches of consecutive breached minute buckets of at least ``minutes``.

    ``buckets`` holds one row per key and minute (number of the minute); a key has at
    most one row per minute of history, however many events the minute had. With
    ``no_data_fires`` minutes without a row continue a stretch and count in it: the distance to
    the next row tells how many there are, none is made up.
    """
    w = Window.partitionBy(*keys).orderBy(minute)
    if not no_data_fires:
        rows = buckets.where(F.col(breached)).withColumn("_island", F.col(minute) - F.row_number().over(w))
        found = rows.groupBy(*keys, "_island").agg(
            F.min(minute).alias("from_minute"), F.max(minute).alias("to_minute"), F.count(F.lit(1)).alias("minutes"),
        )
        return found.where(F.col("minutes") >= minutes).drop("_island")
    # Every row yields its own minute when breached and the hole up to the next row.
    after = F.lead(minute).over(w)
    bad = F.coalesce(F.col(breached), F.lit(False))
    first = F.when(bad, F.col(minute)).otherwise(F.col(minute) + 1)
    spans = buckets.select(*keys, first.alias("_a"), F.coalesce(after - 1, F.col(minute)).alias("_b")).where("_a <= _b")
    order = Window.partitionBy(*keys).orderBy("_a")
    opens = F.coalesce(F.lag("_b").over(order) + 1 < F.col("_a"), F.lit(True)).cast("int")
    spans = spans.withColumn("_open", opens)
    runs = spans.withColumn("_island", F.sum("_open").over(order)).groupBy(*keys, "_island").agg(
        F.min("_a").alias("from_minute"), F.max("_b").alias("to_minute")
    )
    return runs.withColumn("minutes", F.col("to_minute") - F.col("from_minute") + 1).where(F.col("minutes") >= minutes).drop("_island")
